"""Chat formatting by a declarative template and a finite-state machine over roles.

A template names the roles, the strings around each role's text, which texts are trained on, and the allowed next roles.
The machine reads the roles of a conversation in turn order; each turn becomes three segments (opening, text, closing)
with a loss flag each. Control strings inside a text are escaped with a backslash, as are backslashes, so that parse()
reads the turns back exactly from the formatted string. A turn out of order does not lose rows: it is emitted like the
others, and `valid` is false for the conversation.

Null text is empty; null roles are the empty role, which no template lists: such turns are formatted as the template's
`other` and are out of order. Turns are ordered by (turn, role, text), nulls first, so ties have one order; repeated rows
are kept as turns of their own. A null conv_id is a conversation of its own. Extra columns are ignored.

Rows are dealt by conversation and sorted there by Spark, which spills; turns then stream through, so that of a
conversation at most a turn, the machine's state and digests are held. The output comes by turns with their segments, or as
whole conversations in parts of fixed size with a loss mask; read_back() parses these parts alone."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Template:
    opening: tuple[tuple[str, str], ...]
    closing: str
    trained: tuple[str, ...]
    #: Allowed roles after each state; "" is the start.
    follows: tuple[tuple[str, tuple[str, ...]], ...]
    other: str = "### Other "

    def controls(self) -> list[str]:
        return sorted({x.strip() for _, x in self.opening} | {self.closing.strip(), self.other.strip()}, key=lambda x: (-len(x), x))


DEFAULT = Template(
    opening=(("system", "### System:\n"), ("user", "### User:\n"), ("assistant", "### Assistant:\n")),
    closing="\n</turn>\n",
    trained=("assistant",),
    follows=(("", ("system", "user")), ("system", ("user",)), ("user", ("assistant",)), ("assistant", ("user",))),
)

TURN = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("opening", "body", "closing")] + [T.StructField("loss", T.BooleanType())]
)


class Formatter:
    """Segments of one turn, and the way back."""

    def __init__(self, template: Template = DEFAULT):
        self.template = template
        self.opening = dict(template.opening)
        self.escapes = re.compile("|".join([re.escape("\\"), *map(re.escape, template.controls())]))
        self.steps = {state: set(after) for state, after in template.follows}

    def escape(self, text: str) -> str:
        return self.escapes.sub(lambda m: "\\" + m[0], text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)

    def open_of(self, role: str) -> str:
        return self.opening.get(role) or f"{self.template.other}{self.escape(role).replace(':', chr(92) + ':')}:\n"

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        trained = role in self.template.trained
        return [(self.open_of(role), False), (self.escape(text), trained), (self.template.closing, False)]

    def step(self, state: str, role: str) -> bool:
        return role in self.steps.get(state, ())

    def turn(self, formatted: str) -> tuple[str, str]:
        """Role and text of one formatted turn."""
        body = formatted[: -len(self.template.closing)]
        for role, opening in self.template.opening:
            if body.startswith(opening):
                return role, self.unescape(body[len(opening) :])
        name = re.match(rf"{re.escape(self.template.other)}((?:[^\\:]|\\.)*):\n", body, flags=re.S)
        return self.unescape(name[1]), self.unescape(body[name.end() :])

    def split(self, formatted: str) -> list[str]:
        """The formatted turns of a conversation; the closing string within a text is escaped, so it ends turns alone."""
        return [x + self.template.closing for x in formatted.split(self.template.closing)[:-1]]


def _ordered(turns: DataFrame) -> DataFrame:
    picked = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    count = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return picked.repartition(count, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


#: Characters of one part of a formatted conversation.
PART = 4096
_PARTS = [T.StructField("part", T.LongType()), T.StructField("text", T.StringType()), T.StructField("loss", T.ArrayType(T.IntegerType())), T.StructField("allowed", T.BooleanType())]


def format_turns(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Per turn: conv_id, index in its conversation, segments (opening, body, closing), loss flag of the body, and whether
    the machine allows its role there."""
    schema = T.StructType([turns.schema["conv_id"], T.StructField("index", T.LongType()), *TURN, T.StructField("allowed", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, conv, state, index = Formatter(template), object(), "", 0
        for batch in batches:
            rows = []
            for c, role, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if c != conv:
                    conv, state, index = c, "", 0
                (opening, _), (body, loss), (closing, _) = form.segments(role, text)
                rows.append((c, index, opening, body, closing, loss, form.step(state, role)))
                state, index = role, index + 1
            if rows:
                types = [batch.schema.field(0).type, pa.int64(), *[pa.string()] * 3, pa.bool_(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types, strict=True)], schema.names)

    return _ordered(turns).mapInArrow(run, schema)


def format_conversations(turns: DataFrame, template: Template = DEFAULT, size: int = PART) -> DataFrame:
    """The formatted conversations in parts of `size` characters, whatever the turns: conv_id, part (from 0), text, loss (start
    and stop, in the part, of each stretch that is trained on), and whether the machine allows all roles so far."""
    schema = T.StructType([turns.schema["conv_id"], *_PARTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, conv, state, kind = Formatter(template), object(), "", None
        waiting: list[tuple[str, bool]] = []  # segments that fill no part yet
        length = part = 0
        good = True
        rows: list[tuple] = []

        def filled(last: bool) -> None:
            """Cuts whole parts off what waits; at a conversation's end also what is left."""
            nonlocal waiting, length, part
            if length < size and not (last and (length or not part)):
                return
            whole = "".join(piece for piece, _ in waiting)
            ends = [0, *itertools.accumulate(len(piece) for piece, _ in waiting)]
            trained = [(x, y) for x, y, (_, loss) in zip(ends, ends[1:], waiting) if loss and y > x]
            stop = length if last else length - length % size
            for a in range(0, max(stop, 1), size):
                b = min(a + size, stop)
                spans = [z for x, y in trained if x < b and y > a for z in (max(x, a) - a, min(y, b) - a)]
                rows.append((conv, part, whole[a:b], spans, good))
                part += 1
            waiting = [(whole[max(x, stop) : y], loss) for x, y, (_, loss) in zip(ends, ends[1:], waiting) if y > stop]
            length -= stop

        def out() -> pa.RecordBatch:
            types = [kind, pa.int64(), pa.string(), pa.list_(pa.int32()), pa.bool_()]
            made = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types, strict=True)], schema.names)
            rows.clear()
            return made

        for batch in batches:
            kind = batch.schema.field(0).type
            for c, role, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if c != conv:
                    if part or length:
                        filled(True)
                    conv, state, waiting, length, part, good = c, "", [], 0, 0, True
                good &= form.step(state, role)
                state = role
                for piece, loss in form.segments(role, text):
                    waiting.append((piece, loss))
                    length += len(piece)
                filled(False)
            if rows:
                yield out()
        if part or length:
            filled(True)
            if rows:
                yield out()

    return _ordered(turns).mapInArrow(run, schema)


class _Reader:
    """One conversation, read part by part: only characters and the loss mask over them are known, and turns end where an
    unescaped closing string does. Holds the unread end, at most a turn, and digests."""

    def __init__(self, form: Formatter, conv):
        self.form, self.conv = form, conv
        self.tail, self.seen, self.masked = "", 0, ""
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss, self.valid = hashlib.sha256(), hashlib.sha256(), True

    def add(self, text: str, loss: list[int], allowed: bool) -> None:
        self.chars += len(text)
        self.valid = allowed
        self.masked += "".join(text[a:b] for a, b in zip(loss[::2], loss[1::2]))
        # A backslash at the end waits for what it escapes.
        ready = len(self.masked) - ((len(self.masked) - len(self.masked.rstrip("\\"))) % 2)
        plain, self.masked = self.form.unescape(self.masked[:ready]), self.masked[ready:]
        self.loss_chars += len(plain)
        self.loss.update(plain.encode("utf-8", "replace"))
        self.tail += text
        closing, begin = self.form.template.closing, 0
        while (end := self.tail.find(closing, max(begin, self.seen))) >= 0:
            stop = end + len(closing)
            role, said = self.form.turn(self.tail[begin:stop])
            self.turns += 1
            self.all.update(f"{role}\n{said}\n".encode("utf-8", "replace"))
            begin, self.seen = stop, stop
        self.tail = self.tail[begin:]
        self.seen = max(0, len(self.tail) - len(closing) + 1)

    def row(self) -> tuple:
        if self.tail or self.masked:
            raise ValueError(f"conversation {self.conv} does not end with a turn")
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.valid


def read_back(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Digests per conversation, from the parts of format_conversations() in their order: what a reader of the output sees."""
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid")
    kinds = (T.LongType(), T.StringType(), T.LongType(), T.StringType(), T.LongType(), T.BooleanType())
    schema = T.StructType([formatted.schema["conv_id"], *(T.StructField(n, k) for n, k in zip(names, kinds))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, reader, kind = Formatter(template), None, None
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        out = lambda rows: pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), [kind, *types], strict=True)], schema.names)
        for batch in batches:
            kind, rows = batch.schema.field(0).type, []
            for conv, part, text, loss, allowed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part == 0:
                    rows += [reader.row()] if reader else []
                    reader = _Reader(form, conv)
                reader.add(text, loss, allowed)
            if rows:
                yield out(rows)
        if reader:
            yield out([reader.row()])

    return formatted.select("conv_id", "part", "text", "loss", "allowed").mapInArrow(run, schema)


def conversations(formatted: DataFrame) -> DataFrame:
    """One formatted string per conversation with its segments and loss flags."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("index", *TURN.names))), lambda t: F.concat(t.opening, t.body, t.closing))
    return formatted.groupBy("conv_id").agg(F.array_join(parts, "").alias("formatted"), F.bool_and("allowed").alias("valid"))
