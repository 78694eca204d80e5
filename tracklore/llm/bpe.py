"""Byte-level BPE encoding and decoding with a public rank file.

Each Python worker keeps one DuckDB connection. The vocabulary's pattern cuts text into words, and words are cut again
where two neighbouring bytes stand together in no token, as no merge can ever cross there. Words not met before go to a
recursive query: rows of token positions join the merge table, and each word contracts its pairs of minimum rank, from the
left, until none is left. All pairs of that rank are contracted in one round where this is what contracting the leftmost
alone would give: a pair whose result could at once make a pair of lower rank is contracted alone, and a word in which a
later round finds a lower rank than an earlier one is done again with leftmost pairs alone. The rows are kept by position,
so that memory is bounded by the words of a query, whatever the number of rounds. Decoding joins token positions with the
vocabulary and aggregates the pieces in their order.

Words of a buffer are told apart by 64-bit hashes. A text over BUFFER bytes is encoded in slices that begin where
a word begins, and decoded in slices. A word of over LONGEST bytes without any such cut (one letter, millions of times) does
not fit the database's memory; its pairs are contracted by the same rounds over arrays.

Null text is empty: no ids, and empty decoded bytes. Bytes that are no UTF-8 are read as U+FFFD. Repeated rows are encoded
alike. Other columns pass unchanged; a column that has the name of a result is replaced. Empty input gives an empty table."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklore.llm._hash import byte_values, prefix, span
from tracklore.llm._work import aside, bounded, groups_of, held, restored, texts_of

#: Bytes of text, or ids, that are worked on at once.
BUFFER = 1_000_000
SLICE = 250_000
LONGEST = 400_000
#: Words, and ids of words, that a worker keeps.
KEPT = 1_000_000
#: Words, and bytes of words, given to one recursive query.
AT_ONCE, BYTES_AT_ONCE = 25_000, 400_000
#: Unicode's White_Space; spelled out, as engines differ on \x1c-\x1f.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The pattern that _starts() follows. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LETTER, _DIGIT, _OTHER, _WHITE = range(4)

#: p: position, unique over all words; np, nt: position and token to the right, -1 at the end; t: rank of the pair with it.
#: A token that was taken into its left neighbour is -1. low: the rank of the last round; back: whether a rank was lower.
ENCODE = """
WITH RECURSIVE s(p, w, tok, np, nt, t, alone, low, back) USING KEY (p) AS (
  SELECT p, w, tok, np, nt, m.t, m.alone, -1, false FROM init LEFT JOIN merges m ON m.l = tok AND m.r = nt
  UNION ALL
  (WITH best AS MATERIALIZED (SELECT w, min(t) AS t, max(low) AS low FROM s WHERE tok >= 0 GROUP BY w HAVING min(t) IS NOT NULL),
   met AS (
     SELECT s.p, s.w, s.np, s.t, s.alone, lag(s.np) OVER (ORDER BY s.p) IS DISTINCT FROM s.p AS fresh
     FROM s JOIN best ON s.w = best.w AND s.t = best.t),
   runs AS (SELECT *, sum(fresh::INT) OVER (ORDER BY p) AS run FROM met),
   taken AS MATERIALIZED (
     SELECT p AS bp, w, np AS bn, t FROM runs
     QUALIFY CASE WHEN alone OR {leftmost} THEN row_number() OVER (PARTITION BY w ORDER BY p) = 1
       ELSE row_number() OVER (PARTITION BY run ORDER BY p) % 2 = 1 END),
   made AS (SELECT taken.bp, taken.t, s.np, s.nt FROM taken JOIN s ON s.p = taken.bn),
   after AS (
     SELECT s.p, s.w, CASE WHEN gone.bn IS NOT NULL THEN -1 ELSE coalesce(made.t, s.tok) END AS tok,
       CASE WHEN made.bp IS NULL THEN s.np ELSE made.np END AS np, CASE WHEN made.bp IS NULL THEN s.nt ELSE made.nt END AS nt,
       best.t AS low, s.back OR best.t < best.low AS back
     FROM s JOIN best ON s.w = best.w LEFT JOIN made ON s.p = made.bp LEFT JOIN taken gone ON s.p = gone.bn WHERE s.tok >= 0),
   linked AS (SELECT after.* REPLACE (coalesce(taken.t, after.nt) AS nt) FROM after LEFT JOIN taken ON after.np = taken.bp)
   SELECT linked.p, linked.w, linked.tok, linked.np, linked.nt, m.t, m.alone, linked.low, linked.back
   FROM linked LEFT JOIN merges m ON m.l = linked.tok AND m.r = linked.nt AND linked.tok >= 0))
SELECT w, list(tok ORDER BY p), bool_or(back) FROM s WHERE tok >= 0 GROUP BY w ORDER BY w
"""
DECODE = "SELECT d, string_agg(piece, '' ORDER BY pos) FROM ids JOIN vocab USING (id) GROUP BY d"


def _classes() -> np.ndarray:
    """The class of each code point."""
    import regex

    points = [*range(0xD800), *range(0xE000, 0x110000)]
    every, out = "".join(map(chr, points)), np.full(0x110000, _OTHER, np.uint8)
    at = np.array(points)
    for kind, of in ((_LETTER, r"\p{L}+"), (_DIGIT, r"\p{N}+"), (_WHITE, f"[{_SPACE}]+")):
        for m in regex.finditer(of, every):
            out[at[m.start() : m.end()]] = kind
    return out


def _starts(points: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where PATTERN begins its matches in code points of texts that begin at `first`."""
    n = len(points)
    kind = classes[points]
    opens = np.zeros(n + 1, bool)
    opens[first] = True
    opens[n] = True
    white = kind == _WHITE
    change = np.ones(n, bool)
    change[1:] = kind[1:] != kind[:-1]
    out = change | opens[:n]
    # White space goes apart from its last character, which is the start of a match; a space takes what follows along.
    ends = np.ones(n, bool)
    ends[:-1] = ~white[1:]
    ends |= opens[1:]
    out |= white & ends & ~opens[1:]
    out[1:] &= ~((points[:-1] == 32) & ~white[1:]) | opens[1:n]
    # An apostrophe that begins a match may be a contraction with one or two letters.
    mark = np.flatnonzero((points == 39) & out)
    if len(mark):
        end = np.append(first, n)[np.searchsorted(first, mark, "right")]
        one, two = (np.where(mark + k < end, points[np.minimum(mark + k, n - 1)], 0) for k in (1, 2))
        short = np.isin(one, [115, 116, 109, 100])  # s t m d
        long = ((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108))  # re ve ll
        out[mark[short | long] + 1] = False
        out[mark[long] + 2] = False
        stop = np.concatenate([mark[short] + 2, mark[long] + 3])
        out[stop[stop < n]] = True
        # White space behind a contraction keeps its own rule.
        stop = stop[stop < n]
        stop = stop[white[stop] & ~opens[stop]]
        inner = stop[(stop > 0) & white[np.maximum(stop - 1, 0)]]
        out[inner] = True
    return out


class Known:
    """Ids of words by hash: sorted hashes, with where and how many ids each has. Starts anew when it is full."""

    def __init__(self):
        self.keys, self.at, self.length, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def missing(self, hashes: np.ndarray) -> np.ndarray:
        """Which of distinct hashes are not kept; all of them, if these would be too many."""
        spot = np.searchsorted(self.keys, hashes)
        new = np.flatnonzero(self.keys[np.minimum(spot, len(self.keys) - 1)] != hashes) if len(self.keys) else np.arange(len(hashes))
        if len(self.keys) and (len(self.keys) + len(new) > KEPT or len(self.flat) > 8 * KEPT):
            self.__init__()
            return np.arange(len(hashes))
        return new

    def add(self, hashes: np.ndarray, ids: list[bytes]) -> None:
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        spot = np.searchsorted(self.keys, hashes)
        self.keys = np.insert(self.keys, spot, hashes)
        self.at = np.insert(self.at, spot, len(self.flat) + np.cumsum(length) - length)
        self.length = np.insert(self.length, spot, length)
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), np.uint32)])

    def found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spot = np.searchsorted(self.keys, hashes)
        return self.at[spot], self.length[spot]


class Codec:
    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = None if pattern == PATTERN else regex.compile(pattern.replace(r"[^\s", rf"[^{_SPACE}").replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]"))
        self.classes: np.ndarray | None = None
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        #: Whether two bytes stand together in some token.
        self.near = np.zeros(1 << 16, bool)
        for x in self.ranks:
            if len(x) > 1:
                b = np.frombuffer(x, np.uint8).astype(np.int32)
                self.near[(b[:-1] << 8) | b[1:]] = True
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""})
        self.made: set[str] = set()
        self.known = Known()
        self._rules: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def _table(self, name: str, columns: dict) -> None:
        self.con.register("_given", pa.table(columns))
        self.con.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM _given")
        self.con.unregister("_given")

    def _pairs(self) -> Iterator[tuple[int, int, int, bool]]:
        """Two tokens, what they make, for every token and each place to cut it, and whether the result and another left
        token make a token of lower rank."""
        for x, t in self.ranks.items():
            for i in range(1, len(x)):
                a, b = self.ranks.get(x[:i]), self.ranks.get(x[i:])
                if a is not None and b is not None:
                    yield a, b, t, self.ranks.get(x + x[:i], t) < t

    def _need(self, name: str) -> None:
        """Makes a table of the vocabulary on first use: encoding and decoding may run in different workers."""
        if name in self.made:
            return
        self.made.add(name)
        if name == "merges":
            rules = np.fromiter(self._pairs(), np.dtype((np.int32, 4))).T
            self._table(name, {k: np.ascontiguousarray(x) for k, x in zip(("l", "r", "t"), rules)} | {"alone": rules[3] > 0})
        else:
            self._table(name, {"id": np.fromiter(self.ranks.values(), np.int32), "piece": [x.decode("latin-1") for x in self.ranks]})

    def _rounds(self, word: bytes) -> np.ndarray:
        """ENCODE's rounds over arrays, for a word over LONGEST bytes."""
        if self._rules is None:
            a, b, t, alone = np.fromiter(self._pairs(), np.dtype((np.int32, 4))).T.astype(np.int64)
            key = (a << 32) | b
            order = np.argsort(key)
            self._rules = key[order], t[order], alone[order] > 0
        key, made, alone = self._rules

        def ranks_of(tok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            pair = (tok[:-1].astype(np.int64) << 32) | tok[1:]
            at = np.minimum(np.searchsorted(key, pair), len(key) - 1)
            return np.where(key[at] == pair, made[at], 1 << 40), alone[at]

        def contracted(leftmost: bool) -> np.ndarray | None:
            tok, low = self.byte[np.frombuffer(word, np.uint8)], -1
            while len(tok) > 1:
                rank, single = ranks_of(tok)
                best = int(rank.min())
                if best == 1 << 40:
                    break
                if best < low and not leftmost:
                    return None
                low, at = best, np.flatnonzero(rank == best)
                if leftmost or single[at[0]]:
                    at = at[:1]
                else:
                    fresh = np.concatenate(([True], at[1:] != at[:-1] + 1))
                    begin = at[fresh][np.cumsum(fresh) - 1]
                    at = at[(at - begin) % 2 == 0]
                tok[at] = best
                tok = np.delete(tok, at + 1)
            return tok

        found = contracted(False)
        return contracted(True) if found is None else found

    def _contract(self, words: list[bytes], leftmost: bool = False) -> list[bytes]:
        """Packed ids of words, by the recursive query."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        stop = np.cumsum(sizes)
        tok = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        p = np.arange(len(tok), dtype=np.int32)
        after, beside = p + 1, np.append(tok[1:], np.int32(-1))
        after[stop - 1], beside[stop - 1] = -1, -1
        self._table("init", {"p": p, "w": np.repeat(np.arange(len(words), dtype=np.int32), sizes), "tok": tok, "np": after, "nt": beside})
        found = self.con.sql(ENCODE.format(leftmost="true" if leftmost else "false")).to_arrow_table().combine_chunks()
        ids = found.column(1).combine_chunks()
        flat, cut = ids.values.to_numpy(zero_copy_only=False).astype(np.uint32).tobytes(), (ids.offsets.to_numpy() * 4).tolist()
        out = [flat[a:b] for a, b in zip(cut, cut[1:])]
        back = np.flatnonzero(found.column(2).to_numpy(zero_copy_only=False)) if not leftmost else []
        if len(back):
            for i, x in zip(back, self._contract([words[i] for i in back], True), strict=True):
                out[i] = x
        return out

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of distinct words."""
        out: list[bytes] = [b""] * len(words)
        rest = []
        for i, word in enumerate(words):
            if (t := self.ranks.get(word)) is not None:
                out[i] = t.to_bytes(4, "little")
            elif len(word) > LONGEST:
                out[i] = self._rounds(word).astype(np.uint32).tobytes()
            else:
                rest.append(i)
        if rest:
            self._need("merges")
        rest.sort(key=lambda i: len(words[i]))  # words of one query end after about as many rounds
        start = size = 0
        for k in range(len(rest) + 1):
            here = len(words[rest[k]]) if k < len(rest) else BYTES_AT_ONCE
            if k > start and (k - start >= AT_ONCE or size + here > BYTES_AT_ONCE):
                for i, x in zip(rest[start:k], self._contract([words[i] for i in rest[start:k]]), strict=True):
                    out[i] = x
                start, size = k, 0
            size += here
        return out

    def _words(self, texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """All texts end to end, where words begin and end there, and where texts begin."""
        buffer = b"".join(texts)
        try:
            whole = buffer.decode()
        except UnicodeDecodeError:
            texts = [x.decode("utf-8", "replace").encode() for x in texts]
            buffer = b"".join(texts)
            whole = buffer.decode()
        data = np.frombuffer(buffer, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        first = np.cumsum(sizes) - sizes
        if self.pattern:
            begin = np.zeros(len(data), bool)
            for a, x in zip(first.tolist(), texts):
                words = self.pattern.findall(x.decode())
                at = a + np.cumsum([0, *(len(w.encode()) for w in words)])
                begin[at[:-1]] = True
        else:
            if self.classes is None:
                self.classes = _classes()
            lead = np.flatnonzero((data & 0xC0) != 0x80)
            points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
            begin = np.zeros(len(data), bool)
            begin[lead[_starts(points, np.searchsorted(lead, first[sizes > 0]), self.classes)]] = True
        begin[1:] |= ~self.near[(data[:-1].astype(np.uint16) << 8) | data[1:]]
        start = np.flatnonzero(begin)
        return buffer, start, np.append(start[1:], len(data)), first

    def _encoded(self, texts: list[bytes]) -> list[bytes]:
        buffer, start, end, first = self._words(texts)
        if not len(start):
            return [b""] * len(texts)
        hashes, one, which = np.unique(span(prefix(byte_values(buffer)), start, end), return_index=True, return_inverse=True)
        new = self.known.missing(hashes)
        if len(new):
            self.known.add(hashes[new], self._ids([buffer[a:b] for a, b in zip(start[one[new]].tolist(), end[one[new]].tolist())]))
        at, length = self.known.found(hashes)
        many = length[which]
        stop = np.cumsum(many)
        whole = self.known.flat[np.arange(stop[-1]) + np.repeat(at[which] - (stop - many), many)]
        cut = np.append(0, stop)[np.searchsorted(start, np.append(first, len(buffer)))]
        return [whole[a:b].tobytes() for a, b in zip(cut.tolist(), cut[1:].tolist())]

    def _slices(self, text: bytes) -> Iterator[bytes]:
        """A long text in parts that begin where a word begins whatever stands before: at a space behind a letter or
        digit, or between two bytes that are in no token together, but for marks and white space."""
        at = 0
        while len(text) - at > BUFFER:
            size = BUFFER
            while True:
                data = np.frombuffer(text, np.uint8, min(size, len(text) - at), at)
                left, right = data[:-1], data[1:]
                name = ((left | 32) - 97 < 26) | (left - 48 < 10)
                white = (right == 32) | (right - 9 < 5)
                lead = ((right & 0xC0) == 0xC0) | ((right > 32) & (right < 127) & (right != 39))
                # Behind a letter or digit, what is of more than one byte may be white space.
                cut = np.flatnonzero((name & white) | (name & lead & (right < 128) & ~self.near[(left.astype(np.uint16) << 8) | right]))
                if len(cut) or at + size >= len(text):
                    break
                size *= 2
            to = at + int(cut[-1]) + 1 if len(cut) else len(text)
            yield text[at:to]
            at = to
        yield text[at:]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts = [(i, x) for i, text in enumerate(texts) for x in (self._slices(text) if len(text) > BUFFER else (text,))]
        out: list[list[bytes]] = [[] for _ in texts]
        for a, b in groups_of([x for _, x in parts], BUFFER):
            for (i, _), ids in zip(parts[a:b], self._encoded([x for _, x in parts[a:b]]), strict=True):
                out[i].append(ids)
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def _decoded(self, ids: list[bytes]) -> list[bytes]:
        self._need("vocab")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.minimum(np.frombuffer(b"".join(ids), np.uint32), 2**31 - 1).astype(np.int32)
        self._table("ids", {"d": np.repeat(np.arange(len(ids), dtype=np.int32), sizes), "pos": np.arange(len(flat), dtype=np.int32), "id": flat})
        found = dict(self.con.sql(DECODE).fetchall())
        return [found.get(i, "").encode("latin-1") for i in range(len(ids))]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes that each sequence of packed ids stands for; ids outside the vocabulary stand for nothing."""
        parts = [(i, x[a : a + 4 * SLICE]) for i, x in enumerate(ids) for a in range(0, len(x), 4 * SLICE)]
        out: list[list[bytes]] = [[] for _ in ids]
        for a, b in groups_of([x for _, x in parts], 4 * SLICE):
            for (i, _), piece in zip(parts[a:b], self._decoded([x for _, x in parts[a:b]]), strict=True):
                out[i].append(piece)
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec for a rank file."""
    return held(("bpe", path, pattern), lambda: Codec(path, pattern))


def _mapped(docs: DataFrame, results: list[str], source: str, gone: tuple[str, ...], each) -> DataFrame:
    """docs without the columns `gone`, with binary columns `results` that each(values of `source`) makes."""
    kept = [c for c in docs.columns if c not in results and c not in gone]
    own = docs.select(aside(kept), F.col(source).cast("binary").alias("_source"))
    schema = T.StructType([own.schema["_kept"], *(T.StructField(r, T.BinaryType()) for r in results)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = texts_of(batch.column(1))
            for start, stop in groups_of(values, BUFFER):
                made = each(values[start:stop])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), *(pa.array(x, pa.binary()) for x in made)], schema.names)

    return bounded(own, run, schema).select(*restored(kept), *results)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """docs with the binary column `ids`."""
    return _mapped(docs, ["ids"], text, (), lambda x: [codec(path, pattern).encode(x)])


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """encoded, which has the binary column `ids`, with the binary column `decoded`."""
    return _mapped(encoded, ["decoded"], "ids", (), lambda x: [codec(path, pattern).decode(x)])


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """docs, without the text, with `ids` and `decoded`, both by one worker."""

    def both(texts: list[bytes]) -> list[list[bytes]]:
        ids = codec(path, pattern).encode(texts)
        return [ids, codec(path, pattern).decode(ids)]

    return _mapped(docs, ["ids", "decoded"], text, (text,), both)
