"""Removal of repeated byte strings by a suffix array over range-partitioned buckets.

Only the first of equal strings of `width` bytes stays, first by (document, start); strings are judged on the input. The
suffixes that are sorted are a sample that no repeat escapes: of every `width - GRAM + 1` consecutive starts, the one
whose leading token (GRAM bytes) has the least hash. Equal strings choose the same start, about one in 35.

1. Leading tokens meet in fragments, packed by buffers; suffixes whose token is at one place only leave. A token that a
   buffer has at several places is sent once, and those places are sent straight on.
2. The suffixes left carry `width` bytes to either side. Spark samples splitters and range-partitions them by leading
   token, then place, so that a token at very many places fills several neighbouring buckets.
3. A bucket is sorted by a multikey quicksort on eight-byte characters: a round sorts the ties of the round before by the
   next character. So are the reversed left sides, within a token. The common prefixes of neighbours in both orders decide
   which strings are alike: a string of `width` bytes that begins `o` bytes before its suffix is that of another suffix if
   the two have `width - o` bytes in common in the one order and `o` in the other. Of suffixes alike on both sides as a
   whole, all strings but the first one's are later; the others are compared offset by offset.
4. The tokens at a bucket's ends may go on in the next bucket. Their strings, with the bucket's first place each, are
   compared across boundaries in fragments of the strings' 64-bit hashes.
5. Documents, joined with the starts of their later strings, lose the bytes that these cover.

Null text is empty. Documents of fewer than `width` bytes lose nothing. See _marks for repeated rows and null ids. Other
columns pass unchanged, those named like results are replaced. An empty table gives an empty table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklore.llm._hash import byte_values, mix, windows
from tracklore.llm._marks import PACKED_MARKS, keyed, marks_of, packed_marks, with_marks
from tracklore.llm._work import Work, bounded, bounded_batches, groups_of, held, restored, text_bytes, texts_of
from tracklore.llm.substring import _PACKED, _deal, _emit, _meet, _repeated_here

FRAGMENT = 16_000_000
BUFFER = 1_000_000
GRAM = 32
#: Bytes of contexts in one bucket.
BUCKET = 10_000_000


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over each run of `size` values, by doubling."""
    reach, count = 1, len(values) - size + 1
    while reach * 2 <= size:
        values = pick(values[:-reach], values[reach:])
        reach *= 2
    return pick(values[:count], values[size - reach : size - reach + count]) if reach < size else values


def _sampled(texts: list[bytes], width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts (owner, place) of the chosen suffixes, and hashes of their tokens."""
    size = width - gram + 1
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.cumsum(sizes) - sizes
    token = windows(byte_values(b"".join(texts)), gram)
    if len(token) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = _sliding(token, size, np.minimum)
    # Strings that would run into the next text choose nothing.
    within = np.zeros(len(least) + 1, np.int64)
    some = sizes >= width
    np.add.at(within, first[some], 1)
    np.add.at(within, (first + sizes - width + 1)[some], -1)
    least[np.cumsum(within[:-1]) == 0] = 0
    # A start is chosen if any string around it has its token for the least: if the largest of their least tokens is its.
    padded = np.concatenate([np.zeros(size - 1, np.uint64), least, np.zeros(len(token) - len(least), np.uint64)])
    at = np.flatnonzero((_sliding(padded, size, np.maximum) == token) & (token > 0))
    owner = np.searchsorted(first, at, "right") - 1
    # Chosen tokens have small hashes; mixed anew, they spread over all fragments.
    return owner, at - first[owner], mix(token[at])


#: Bytes of a long text that are looked at together, beside what strings reach over.
STRETCH = 2_000_000


def _stretches(texts: list[bytes], width: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Owner, place and own size of each stretch of texts, with bytes enough before and behind that all strings around its
    places are whole."""
    for i, text in enumerate(texts):
        for a in range(0, len(text), STRETCH):
            yield i, a, min(STRETCH, len(text) - a), text[max(0, a - 2 * width) : a + STRETCH + 2 * width]


def repeated_tokens(docs: DataFrame, width: int, gram: int, fragments: int) -> DataFrame:
    """_id, _tie, _marks: starts (uint32, by byte) of chosen suffixes of keyed docs whose token is at two places or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("suffixes", object)
        for batch in batches:
            ids, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            parts = list(_stretches(texts_of(batch.column(2)), width))
            for a, b in groups_of([x[3] for x in parts], BUFFER):
                text, begin, size = (np.array([x[k] for x in parts[a:b]]) for k in range(3))
                owner, place, hashes = _sampled([x[3] for x in parts[a:b]], width, gram)
                place = place + np.maximum(0, begin - 2 * width)[owner]
                own = (place >= begin[owner]) & (place < (begin + size)[owner])
                owner, place, hashes = text[owner[own]], place[own], hashes[own]
                if len(owner):
                    known = _repeated_here(hashes, owner, place, ids, ties)
                    yield from _emit(list(_deal(hashes, owner, place, ids, ties, fragments, known, False)))

    return bounded(docs.select("_id", "_tie", "_text"), run, _PACKED).groupBy("fragment").applyInArrow(lambda t: _meet(t, 0, False, fragments), PACKED_MARKS)


#: A suffix with its place, and up to width - gram bytes to its left and width bytes from its start; `left` tells these apart.
_CONTEXT = T.StructType([T.StructField("_id", T.LongType()), T.StructField("_tie", T.LongType()), T.StructField("place", T.LongType()), T.StructField("left", T.IntegerType()), T.StructField("context", T.BinaryType())])
#: Rows of contexts that are cut out, or laid out for sorting, at once.
ROWS_AT_ONCE = 20_000


def contexts(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """A row of _CONTEXT for each marked suffix of keyed docs."""

    def cut(buffer: np.ndarray, first: np.ndarray, size: np.ndarray, owner: np.ndarray, place: np.ndarray, ids: np.ndarray, ties: np.ndarray) -> pa.RecordBatch:
        left = np.minimum(place, width - gram)
        length = left + np.minimum(size[owner] - place, width)
        stop = np.cumsum(length)
        data = buffer[np.arange(stop[-1]) + np.repeat(first[owner] + place - left - (stop - length), length)]
        offsets = np.append(0, stop).astype(np.int32)
        context = pa.Array.from_buffers(pa.binary(), len(place), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        return pa.RecordBatch.from_arrays([pa.array(ids[owner]), pa.array(ties[owner]), pa.array(place), pa.array(left.astype(np.int32)), context], _CONTEXT.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("suffixes", object)
        for batch in batches:
            ids, ties, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), texts_of(batch.column(2))
            marks = [np.unique(x) for x in marks_of(batch.column(3), np.uint32)]
            for a, b in groups_of(texts, BUFFER):
                size = np.fromiter(map(len, texts[a:b]), np.int64, b - a)
                buffer, first = np.frombuffer(b"".join(texts[a:b]), np.uint8), np.cumsum(size) - size
                place = np.concatenate(marks[a:b]).astype(np.int64)
                owner = np.repeat(np.arange(b - a), [len(x) for x in marks[a:b]])
                for k in range(0, len(place), ROWS_AT_ONCE):
                    yield cut(buffer, first, size, owner[k : k + ROWS_AT_ONCE], place[k : k + ROWS_AT_ONCE], ids[a:b], ties[a:b])

    return bounded(docs.select("_id", "_tie", "_text", "_marks"), run, _CONTEXT)


def multikey_order(characters: np.ndarray, groups: np.ndarray | None = None) -> np.ndarray:
    """Order of rows of eight-byte characters (and of groups before them): each round sorts by one character, and only rows
    that are still tied go into the next round."""
    n, depth = characters.shape
    order = np.arange(n)
    rank = np.zeros(n, np.int64) if groups is None else groups.astype(np.int64)
    live = order
    if groups is not None:
        order = np.argsort(groups, kind="stable")
        live = order
    start = np.zeros(n, np.int64)  # where the tie of each sorted row begins
    if groups is not None and n:
        sorted_rank = rank[order]
        edge = np.flatnonzero(np.concatenate(([True], sorted_rank[1:] != sorted_rank[:-1])))
        start = np.repeat(edge, np.diff(np.append(edge, n)))
    at = np.arange(n)  # sorted places of live rows
    for k in range(depth):
        if len(at) < 2:
            break
        live = order[at]
        value = characters[live, k]
        turn = np.lexsort((value, start[at]))
        order[at] = live[turn]
        value, tie = value[turn], start[at]
        edge = np.flatnonzero(np.concatenate(([True], (value[1:] != value[:-1]) | (tie[1:] != tie[:-1]))))
        size = np.diff(np.append(edge, len(at)))
        start[at] = at[np.repeat(edge, size)]
        at = at[np.repeat(size > 1, size)]
    return order


def _characters(data: np.ndarray, start: np.ndarray, step: int, sizes: np.ndarray, width: int) -> np.ndarray:
    """Strings data[start::step] of these sizes, padded with zero bytes, as big-endian eight-byte characters; the size is the
    last, so that of strings that differ by zero bytes at their ends the shorter comes first."""
    bytes_of = np.arange(-(-width // 8) * 8)
    out = np.zeros((len(start), len(bytes_of) // 8 + 1), ">u8")
    for a in range(0, len(start), ROWS_AT_ONCE):
        here = slice(a, a + ROWS_AT_ONCE)
        inside = bytes_of < sizes[here, None]
        some = np.where(inside, data[np.where(inside, start[here, None] + step * bytes_of, 0)], 0).astype(np.uint8)
        out[here, :-1] = some.view(">u8")
    out[:, -1] = sizes
    return out


def _shared(characters: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each row in the order, the longest common prefix in bytes with the row before it; -1 for the first."""
    out = np.full(len(order), -1, np.int64)
    for a in range(1, len(order), ROWS_AT_ONCE):
        b = min(len(order), a + ROWS_AT_ONCE)
        one, two = (np.ascontiguousarray(characters[order[x:y], :-1]).view(np.uint8) for x, y in ((a - 1, b - 1), (a, b)))
        differ = one != two
        length = np.where(differ.any(1), differ.argmax(1), differ.shape[1])
        out[a:b] = np.minimum(length, np.minimum(sizes[order[a - 1 : b - 1]], sizes[order[a:b]]))
    return out


class Sorted:
    """Strings in suffix order. Rows that have `depth` bytes in common lie next to each other there, and no longest common
    prefix between them is shorter; so ranks() tells which rows are alike to any depth without looking at bytes again."""

    def __init__(self, characters: np.ndarray, sizes: np.ndarray, groups: np.ndarray | None = None):
        self.order = multikey_order(characters, groups)
        self.shared = _shared(characters, sizes, self.order)
        if groups is not None:
            grouped = groups[self.order]
            self.shared[1:][grouped[1:] != grouped[:-1]] = -1
        #: The longest prefix in common with any other row.
        self.reach = np.empty(len(sizes), np.int64)
        self.reach[self.order] = np.maximum(self.shared, np.append(self.shared[1:], -1))
        whole = sizes[self.order]
        self._same = np.append(False, (self.shared[1:] == whole[1:]) & (whole[1:] == whole[:-1]))

    def _ranked(self, fresh: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.cumsum(fresh)
        return out

    def ranks(self, depth: int) -> np.ndarray:
        """Rows of at least `depth` bytes have one rank if these are alike."""
        return self._ranked(self.shared < depth)

    def wholes(self) -> np.ndarray:
        """Rows have one rank if they are alike as a whole."""
        return self._ranked(~self._same)


#: Strings that a bucket has first, of tokens that may go on in other buckets, packed by fragments of their hashes.
_FIRSTS = "strings binary, firsts binary"
_FOUND = PACKED_MARKS + ", fragment int, " + _FIRSTS
_FOUND_TYPES = {"bucket": pa.int32(), "fragment": pa.int32()}
_FOUND_NAMES = [x.split()[0] for x in _FOUND.split(", ")]


def _found(**columns: list) -> pa.Table:
    many = len(next(iter(columns.values())))
    types = {x: _FOUND_TYPES.get(x, pa.binary()) for x in _FOUND_NAMES}
    return pa.table([pa.array(columns[x], types[x]) if x in columns else pa.nulls(many, types[x]) for x in _FOUND_NAMES], _FOUND_NAMES)


def _bucket(ids, ties, places, data: np.ndarray, offsets: np.ndarray, left: np.ndarray, width: int, gram: int, groups: int) -> Iterator[pa.Table]:
    """Of one sorted bucket: later strings as packed marks and, of the tokens at its ends, first strings."""
    # Rows in the order of places, each place once: of two rows with one string, the one before is the first.
    ranked = np.lexsort((places, ties, ids))
    fresh = np.ones(len(ranked), bool)
    fresh[1:] = np.logical_or.reduce([x[ranked][1:] != x[ranked][:-1] for x in (ids, ties, places)])
    ranked = ranked[fresh]
    ids, ties, places, left = ids[ranked], ties[ranked], places[ranked], left[ranked].astype(np.int64)
    begin = offsets[ranked].astype(np.int64) + left
    right = offsets[ranked + 1] - begin
    characters = _characters(data, begin, 1, right, width)
    forward = Sorted(characters, right)
    token = forward.ranks(gram)
    backward = Sorted(_characters(data, begin - 1, -1, left, width - gram), left, token)
    del characters
    # Offsets at which the string around a suffix lies in its text.
    low, high = np.maximum(0, width - right), np.minimum(left, width - gram)
    # Rows alike on both sides: all strings of those but the first are later.
    _, lead, which = np.unique((forward.wholes() << 32) | backward.wholes(), return_index=True, return_inverse=True)
    copies = np.flatnonzero((lead[which] != np.arange(len(ids))) & (high >= low))
    row, start, many = [copies], [places[copies] - high[copies]], [(high - low + 1)[copies]]
    # Of the others, a string is later if a row before has the same rank on both sides.
    single = np.sort(lead)
    ends = np.isin(token[single], token[forward.order[[0, -1]]])
    near_low, near_high = np.maximum(low, width - forward.reach)[single], np.minimum(high, backward.reach)[single]
    later = np.zeros((len(single), width - gram + 1), bool)
    first_row, first_offset = [], []
    for o in range(width - gram + 1):
        at = np.flatnonzero(((near_low <= o) & (o <= near_high)) | (ends & (low[single] <= o) & (o <= high[single])))
        if not len(at):
            continue
        rank = (forward.ranks(width - o)[single[at]] << 32) | backward.ranks(o)[single[at]]
        _, first, same = np.unique(rank, return_index=True, return_inverse=True)
        later[at, o] = first[same] != np.arange(len(at))
        # A string is sent if any row of the tokens at the ends offers it, in the place that is first here.
        opened = np.zeros(len(first), bool)
        opened[same[ends[at]]] = True
        first_row.append(single[at[first[opened]]])
        first_offset.append(np.full(int(opened.sum()), o))
    step = np.diff(np.pad(later.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    (at, opens), (_, closes) = np.nonzero(step == 1), np.nonzero(step == -1)
    row, start, many = np.concatenate([*row, single[at]]), np.concatenate([*start, places[single[at]] - (closes - 1)]), np.concatenate([*many, closes - opens])
    if len(row):
        packed = packed_marks(ids[row], ties[row], np.column_stack([start, many]), groups)
        yield _found(**{c: packed.column(c).to_pylist() for c in packed.column_names})
    row, offset = (np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (first_row, first_offset))
    strings = np.empty(len(row), np.uint64)
    for a in range(0, len(row), ROWS_AT_ONCE):
        here = slice(a, a + ROWS_AT_ONCE)
        body = data[(begin[row[here]] - offset[here])[:, None] + np.arange(width)]
        strings[here] = windows(body.ravel().astype(np.uint64) + np.uint64(1), width)[::width]
    if len(row):
        fragment = (((strings >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)).astype(np.int64)
        firsts = np.column_stack([ids[row], ties[row], places[row] - offset])
        order = np.argsort(fragment, kind="stable")
        cut = np.append(np.flatnonzero(np.diff(fragment[order], prepend=-1)), len(order)).tolist()
        parts = [order[a:b] for a, b in zip(cut, cut[1:])]
        yield _found(fragment=[int(fragment[x[0]]) for x in parts], strings=[strings[x].tobytes() for x in parts], firsts=[firsts[x].tobytes() for x in parts])


def sorted_buckets(suffixes: DataFrame, width: int, gram: int, buckets: int, groups: int) -> DataFrame:
    """Rows of _FOUND from suffixes with their contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("suffixes", object)
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        ids, ties, places, left = (np.concatenate([b.column(i).to_numpy() for b in parts]) for i in range(4))
        pieces, offsets, total = [], [np.zeros(1, np.int64)], 0
        for b in parts:
            column = b.column(4)
            own = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
            pieces.append(np.frombuffer(column.buffers()[2], np.uint8)[own[0] : own[-1]])
            offsets.append(own[1:] - own[0] + total)
            total += int(own[-1] - own[0])
        data, offsets = np.concatenate(pieces), np.concatenate(offsets)
        parts.clear()
        pieces.clear()
        for found in _bucket(ids, ties, places, data, offsets, left, width, gram, groups):
            yield from found.combine_chunks().to_batches()

    lead = F.substring("context", F.col("left") + 1, F.lit(gram))
    return bounded(suffixes.repartitionByRange(buckets, lead, "_id", "_tie", "place"), run, _FOUND)


def _later(found: DataFrame, groups: int) -> DataFrame:
    """Packed marks: runs (first start, how many) of strings that are not the first of their kind."""

    def across(table: pa.Table) -> pa.Table:
        strings = np.frombuffer(b"".join(table.column("strings").to_pylist()), np.uint64)
        ids, ties, starts = np.frombuffer(b"".join(table.column("firsts").to_pylist()), np.int64).reshape(-1, 3).T
        order = np.lexsort((starts, ties, ids, strings))
        later = order[np.append(False, strings[order][1:] == strings[order][:-1])]
        # A bucket may offer one place by two suffixes.
        before = order[np.append(strings[order][1:] == strings[order][:-1], False)]
        other = (ids[later] != ids[before]) | (ties[later] != ties[before]) | (starts[later] != starts[before])
        later = later[other]
        return packed_marks(ids[later], ties[later], np.column_stack([starts[later], np.ones(len(later), np.int64)]), groups)

    ends = found.filter("fragment IS NOT NULL").select("fragment", "strings", "firsts")
    inside = found.filter("bucket IS NOT NULL").select("bucket", "ids", "ties", "counts", "values")
    return inside.union(ends.groupBy("fragment").applyInArrow(across, PACKED_MARKS))


def _removed(docs: DataFrame, width: int) -> DataFrame:
    schema = T.StructType([docs.schema["_kept"], *(T.StructField(x, T.LongType()) for x in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept_bytes", T.BinaryType()), T.StructField("kept_text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, starts in zip(texts_of(batch.column("_text")), marks_of(batch.column("_marks"), np.uint32), strict=True):
                if not len(starts):
                    rows.append((len(text), 0, 0, text, text))
                    continue
                begin, many = starts.reshape(-1, 2).astype(np.int64).T
                change = np.bincount(begin, minlength=len(text) + 1) - np.bincount(begin + many - 1 + width, minlength=len(text) + 1)
                cover = np.cumsum(change[:-1]) > 0
                edge = np.diff(np.concatenate(([0], cover.astype(np.int8), [0])))
                data = np.frombuffer(text, np.uint8)
                # In the text, a character stays whole if any of its bytes stays.
                begin = np.flatnonzero((data & 0xC0) != 0x80)
                whole = np.repeat(np.minimum.reduceat(cover, begin), np.diff(np.append(begin, len(data)))) if len(begin) else cover
                rows.append((len(text), int(cover.sum()), int((edge == 1).sum()), data[~cover].tobytes(), data[~whole].tobytes()))
            if rows:
                types = [pa.int64()] * 3 + [pa.binary()] * 2
                made = [pa.array(x, t) for x, t in zip(zip(*rows), types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("_kept"), *made[:4], made[4].cast(pa.string())], schema.names)

    return docs.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, width: int = 100, key: str = "doc_id", text: str = "text", gram: int = GRAM) -> DataFrame:
    """docs, without the text, with n_bytes, n_removed, n_spans (maximal removed runs), kept_bytes, and kept_text, which
    keeps whole any character of which a byte stays."""
    if gram % 8 or not gram <= width:
        raise ValueError("gram is a multiple of eight bytes, and at most width")
    spark = docs.sparkSession
    work = Work(spark, "suffix-array")
    bounded_batches(spark)
    results = (text, "n_bytes", "n_removed", "n_spans", "kept_bytes", "kept_text")
    kept = [c for c in docs.columns if c not in results]
    _, size = text_bytes(docs, text)
    own = keyed(docs, key, text, kept)
    texts = own.select("_id", "_tie", "_text")
    groups = max(1, -(-size // FRAGMENT))
    hits = work.cut(repeated_tokens(texts, width, gram, groups), "tokens")
    work.release()
    marked = with_marks(texts, hits).filter(F.col("_marks").isNotNull())
    suffixes = work.cut(contexts(marked, width, gram), "suffixes")
    work.drop("tokens")
    total = suffixes.count()
    found = work.cut(sorted_buckets(suffixes, width, gram, max(1, -(-total * 2 * width // BUCKET)), groups), "found")
    work.drop("suffixes")
    starts = work.cut(_later(found, groups), "later")
    work.drop("found")
    removed = _removed(with_marks(own, starts, 2), width)
    return removed.select(*restored(kept), "n_bytes", "n_removed", "n_spans", "kept_bytes", "kept_text")
