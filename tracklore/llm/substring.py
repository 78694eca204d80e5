"""Removal of word passages that occur more than once, by fixed-block anchors.

Any passage of `window` words holds a whole block of BLOCK = (window + 1) // 2 words that begins at a multiple of BLOCK in
its document. These blocks are the index; every rolling window of BLOCK words, in every document, probes it:

1. Blocks and probes meet by hash in fragments, packed by buffers of documents. Where a block occurs elsewhere too, each
   of the places is an anchor. A hash that a buffer has several times is sent once, without its places, which that buffer
   sends as candidates straight to their documents; a passage of very many documents is so one row a buffer.
2. Each anchor is extended to all windows of `window` words that hold it. Overlapping windows are one passage, so a hit
   grows to its maximal exact repeat. The windows' hashes meet in fragments, and those at two places or more are repeats.
3. Documents, joined with the starts of their repeats, lose the words that these cover.

Repeats are judged on the input. Hashes of windows have 64 bits; of blocks, which only choose candidates, 32 and
the fragment are compared. Null text has no words;
documents of fewer than `window` words lose nothing. See _marks for repeated rows and null ids; with `apart`, each row is a
document of its own, so that rows alike in id and text lose all words of each. Other columns pass
unchanged, those named like results are replaced. An empty table gives an empty table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklore.llm._hash import Words, windows
from tracklore.llm._marks import PACKED_MARKS, covered, keyed, marks_of, packed_marks, with_marks
from tracklore.llm._work import Work, bounded_batches, groups_of, restored, text_bytes, texts_of

FRAGMENT = 18_000_000
BUFFER = 2_000_000
_32 = np.uint64(32)
_PACKED = "fragment int, kind byte, ids binary, ties binary, counts binary, places binary, hashes binary"
_NAMES = [x.split()[0] for x in _PACKED.split(", ")]
_TYPES = [pa.int32(), pa.int8(), *[pa.binary()] * 5]
_PLACED, _SEEN, _KNOWN = 0, 1, 2


def _pack(x: np.ndarray, wide: bool) -> bytes:
    """Hashes with all bits, or the lower 32, which the fragment adds to."""
    return x.tobytes() if wide else x.astype(np.uint32).tobytes()


def _unpack(data: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(data, np.uint64 if wide else np.uint32)


def _pack_ids(ids: np.ndarray) -> bytes:
    """Byte by byte: the higher bytes of ids are alike, and shrink in the shuffle."""
    return np.ascontiguousarray(ids).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack_ids(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def _pack_places(place: np.ndarray) -> bytes:
    """Differences of places, byte by byte: the higher bytes are nearly all zero, and shrink in the shuffle."""
    return np.diff(place.astype(np.uint32), prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack_places(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.uint32).ravel(), dtype=np.uint32)


def _deal(hashes: np.ndarray, owner: np.ndarray, place: np.ndarray, ids: np.ndarray, ties: np.ndarray, fragments: int, known: np.ndarray, wide: bool) -> Iterator[tuple]:
    """Rows of _PACKED for places (with owner, place) of one buffer; places flagged `known` are repeats for certain."""
    frag = (((hashes >> _32) * np.uint64(fragments)) >> _32).astype(np.int64)

    def rows(kind: int, at: np.ndarray, target: np.ndarray) -> Iterator[tuple]:
        order = np.argsort(target, kind="stable")
        at, target = at[order], target[order]
        cut = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1], [True]))) if len(at) else []
        for a, b in zip(cut[:-1], cut[1:]):
            part = at[a:b]
            if kind == _SEEN:
                yield int(target[a]), kind, b"", b"", b"", b"", _pack(hashes[part], wide)
                continue
            own = owner[part]
            run = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            who = own[run]
            yield int(target[a]), kind, _pack_ids(ids[who]), ties[who].tobytes(), np.diff(np.append(run, len(own))).astype(np.uint32).tobytes(), _pack_places(place[part]), _pack(hashes[part], wide) if kind == _PLACED else b""

    yield from rows(_PLACED, np.flatnonzero(~known), frag[~known])
    at = np.flatnonzero(known)
    _, first = np.unique(hashes[at], return_index=True)
    yield from rows(_SEEN, at[first], frag[at[first]])
    spread = ((ids[owner[at]].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> _32) * np.uint64(fragments) >> _32).astype(np.int64)
    yield from rows(_KNOWN, at, spread)


def _repeated_here(hashes: np.ndarray, owner: np.ndarray, place: np.ndarray, ids: np.ndarray, ties: np.ndarray) -> np.ndarray:
    """Which hashes occur at two places of the buffer; places of rows that are one document are one."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    one, two = order[:-1], order[1:]
    other = (ids[owner[one]] != ids[owner[two]]) | (ties[owner[one]] != ties[owner[two]]) | (place[one] != place[two])
    out = np.zeros(len(hashes), bool)
    # A run counts if any two of its neighbours are different places.
    run = np.cumsum(np.concatenate(([True], ~same))) - 1 if len(hashes) else np.zeros(0, np.int64)
    good = np.zeros(len(hashes), bool)
    good[run[1:][same & other]] = True
    out[order] = good[run]
    return out


def _meet(table: pa.Table, blocks: int, wide: bool, buckets: int) -> pa.Table:
    """Of one fragment: places whose hash is at another place too and, where `blocks`, of which one is a block."""
    kinds = table.column("kind").to_pylist()
    ids, ties, counts, places, packed = (table.column(c).to_pylist() for c in _NAMES[2:])
    at = {k: [i for i, x in enumerate(kinds) if x == k] for k in (_PLACED, _SEEN, _KNOWN)}

    def gathered(kind: int):
        flat = lambda column, dtype: np.frombuffer(b"".join(column[i] for i in at[kind]), dtype)
        many = flat(counts, np.uint32)
        return np.repeat(np.concatenate([_unpack_ids(ids[i]) for i in at[kind]] or [np.zeros(0, np.int64)]), many), np.repeat(flat(ties, np.int64), many), np.concatenate([_unpack_places(places[i]) for i in at[kind]] or [np.zeros(0, np.uint32)])

    own, tie, place = gathered(_PLACED)
    hashes = np.concatenate([_unpack(packed[i], wide) for i in at[_PLACED]] or [np.zeros(0, np.uint64 if wide else np.uint32)])
    seen = np.unique(np.concatenate([_unpack(packed[i], wide) for i in at[_SEEN]] or [np.zeros(0, np.uint64 if wide else np.uint32)]))
    if len(hashes):
        order = np.argsort(hashes, kind="stable")
        hashes, own, tie, place = hashes[order], own[order], tie[order], place[order]
        same = hashes[1:] == hashes[:-1]
        other = same & ((own[1:] != own[:-1]) | (tie[1:] != tie[:-1]) | (place[1:] != place[:-1]))
        run = np.cumsum(np.concatenate(([True], ~same))) - 1
        start = np.flatnonzero(np.concatenate(([True], ~same)))
        met = np.zeros(len(start), bool)
        met[run[1:][other]] = True
        if blocks:
            met &= np.logical_or.reduceat(place % blocks == 0, start)
        if len(seen):
            met |= seen[np.minimum(np.searchsorted(seen, hashes[start]), len(seen) - 1)] == hashes[start]
        keep = met[run]
        own, tie, place = own[keep], tie[keep], place[keep]
    more = gathered(_KNOWN)
    return packed_marks(np.concatenate([own, more[0]]), np.concatenate([tie, more[1]]), np.concatenate([place, more[2]]), buckets)


def _emit(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _TYPES, strict=True)], _NAMES)


def _inside(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that lie in one text: first word, owner, and place of that word in the text."""
    owner = words.owner()
    n = max(0, len(owner) - width + 1)
    at = np.flatnonzero(owner[:n] == owner[width - 1 :][:n])
    return at, owner[at], at - words.first[owner[at]]


def anchors(docs: DataFrame, block: int, fragments: int) -> DataFrame:
    """_id, _tie, _marks: places (uint32, by word) of keyed docs where an indexed block occurs that is elsewhere too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts = texts_of(batch.column(2))
            for a, b in groups_of(texts, BUFFER):
                words = Words(texts[a:b])
                at, owner, place = _inside(words, block)
                if not len(at):
                    continue
                hashes = windows(words.hash, block)[at]
                twice = _repeated_here(hashes, owner, place, ids[a:b], ties[a:b])
                # Within the buffer too, a block has to be among the places.
                blocks = np.unique(hashes[twice & (place % block == 0)])
                known = twice & np.isin(hashes, blocks)
                yield from _emit(list(_deal(hashes, owner, place, ids[a:b], ties[a:b], fragments, known, False)))

    return docs.select("_id", "_tie", "_text").mapInArrow(run, _PACKED).groupBy("fragment").applyInArrow(lambda t: _meet(t, block, False, fragments), PACKED_MARKS)


def repeats(docs: DataFrame, window: int, block: int, fragments: int) -> DataFrame:
    """_id, _tie, _marks: first words (uint32) of windows at two places or more, of keyed docs with anchors as _marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts, hits = texts_of(batch.column(2)), marks_of(batch.column(3), np.uint32)
            for a, b in groups_of(texts, BUFFER):
                words = Words(texts[a:b])
                near = np.zeros(len(words.hash) + 1, bool)
                for i in range(a, b):
                    if len(hits[i]) and words.count[i - a] >= window:
                        # Windows that hold the block at h begin from h - (window - block) to h.
                        back = window - block
                        spot = hits[i].astype(np.int64)
                        size = int(words.count[i - a])
                        begin = np.maximum(spot - back, 0)
                        change = np.bincount(begin, minlength=size + 1)[: size + 1] - np.bincount(np.minimum(spot + 1, size), minlength=size + 1)[: size + 1]
                        first = words.first[i - a]
                        near[first : first + size] |= np.cumsum(change[:size]) > 0
                at, owner, place = _inside(words, window)
                use = near[at]
                at, owner, place = at[use], owner[use], place[use]
                if not len(at):
                    continue
                hashes = windows(words.hash, window)[at]
                known = _repeated_here(hashes, owner, place, ids[a:b], ties[a:b])
                yield from _emit(list(_deal(hashes, owner, place, ids[a:b], ties[a:b], fragments, known, True)))

    return docs.select("_id", "_tie", "_text", "_marks").mapInArrow(run, _PACKED).groupBy("fragment").applyInArrow(lambda t: _meet(t, 0, True, fragments), PACKED_MARKS)


def _removed(docs: DataFrame, window: int) -> DataFrame:
    schema = T.StructType([docs.schema["_kept"], *(T.StructField(x, T.LongType()) for x in ("n_words", "n_removed")), T.StructField("kept_text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, starts = texts_of(batch.column("_text")), marks_of(batch.column("_marks"), np.uint32)
            counts, gone, out = [], [], []
            for text, start in zip(texts, starts, strict=True):
                words = text.split()
                cover = covered(np.unique(start).astype(np.int64), window, len(words)) if len(start) else None
                counts.append(len(words))
                gone.append(int(cover.sum()) if cover is not None else 0)
                out.append(b" ".join(words if cover is None else [words[i] for i in np.flatnonzero(~cover)]))
            yield pa.RecordBatch.from_arrays([batch.column("_kept"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())], schema.names)

    return docs.mapInArrow(run, schema)


def _copies(texts: DataFrame, window: int, buckets: int) -> DataFrame:
    """Packed marks over all words of keyed docs that several rows are."""
    several = texts.groupBy("_id", "_tie").count().filter("count > 1").select("_id", "_tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [len(x.split()) - window for x in texts_of(batch.column(2))]
            starts = [np.append(np.arange(0, n, window), n) if n >= 0 else np.zeros(0, np.int64) for n in counts]
            many = [len(x) for x in starts]
            if sum(many):
                ids, ties = (np.repeat(batch.column(k).to_numpy(), many) for k in (0, 1))
                yield from packed_marks(ids, ties, np.concatenate(starts), buckets).to_batches()

    return texts.join(several, ["_id", "_tie"], "left_semi").dropDuplicates(["_id", "_tie"]).select("_id", "_tie", "_text").mapInArrow(run, PACKED_MARKS)


def remove_repeats(docs: DataFrame, window: int = 50, key: str = "doc_id", text: str = "text", apart: bool = False) -> DataFrame:
    """docs, without the text, with n_words, n_removed and kept_text (kept words joined by single spaces)."""
    spark = docs.sparkSession
    work = Work(spark, "substring")
    bounded_batches(spark)
    block = (window + 1) // 2
    _, size = text_bytes(docs, text)
    fragments = max(1, -(-size // FRAGMENT))
    kept = [c for c in docs.columns if c not in (text, "n_words", "n_removed", "kept_text")]
    own = keyed(docs, key, text, kept)
    texts = own.select("_id", "_tie", "_text")
    hits = work.cut(anchors(texts, block, fragments), "anchors")
    work.release()
    candidates = with_marks(texts, hits).filter(F.col("_marks").isNotNull())
    starts = work.cut(repeats(candidates, window, block, fragments), "repeats")
    work.drop("anchors")
    if apart and not texts.groupBy("_id", "_tie").count().filter("count > 1").isEmpty():
        starts = starts.union(work.cut(_copies(texts, window, fragments), "copies"))
    return _removed(with_marks(own, starts), window).select(*restored(kept), "n_words", "n_removed", "kept_text")
