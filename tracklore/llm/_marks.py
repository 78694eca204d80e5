"""Documents and their marks, used by both removers of repeated passages.

A document is what has one (doc_id, text): rows that repeat both are one document and get the same result, rows that repeat
the doc_id alone are documents of their own, ordered by a hash of their text. A null doc_id comes before all others."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklore.llm._work import aside

NULL_ID = -(2**63)


def keyed(docs: DataFrame, key: str, text: str, kept: list[str]) -> DataFrame:
    """The columns `kept` in one, _id and _tie (which together name a document) and _text (never null)."""
    body, name = F.col(text), F.col(key)
    return docs.select(aside(kept), F.coalesce(name.cast("long"), F.lit(NULL_ID)).alias("_id"), F.xxhash64(body, name.isNull()).alias("_tie"), F.coalesce(body, F.lit("")).alias("_text"))


#: Marks of many documents in one row for each bucket of documents, so that rows grow with tasks, not with documents.
PACKED_MARKS = "bucket int, ids binary, ties binary, counts binary, values binary"
MARKS = "_id long, _tie long, _marks binary"


def _edges(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    change = np.ones(len(columns[0]), bool)
    change[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(change)


def packed_marks(ids: np.ndarray, ties: np.ndarray, values: np.ndarray, buckets: int) -> pa.Table:
    """One mark (a row of uint32) for each id and tie, by bucket and document."""
    values = (values if values.ndim == 2 else values[:, None]).astype(np.uint32)
    spread = (ids.view(np.uint64) ^ ties.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    bucket = (((spread >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)
    order = np.lexsort((values[:, 0], ties, ids, bucket)) if len(ids) else np.zeros(0, np.int64)
    ids, ties, values, bucket = ids[order], ties[order], values[order], bucket[order]
    document = _edges(bucket, ids, ties) if len(ids) else np.zeros(0, np.int64)
    counts = np.diff(np.append(document, len(ids))).astype(np.uint32)
    first = _edges(bucket[document]) if len(ids) else np.zeros(0, np.int64)
    rows = [[], [], [], [], []]
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(document)]):
        here = document[a:b]
        stop = document[b] if b < len(document) else len(ids)
        for column, x in zip(rows, (int(bucket[here[0]]), ids[here].tobytes(), ties[here].tobytes(), counts[a:b].tobytes(), values[here[0] : stop].tobytes())):
            column.append(x)
    return pa.table([pa.array(c, t) for c, t in zip(rows, (pa.int32(), *[pa.binary()] * 4))], [x.split()[0] for x in PACKED_MARKS.split(", ")])


def with_marks(docs: DataFrame, packed: DataFrame, width: int = 1) -> DataFrame:
    """keyed docs with the binary _marks that packed rows (of marks of `width` numbers) hold for each document."""

    def unpack(table: pa.Table) -> pa.Table:
        ids, ties, counts, values = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("ids", np.int64), ("ties", np.int64), ("counts", np.uint32), ("values", np.uint32)))
        ids, ties, values = np.repeat(ids, counts), np.repeat(ties, counts), values.reshape(-1, width)
        order = np.lexsort((values[:, 0], ties, ids))
        ids, ties, raw = ids[order], ties[order], values[order].tobytes()
        document = _edges(ids, ties)
        cut = (np.append(document, len(ids)) * 4 * width).tolist()
        return pa.table([pa.array(ids[document]), pa.array(ties[document]), pa.array([raw[a:b] for a, b in zip(cut, cut[1:])], pa.binary())], ["_id", "_tie", "_marks"])

    return docs.join(packed.groupBy("bucket").applyInArrow(unpack, MARKS), ["_id", "_tie"], "left")


def marks_of(column, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x or b"", dtype) for x in column.to_pylist()]


def covered(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """Which of `size` places lie in a window of `width` that begins at one of `starts`."""
    change = np.bincount(starts, minlength=size + 1)[: size + 1] - np.bincount(np.minimum(starts + width, size), minlength=size + 1)[: size + 1]
    return np.cumsum(change[:size]) > 0

