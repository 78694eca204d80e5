"""Approximate nearest neighbours by inner product, with randomly rotated one-bit codes.

A vector o with residual r = o - centre keeps one bit for each dimension, the sign of the rotated residual, and three
numbers: <o, centre> is not needed, but |r|, and a = <unit residual, code>, its agreement with its code. For a query q,
<o, q> = <centre, q> + |r| <unit residual, q>, and <code, q> / a estimates the last factor without bias; its error is at
most ERRORS * |q| * sqrt((1 / a**2 - 1) / (dimensions - 1)) but for odds that fall exponentially with ERRORS.

Index: all vectors, packed in blocks of rows; only the centre is fitted, on the SAMPLE vectors with the smallest hashes of
their ids. Search: packed blocks of queries meet packed blocks of the index, in which vectors of single precision stay such.
Estimates come from counts of bits that codes and bit planes of the query have in common. In each pair of blocks the FIRST
best estimates (the best of each part of the block) are computed exactly; every vector whose upper bound reaches the k-th best
of these is computed exactly too, so no list of candidates is cut. Exact scores are double sums over dimensions in order. The best k of each block are merged.

Vectors that are null, zero, or hold a null or non-finite component take no part, nor do rows with a null id or with
another number of dimensions than most (the larger, if tied). Rows alike in id and vector count once; a query is not
compared with rows that have its id. Ties go to the smaller id. Extra columns are ignored. An empty table gives an
empty table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklore.llm._work import Work, bounded_batches, held

#: Rows in one block of the index, and of queries.
ROWS, QUERIES = 16_384, 8_192
SAMPLE = 16_384
FIRST = 256
#: Widths of the error bound. On uniform vectors of 64 dimensions 1.6 keeps 0.97 to 0.98 of the true neighbours and computes a tenth
#: of all products exactly; 2.2 keeps 0.99 and computes a fifth.
ERRORS = 1.6
#: Bits of a query's coordinates in the estimates, and queries at once.
LEVELS, AT_ONCE = 4, 64


def rotation(dimensions: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed bits, residual norms, and agreements of the codes."""
    residual = vectors - centre
    norm = np.sqrt((residual**2).sum(1))
    unit = (residual / np.where(norm > 0, norm, 1)[:, None]) @ turn
    agree = np.abs(unit).sum(1) / np.sqrt(vectors.shape[1])
    return np.packbits(unit > 0, axis=1), norm, np.where(norm > 0, agree, 1.0)


def exact(columns: np.ndarray, row: np.ndarray, queries: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Inner products of paired rows and queries (of double precision), both by columns, as double sums over dimensions in order."""
    total = np.zeros(len(row))
    for d in range(len(columns)):
        total += columns[d].take(row) * queries[d].take(which)
    return total


def _words(bits: np.ndarray) -> np.ndarray:
    """Packed bits as 64-bit words, one row of them after the other."""
    return np.ascontiguousarray(np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8))).view(np.uint64).T)


def _upper(words, norm, agree, dimensions: int, turned: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Upper bounds of the residuals' inner products with turned queries, from packed bits alone: a query's coordinates are
    rounded to LEVELS bits, and counts of common bits with its bit planes are the product with each code."""
    low = turned.min(1)
    step = np.maximum((turned.max(1) - low) / (2**LEVELS - 1), 1e-30)
    level = np.round((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    count = np.zeros((len(turned), words.shape[1]), np.uint32)
    for plane in range(LEVELS):
        for query, code in zip(_words(np.packbits((level >> plane) & 1, axis=1)), words):
            count += np.bitwise_count(query[:, None] & code).astype(np.uint32) << plane
    ones = sum(np.bitwise_count(w).astype(np.float32) for w in words)
    product = 2 * (low[:, None].astype(np.float32) * ones + step[:, None].astype(np.float32) * count)
    product -= (low * dimensions + step * level.sum(1))[:, None].astype(np.float32)
    product *= (norm / (agree * np.sqrt(dimensions))).astype(np.float32)
    error = ERRORS * norm * np.sqrt(np.maximum(0, 1 / agree**2 - 1) / max(1, dimensions - 1))
    return product + size[:, None].astype(np.float32) * error.astype(np.float32)


def _best(ids, columns, codes, query_ids, queries, centre, turn, k: int):
    """For each query of a few: row numbers (ids are sorted) and exact scores that hold the block's best k but for the odds of
    the error bound."""
    n, many = len(ids), len(queries)
    by_column = np.ascontiguousarray(queries.T)
    upper = _upper(*codes, queries.shape[1], queries @ turn, np.sqrt((queries**2).sum(1)))
    low, high = np.searchsorted(ids, query_ids), np.searchsorted(ids, query_ids, "right")
    for i in np.flatnonzero(high > low):
        upper[i, low[i] : high[i]] = -np.inf
    # The best bound of each of FIRST or more parts of the block gives rows whose exact scores set the line.
    parts = np.append(np.arange(0, n, max(1, n // FIRST)), n)
    tops = [upper[:, a:b].argmax(1) + a for a, b in zip(parts[:-1], parts[1:])]
    first = np.column_stack(tops)
    which = np.repeat(np.arange(many), first.shape[1])
    score = exact(columns, first.ravel(), by_column, which).reshape(first.shape)
    score[(first >= low[:, None]) & (first < high[:, None])] = -np.inf
    line = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k] if score.shape[1] >= k else np.full(many, -np.inf)
    shift = queries @ centre
    which, row = np.nonzero(upper >= (line - shift - 1e-5 * (1 + np.abs(line)))[:, None].astype(np.float32))
    keep = (row < low[which]) | (row >= high[which])
    which, row = which[keep], row[keep]
    return which, row, exact(columns, row, by_column, which)


def _packed(rows: DataFrame, size: int, total: int, centre: np.ndarray | None, turn: np.ndarray | None) -> DataFrame:
    """One row for each block: ids, vectors and, for an index, codes with their numbers."""
    blocks = max(1, -(-total // size))

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        flat = table.column("vector").combine_chunks().flatten().to_numpy()
        vectors = flat.reshape(len(ids), -1)[order]
        codes = (b"", b"", b"") if centre is None else tuple(x.tobytes() for x in encode(vectors.astype(np.float64), centre, turn))
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()), "ids": [ids[order].tobytes()], "vectors": [vectors.tobytes()], "bits": [codes[0]], "norm": [codes[1]], "agree": [codes[2]]})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInArrow(pack, "block int, ids binary, vectors binary, bits binary, norm binary, agree binary")


def _valid(table: DataFrame, key: str, vector: str) -> DataFrame:
    numbers = F.col(vector) if dict(table.dtypes)[vector] == "array<float>" else F.col(vector).cast("array<double>")
    good = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(numbers, lambda x: x != 0)
    return table.select(F.col(key).cast("long").alias("vec_id"), numbers.alias("vector")).filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & good)


def nearest(table: DataFrame, every: int = 20, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by `every`, its k nearest among all rows."""
    spark = table.sparkSession
    work = Work(spark, "neighbours")
    result = "query_id long, query int, vec_id long, score double"
    valid = _valid(table, key, vector)
    most = valid.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimensions = most["d"]
    rows = work.cut(valid.filter(F.size("vector") == dimensions).dropDuplicates(["vec_id", "vector"]), "valid")
    sample = rows.orderBy(F.xxhash64("vec_id", "vector")).limit(SAMPLE).select("vector").toArrow().column(0)
    centre = sample.combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, dimensions).mean(0)
    kind = np.float32 if dict(rows.dtypes)["vector"] == "array<float>" else np.float64
    turn = rotation(dimensions)
    total, asked = rows.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % every == 0)).first()
    if not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    query_blocks = max(1, -(-asked // QUERIES))
    index = work.cut(_packed(rows, ROWS, total, centre, turn), "index")
    queries = work.cut(_packed(rows.filter(F.col("vec_id") % every == 0), QUERIES, asked, None, None), "queries")
    dealt = index.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    pairs = dealt.join(queries.select(F.col("block").alias("query_block"), F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors")), "query_block")
    bounded_batches(spark)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("neighbours", object)
        for batch in batches:
            # One pair of blocks at a time, however many a batch has.
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                ids, query_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["query_ids"], np.int64)
                vectors = np.frombuffer(row["vectors"], kind).reshape(len(ids), -1)
                queries = np.frombuffer(row["query_vectors"], kind).astype(np.float64).reshape(len(query_ids), -1)
                bits = np.frombuffer(row["bits"], np.uint8).reshape(len(ids), -1)
                norm, agree = np.frombuffer(row["norm"]), np.frombuffer(row["agree"])
                codes, columns = (_words(bits), norm, agree), np.ascontiguousarray(vectors.T)
                for a in range(0, len(query_ids), AT_ONCE):
                    some = queries[a : a + AT_ONCE]
                    which, at, score = _best(ids, columns, codes, query_ids[a : a + AT_ONCE], some, centre, turn, k)
                    order = np.lexsort((ids[at], -score, which))
                    which, at, score = which[order], at[order], score[order]
                    begin = np.searchsorted(which, np.arange(len(some)))
                    keep = np.arange(len(which)) - begin[which] < k
                    which, at, score = which[keep], at[keep], score[keep]
                    yield pa.RecordBatch.from_arrays([pa.array(query_ids[a + which]), pa.array((which + a).astype(np.int32)), pa.array(ids[at]), pa.array(score)], ["query_id", "query", "vec_id", "score"])

    found = pairs.repartition(max(1, query_blocks * -(-total // ROWS)), "query_block", "block").mapInArrow(search, result)
    # `query` tells apart rows that share an id.
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
