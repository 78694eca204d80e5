"""A corpus from documents: quality rules, near duplicates, repeated passages, source mixing, and token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result and rereads it for the next. All
but the last keep the columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklore.llm import bpe, mixing, ngram_join, quality, suffix_array
from tracklore.llm._work import Work, row_hash

#: A stage in SQL is not to be had: the rules need a tokeniser, and suffixes of whole tables are too many. See tests/llm.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    measured = quality.measure(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return quality.judge(measured).filter("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that links on five words and a similarity of 0.8 join: the one with the smallest id, null being
    the largest, then the smallest hash of its columns. Rows without words are in no group and all stay."""
    work = Work(spark, "near-duplicates")
    # Rows with one hash are alike and in one group.
    keyed = docs.withColumn("_row", row_hash(docs))
    marked = ngram_join.ngram_jaccard_join(keyed.select("_row", "doc_id", "text"), n=5, percent=80, key="_row")
    alike = marked.filter("n_shingles > 0").groupBy("component_id", "doc_id", "_row").agg(F.count(F.lit(1)).alias("copies"))
    first = alike.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row", "copies")).alias("x"))
    empty = marked.filter("n_shingles = 0").select("_row", F.lit(1).cast("long").alias("copies"))
    stays = work.cut(first.select("x._row", "x.copies").union(empty), "stays")
    out = keyed.join(stays.filter("copies = 1"), "_row", "left_semi")
    repeated = stays.filter("copies > 1")
    if not repeated.isEmpty():
        out = out.union(keyed.join(repeated, "_row", "left_semi").select(*out.columns).dropDuplicates(["_row"]))
    return out.select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes or more that an earlier document has; texts of nothing else go."""
    cut = suffix_array.remove_repeats(docs, width=100)
    left = cut.filter((F.col("n_removed") == 0) | (F.length(F.trim("kept_text")) > 0))
    return left.withColumns({"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}).select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, and whether the ids decode to the text."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    both = bpe.round_trip(docs.select("doc_id", "source", "text", digest.alias("digest")), ranks, pattern)
    return both.select("doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", (F.sha2("decoded", 256) == F.col("digest")).alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mixing", source_mixing),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.cut(stage(spark, docs, sf_dir), name)
        work.release()
    return docs
