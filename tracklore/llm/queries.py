"""One query for each operator of this subpackage, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklore.llm import bpe, chat, mixing, neighbours, ngram_join, quality, substring, suffix_array, toxicity, wordpiece

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.round_trip(docs, ranks, pattern).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_conversations(turns))


ORACLES["op8_chat_format"] = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, n, CASE WHEN n = 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) r(n)),
s AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before, len(regexp_extract_all(text, '\\|### Assistant:|### System:|### Other|### User:|</turn>')) AS escapes,
  CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15 ELSE 12 + length(role) + len(regexp_extract_all(role, '\\|### Assistant:|### System:|### Other|### User:|</turn>|:')) END AS opening FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(opening + length(text) + escapes + 9)::BIGINT AS formatted_chars,
  bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before IN ('system', 'assistant') THEN role = 'user' WHEN before = 'user' THEN role = 'assistant' ELSE false END) AS valid
FROM s GROUP BY conv_id
"""


@_query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured = quality.measure(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")
    return quality.judge(measured).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_tokens", "n_byte_tokens", "entropy", "script"
    )


@_query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.ngram_jaccard_join(docs, n=4, percent=85).select("doc_id", "n_shingles", "component_id")


ORACLES["op1_ngram_jaccard_join"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh FROM w),
g AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS h FROM s),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM g a JOIN g b ON a.h = b.h AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
e AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, coalesce(least(s.doc_id, m.y), s.doc_id)::BIGINT AS component_id
FROM s LEFT JOIN (SELECT x, min(y) AS y FROM r GROUP BY x) m ON s.doc_id = m.x
"""


@_query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs, window=35, apart=True).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op2_substring_dedup"] = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) - 33)) AS i, ws FROM w WHERE len(ws) >= 35),
h AS (SELECT doc_id, i, hash(array_to_string(ws[i:i + 34], ' ')) AS h FROM p),
r AS (SELECT h FROM h GROUP BY h HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, i + unnest(range(0, 35)) AS i FROM h SEMI JOIN r USING (h)),
g AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(CASE WHEN gone IS NULL THEN array_to_string(ws, ' ')
    ELSE coalesce(array_to_string(list_transform(list_filter(range(1, len(ws) + 1), lambda j: NOT list_contains(gone, j)), lambda j: ws[j]), ' '), '') END) AS kept_sha256
FROM w LEFT JOIN g ON w.doc_id = g.doc_id
"""


@_query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_array.remove_repeats(docs, width=100).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


@_query
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op4_source_mixing"] = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size, md5(doc_id::VARCHAR) AS digest FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS most, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((place - 1) % 3 + 1)::INT] AS weight FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM w WINDOW o AS (ORDER BY most::DOUBLE / weight, place)),
t AS (SELECT *, CASE WHEN most::DOUBLE / weight <= level THEN most::DOUBLE
    ELSE weight * (SELECT arg_min(level, (most::DOUBLE / weight, place)) FROM l WHERE most::DOUBLE / weight > level) END AS target FROM l),
q AS (SELECT d.*, t.place, t.source_size, t.target, coalesce(sum(size) OVER (PARTITION BY t.place ORDER BY digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, (r * source_size + ahead + size)::DOUBLE / target AS finish FROM (SELECT *, unnest([0, 1, 2]) AS r FROM q WHERE size > 0)),
k AS (SELECT doc_id, size, greatest(0, least(size, (SELECT sum(size) FROM d)
    - coalesce(sum(size) OVER (ORDER BY finish, place, r, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS cut FROM c)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(x.taken, 0)::BIGINT AS taken
FROM q LEFT JOIN (SELECT doc_id, sum(cut) AS taken FROM k GROUP BY doc_id) x ON q.doc_id = x.doc_id
"""


@_query
def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@_query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return wordpiece.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("poor"), "toxic")
    sample = docs.join(F.broadcast(toxicity.bounded(labels, ["poor", "toxic"])), "doc_id")
    chain = toxicity.fit_chain(sample, ["poor", "toxic"])
    return toxicity.score(docs, chain, ["poor", "toxic"])
