"""Queries of ordered events and messages, and of tags."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklore.operators import sequences as S
from tracklore.operators import tags
from tracklore.plans.kpi import LOG, USER_LOG, events
from tracklore.plans.registry import query

MARK = "CASE WHEN kind = 'tool_call' AND k % 11 = 0 THEN 'complete' WHEN kind = 'tool_call' AND k % 13 = 0 THEN 'interrupted' WHEN kind = 'error' THEN 'error' ELSE 'other' END"
CONV = "conv AS (SELECT conv_id AS session_id, turn AS pos, role, text FROM conversations)"


def messages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/conversations.parquet").selectExpr("conv_id AS session_id", "turn AS pos", "role", "text")


def signed(spark, sf_dir):
    return events(spark, sf_dir, by_day=False).withColumn("sig", F.concat_ws("/", "kind", (F.col("k") % 3).cast("string")))


def _outcome_sql(log: str) -> str:
    return f"""WITH {log}, m AS (SELECT session_id, pos, {MARK} AS mark FROM log),
e AS (SELECT session_id, min(pos) FILTER (mark = 'error') AS e FROM m GROUP BY session_id),
c AS (SELECT m.session_id, any_value(e) AS e, max(pos) FILTER (mark = 'complete' AND (e IS NULL OR pos < e)) AS c, max(pos) FILTER (mark = 'interrupted') AS i
  FROM m JOIN e USING (session_id) GROUP BY m.session_id)
SELECT session_id, CASE WHEN i IS NOT NULL AND (c IS NULL OR i > c) THEN 'interrupted' WHEN c IS NOT NULL THEN 'completed' WHEN e IS NOT NULL THEN 'errored' ELSE 'ongoing' END AS outcome FROM c"""


@query("tag_outcome", _outcome_sql(USER_LOG))
def tag_outcome(spark, sf_dir):
    return S.outcome(events(spark, sf_dir, by_day=False).withColumn("mark", F.expr(MARK)))


@query("tag_outcome_by_day", _outcome_sql(LOG))
def tag_outcome_by_day(spark, sf_dir):
    return S.outcome(events(spark, sf_dir).withColumn("mark", F.expr(MARK)))


@query(
    "last_value_by_pos",
    f"""WITH {USER_LOG} SELECT session_id, arg_max(kind, pos) AS last_kind, arg_max(k, pos) FILTER (kind = 'tool_output' AND k >= 50) AS last_numeric
FROM log GROUP BY session_id""",
)
def last_value_by_pos(spark, sf_dir):
    log, numeric = events(spark, sf_dir, by_day=False), (F.col("kind") == "tool_output") & (F.col("k") >= 50)
    return log.groupBy("session_id").agg(F.max_by("kind", "pos").alias("last_kind"), F.max_by(F.when(numeric, F.col("k")), F.when(numeric, F.col("pos"))).alias("last_numeric"))


_SIG = "sig AS (SELECT *, kind || '/' || (k % 3) AS sig FROM log)"


@query(
    "run_length_detect",
    f"""WITH {USER_LOG}, {_SIG}, n AS (SELECT *, CASE WHEN sig IS DISTINCT FROM lag(sig) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS new FROM sig WINDOW w AS (PARTITION BY session_id ORDER BY pos)),
i AS (SELECT *, sum(new) OVER (PARTITION BY session_id ORDER BY pos) AS run FROM n),
r AS (SELECT session_id, run, any_value(sig) AS sig, count(*) AS length FROM i GROUP BY session_id, run HAVING count(*) >= 3)
SELECT session_id, arg_min(sig, run) AS signature, arg_min(length, run) AS length FROM r GROUP BY session_id""",
)
def run_length_detect(spark, sf_dir):
    return S.first_run(signed(spark, sf_dir), "sig")


@query(
    "repeat_tail_detect",
    f"""WITH {USER_LOG}, {_SIG}, b AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY pos DESC) AS back FROM sig),
l AS (SELECT session_id, list(kind ORDER BY pos) AS t FROM b WHERE back <= 30 GROUP BY session_id)
SELECT session_id, list_filter([2, 3, 4, 5], lambda n: len(t) >= 2 * n AND t[-n:] = t[-2 * n:-n - 1])[1] AS pattern_length FROM l""",
)
def repeat_tail_detect(spark, sf_dir):
    return S.repeating_tail(S.lookback(signed(spark, sf_dir), 30), "kind")


@query(
    "signature_counts",
    f"WITH {USER_LOG} SELECT left(md5(kind || ':' || k), 12) AS signature, count(*) AS n FROM log GROUP BY ALL",
)
def signature_counts(spark, sf_dir):
    sig = S.signature(F.concat_ws(":", "kind", F.col("k").cast("string")))
    return events(spark, sf_dir, by_day=False).groupBy(sig.alias("signature")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "malformed_streak",
    f"""WITH {USER_LOG}, t AS (SELECT session_id, pos, 'tool_' || (k % 2) AS name, k % 3 <> 0 AS bad FROM log WHERE kind = 'tool_output'),
f AS (SELECT *, first_value(name) OVER w AS last FROM t WINDOW w AS (PARTITION BY session_id ORDER BY pos DESC)),
o AS (SELECT *, min((bad AND name = last)::INT) OVER (PARTITION BY session_id ORDER BY pos DESC) AS ok FROM f)
SELECT session_id, any_value(last) AS name, sum(ok)::BIGINT AS streak FROM o GROUP BY session_id""",
)
def malformed_streak(spark, sf_dir):
    rows = events(spark, sf_dir, by_day=False).filter("kind = 'tool_output'").selectExpr("session_id", "pos", "concat('tool_', k % 2) AS name", "k % 3 <> 0 AS bad")
    return S.streak(rows, "name", "bad")


@query(
    "toolcall_pair_last",
    f"""WITH {USER_LOG}, r AS (SELECT session_id, k, arg_max(event_id, pos) AS result FROM log WHERE kind = 'tool_output' GROUP BY ALL)
SELECT session_id, k, pos, result FROM log LEFT JOIN r USING (session_id, k) WHERE kind = 'tool_call'""",
)
def toolcall_pair_last(spark, sf_dir):
    log = events(spark, sf_dir, by_day=False)
    calls = log.filter("kind = 'tool_call'").select("session_id", "k", "pos")
    results = log.filter("kind = 'tool_output'").select("session_id", "k", "pos", F.col("event_id").alias("result"))
    return S.pair_last(calls, results, "k")


@query(
    "next_result_before_turn",
    f"""WITH {USER_LOG}, m AS (SELECT session_id, k % 10 AS id, pos, kind, min(pos) FILTER (kind = 'llm_call') OVER (PARTITION BY session_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_turn FROM log)
SELECT a.session_id, a.id, a.pos, min(r.pos) AS result_pos FROM m a LEFT JOIN m r ON r.session_id = a.session_id AND r.id = a.id AND r.kind = 'tool_output' AND r.pos > a.pos AND r.pos < coalesce(a.next_turn, 1000000000)
WHERE a.kind = 'tool_call' GROUP BY ALL""",
)
def next_result_before_turn(spark, sf_dir):
    log = events(spark, sf_dir, by_day=False).withColumn("id", F.col("k") % 10)
    kind = F.col("kind")
    return S.pair_next(log, kind == "tool_call", kind == "tool_output", kind == "llm_call", "id").select("session_id", "id", "pos", "result_pos")


@query(
    "dangling_anti",
    f"""WITH {USER_LOG}, b AS (SELECT session_id, k % 10 AS id, pos, kind, sum((kind = 'llm_call')::INT) OVER (PARTITION BY session_id ORDER BY pos) AS block FROM log)
SELECT session_id, block::BIGINT AS block, id, pos FROM b a WHERE kind = 'tool_call' AND NOT EXISTS (SELECT 1 FROM b r WHERE r.session_id = a.session_id AND r.block = a.block AND r.id = a.id AND r.kind = 'tool_output')""",
)
def dangling_anti(spark, sf_dir):
    log = events(spark, sf_dir, by_day=False).withColumn("id", F.col("k") % 10)
    placed = S.blocks(log, F.col("kind") == "llm_call").select("session_id", "block", "id", "pos", "kind")
    results = placed.filter("kind = 'tool_output'").select("session_id", "block", "id")
    return placed.filter("kind = 'tool_call'").drop("kind").join(results, ["session_id", "block", "id"], "left_anti")


@query(
    "merge_consecutive_role",
    f"""WITH {CONV}, n AS (SELECT *, CASE WHEN role IS DISTINCT FROM lag(role) OVER w THEN 1 ELSE 0 END AS new FROM conv WINDOW w AS (PARTITION BY session_id ORDER BY pos)),
i AS (SELECT *, sum(new) OVER (PARTITION BY session_id ORDER BY pos) AS island FROM n)
SELECT session_id, island::BIGINT AS island, any_value(role) AS role, count(*) AS n, string_agg(text, chr(10) ORDER BY pos) AS text FROM i GROUP BY session_id, island""",
)
def merge_consecutive_role(spark, sf_dir):
    return S.merge_roles(messages(spark, sf_dir))


@query(
    "undo_last_turn",
    f"""WITH {CONV}, c AS (SELECT *, coalesce(max(pos) FILTER (role = 'user' AND pos > 0) OVER (PARTITION BY session_id), 1) AS cut FROM conv)
SELECT session_id, pos, role FROM c WHERE pos < cut""",
)
def undo_last_turn(spark, sf_dir):
    return S.undo_last_turn(messages(spark, sf_dir)).select("session_id", "pos", "role")


@query(
    "truncate_nth_user",
    f"""WITH {CONV}, r AS (SELECT *, sum((role = 'user' AND pos > 0)::INT) OVER (PARTITION BY session_id ORDER BY pos) AS n FROM conv)
SELECT session_id, pos, role FROM r WHERE n <= 1""",
)
def truncate_nth_user(spark, sf_dir):
    return S.truncate_before_user(messages(spark, sf_dir), 1).select("session_id", "pos", "role")


@query(
    "compaction_split",
    f"""WITH {CONV}, a AS (SELECT *, greatest(count(*) OVER w - 5, 1) AS edge, min(pos) FILTER (role = 'user') OVER w AS fu FROM conv WINDOW w AS (PARTITION BY session_id)),
t AS (SELECT *, coalesce(max(pos) FILTER (role = 'user' AND pos <= edge AND pos >= 1) OVER (PARTITION BY session_id), 1) AS tail FROM a)
SELECT session_id, pos, CASE WHEN (pos = 0 AND role = 'system') OR pos = fu THEN 'head' WHEN pos >= tail THEN 'tail' ELSE 'middle' END AS part FROM t""",
)
def compaction_split(spark, sf_dir):
    return S.compaction(messages(spark, sf_dir)).select("session_id", "pos", "part")


@query("user_turn_count", "SELECT conv_id, count_if(role = 'user')::BIGINT AS user_turns, CASE WHEN count_if(role = 'user') < 5 THEN 'short' WHEN count_if(role = 'user') <= 20 THEN 'medium' ELSE 'long' END AS bucket FROM conversations GROUP BY conv_id")
def user_turn_count(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").groupBy("conv_id").agg(F.count_if(F.col("role") == "user").alias("user_turns"))
    return rows.withColumn("bucket", tags.turns_bucket(F.col("user_turns")))


@query("role_profile", "SELECT conv_id, array_to_string(list_sort(list_distinct(list(role))), ',') AS roles, bool_or(role = 'system') AS has_system, arg_max(role, turn) AS last_role, max(length(text))::INT AS longest FROM conversations GROUP BY conv_id")
def role_profile(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/conversations.parquet").groupBy("conv_id").agg(
        F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"), F.bool_or(F.col("role") == "system").alias("has_system"), F.max_by("role", "turn").alias("last_role"), F.max(F.length("text")).alias("longest")
    )


@query(
    "visible_messages",
    f"WITH {CONV} SELECT session_id, pos, text FROM conv WHERE role NOT IN ('system', 'tool') AND NOT starts_with(ltrim(text), '[SYSTEM:')",
)
def visible_messages(spark, sf_dir):
    return messages(spark, sf_dir).filter(~F.col("role").isin("system", "tool") & ~F.startswith(F.ltrim("text"), F.lit("[SYSTEM:"))).select("session_id", "pos", "text")


@query(
    "snapshot_timer",
    None,
)
def snapshot_timer(spark, sf_dir):
    at = events(spark, sf_dir).select("session_id", F.unix_seconds("ts").cast("double").alias("at"))
    return S.snapshot_times(at, 3600.0)
