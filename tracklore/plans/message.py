"""Queries of message lists, plans, budgets and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklore.functions import edits
from tracklore.operators import messages as M
from tracklore.plans.kpi import USER_LOG, events
from tracklore.plans.registry import query


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("arguments_valid", "SELECT event_id, event_id % 4 IN (0, 3) AS valid FROM events")
def arguments_valid(spark, sf_dir):
    rows = read(spark, sf_dir, "events").selectExpr("event_id", "CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN '[1]' WHEN 2 THEN '{bad' END AS arguments")
    return M.with_arguments(rows).select("event_id", "valid")


@query("cut_calls", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand || ', ' || p_type END AS dropped, CASE WHEN p_size % 2 = 0 THEN 0 ELSE 2 END AS left_calls FROM part")
def cut_calls(spark, sf_dir):
    rows = read(spark, sf_dir, "part").selectExpr("p_partkey", "CASE WHEN p_size % 2 = 0 THEN 'length' ELSE 'stop' END AS finish_reason", "array(named_struct('name', p_brand), named_struct('name', p_type)) AS tool_calls")
    return M.without_cut_calls(rows).select("p_partkey", "dropped", F.size("tool_calls").alias("left_calls"))


@query(
    "dangling_repair",
    f"""WITH {USER_LOG}, b AS (SELECT session_id, k % 10 AS id, pos, kind, sum((kind = 'llm_call')::INT) OVER (PARTITION BY session_id ORDER BY pos) AS block FROM log),
e AS (SELECT session_id, block, max(pos) AS last FROM b GROUP BY ALL),
s AS (SELECT a.session_id, a.id, e.last + 0.5 AS spot, a.pos AS tie, true AS stub FROM b a JOIN e USING (session_id, block) WHERE a.kind = 'tool_call'
  AND NOT EXISTS (SELECT 1 FROM b r WHERE r.session_id = a.session_id AND r.block = a.block AND r.id = a.id AND r.kind = 'tool_output')),
u AS (SELECT session_id, id, pos::DOUBLE AS spot, pos AS tie, false AS stub FROM b UNION ALL SELECT session_id, id, spot::DOUBLE, tie, stub FROM s)
SELECT session_id, id, stub, row_number() OVER (PARTITION BY session_id ORDER BY spot, tie)::INT AS pos FROM u""",
)
def dangling_repair(spark, sf_dir):
    log = events(spark, sf_dir, by_day=False).withColumn("id", F.col("k") % 10)
    kind = F.col("kind")
    return M.repaired(log, kind == "llm_call", kind == "tool_call", kind == "tool_output", "id")


@query(
    "budget_marks",
    f"""WITH {USER_LOG}, r AS (SELECT session_id, pos, sum(k * 100) OVER (PARTITION BY session_id ORDER BY pos) AS total FROM log)
SELECT session_id, min(pos) FILTER (total >= 100000)::INT AS warned_at, min(pos) FILTER (total >= 150000)::INT AS stopped_at FROM r GROUP BY session_id""",
)
def budget_marks(spark, sf_dir):
    return M.budget_marks(events(spark, sf_dir, by_day=False).select("session_id", "pos", (F.col("k") * 100).alias("tokens")), 100_000, 150_000)


@query(
    "research_stats",
    f"""WITH {USER_LOG} SELECT session_id, arg_max(k, pos) FILTER (kind = 'llm_call') AS tokens, count_if(kind = 'tool_call')::BIGINT AS tools,
  coalesce(array_to_string((list(k ORDER BY pos DESC) FILTER (kind = 'tool_call'))[1:4], ','), '') AS last_steps, (epoch_us(max(ts)) // 1000000 - epoch_us(min(ts)) // 1000000)::BIGINT AS elapsed_s
FROM log GROUP BY session_id""",
)
def research_stats(spark, sf_dir):
    return M.research_stats(events(spark, sf_dir, by_day=False))


@query(
    "plan_progress",
    "SELECT o_custkey AS plan_id, count_if(o_orderstatus = 'F')::BIGINT AS done, count(*) AS total, bool_and(o_orderstatus <> 'P') AS valid FROM orders GROUP BY o_custkey",
)
def plan_progress(spark, sf_dir):
    items = read(spark, sf_dir, "orders").selectExpr("o_custkey AS plan_id", "o_orderkey AS id", "o_orderpriority AS content", "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'odd' END AS status")
    return M.plan_progress(items)


@query(
    "section_lookup",
    """WITH s AS (SELECT p_brand AS doc, CASE WHEN p_size % 5 = 0 THEN 'hot gear.' || p_size ELSE p_partkey::VARCHAR END AS id, p_name AS title, p_partkey AS pos FROM part),
t AS (SELECT *, CASE WHEN lower(title) = 'hot gear' THEN 2 WHEN contains(lower(title), 'hot gear') THEN 3 WHEN id LIKE 'hot gear.%' THEN 4 END AS tier FROM s)
SELECT doc, arg_min(id, (tier, pos)) AS id, arg_min(title, (tier, pos)) AS title, min(tier)::INT AS tier FROM t WHERE tier IS NOT NULL GROUP BY doc""",
)
def section_lookup(spark, sf_dir):
    return M.section_lookup(read(spark, sf_dir, "part").selectExpr("p_brand AS doc", "CASE WHEN p_size % 5 = 0 THEN concat('hot gear.', p_size) ELSE cast(p_partkey AS string) END AS id", "p_name AS title", "p_partkey AS pos"), " Hot Gear ")


@query("reused_ids", "SELECT conv_id AS session_id, turn AS index, role, CASE WHEN turn % 2 = 0 THEN 'old-' || turn ELSE 'new-' || turn END AS id FROM conversations")
def reused_ids(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").selectExpr("conv_id AS session_id", "turn AS index", "role", "concat('new-', turn) AS id")
    old = read(spark, sf_dir, "conversations").filter("turn % 2 = 0").selectExpr("conv_id AS session_id", "turn AS index", "role", "concat('old-', turn) AS id")
    return M.reused_ids(rows, old)


@query("markdown_blocks", r"SELECT doc_id, len(list_filter(regexp_split_to_array(replace(text, '. ', '.' || chr(10) || chr(10)), '\n[ \t]*\n'), lambda x: trim(x) <> ''))::INT AS n FROM documents WHERE NOT contains(text, '```') AND NOT regexp_matches(text, '\n\s*\n')")
def markdown_blocks(spark, sf_dir):
    # The SQL knows no fences and leaves out documents that have one or a blank line; these are counted here too.
    return read(spark, sf_dir, "documents").select("doc_id", F.size(edits.markdown_blocks(F.replace(F.col("text"), F.lit(". "), F.lit(".\n\n")))).alias("n"))


@query("apply_edit", "SELECT p_partkey, replace(p_name, ' ', '_') AS text FROM part")
def apply_edit(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", edits.edited("p_name", F.lit(" "), F.lit("_"), F.lit("replace")).alias("text"))
