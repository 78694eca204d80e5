"""Queries over whole session rows: JSON documents with nested events and messages, made from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklore.operators import trajectories
from tracklore.plans.registry import query
from tracklore.sources import event_log

_KIND = """CASE event_type
    WHEN 'purchase' THEN CASE WHEN k % 10 = 0 THEN 'hf_job_submit' WHEN k % 10 = 5 THEN 'hf_job_complete' ELSE 'llm_call' END
    WHEN 'click' THEN CASE WHEN k % 10 = 1 THEN 'pro_cta_click' WHEN k % 10 = 2 THEN 'jobs_access_blocked' ELSE 'tool_call' END
    WHEN 'view' THEN CASE WHEN k % 10 = 3 THEN 'tool_log' ELSE 'tool_output' END
    WHEN 'signup' THEN CASE k % 8 WHEN 0 THEN 'undo_complete' WHEN 1 THEN 'sandbox_create' WHEN 2 THEN 'sandbox_destroy' WHEN 3 THEN 'compacted' WHEN 4 THEN 'turn_complete' WHEN 5 THEN 'interrupted' ELSE 'feedback' END
    ELSE CASE WHEN k % 4 = 0 THEN 'error' ELSE 'turn_complete' END END"""
_FLAVORS = "cpu-basic cpu-upgrade t4-small l4x1 l4x4 l40sx8 a10g-large a10g-largex2 a100x4 h100 h100x8 unheard-of".split()
_GPUS = [0, 0, 1, 1, 4, 8, 1, 2, 4, 1, 8, 0]
_FAMILIES = "none none t4 l40s l40s l40s a10g a10g a100 h100 h100 none".split()
_TOOLS = ["hf_jobs", "plan", "web_search", "hf_inspect_dataset", "sandbox_exec", "generate", "research"]
_SCRIPTS = ["from trl import SFTTrainer", "echo hello", "python finetune.py"]
_STATES = ["COMPLETED", "succeeded", "failed", "timeout", "running"]
_MODELS = ["org/Claude-Opus", "sonnet-x", "b/haiku", "Kimi", "gpt-9", "deepseek", "Qwen", "llama", "other-one"]
_OUTPUTS = ["done", "torch.OutOfMemoryError", "CUDA out of memory", "a room", "fine", "well"]


def _list(names) -> str:
    return "[" + ", ".join(repr(x) for x in names) + "]"


#: Events as the rows have them, with their session and the position in it.
EVENTS = f"""ev AS (SELECT *, {_KIND} AS kind, row_number() OVER (PARTITION BY session_id ORDER BY event_id) AS pos,
    ({_list(_FLAVORS)})[k % 12 + 1] AS flavor, ({_list(_GPUS)})[k % 12 + 1] AS gpus, ({_list(_FAMILIES)})[k % 12 + 1] AS family, ({_list(_TOOLS)})[k % 7 + 1] AS tool,
    CASE WHEN k % 7 = 0 THEN ({_list(_SCRIPTS)})[k % 3 + 1] END AS script, ({_list(_STATES)})[k % 5 + 1] AS state, ({_list(_OUTPUTS)})[k % 6 + 1] AS output,
    ({_list(_MODELS)})[user_id % 9 + 1] AS model
  FROM (SELECT event_id, user_id, ts, value, event_type, (props->>'$.k')::INT AS k, user_id || '_' || strftime(ts, '%Y-%m-%d') AS session_id,
    strftime(date_trunc('hour', min(ts) OVER (PARTITION BY user_id, ts::DATE)), '%Y-%m-%d %H:%M:%S') AS started FROM events))"""


def session_rows(spark, sf_dir):
    """Persisted session rows, as event_log.sessions() reads them: a document for each user and day."""
    ts = F.col("ts").cast("timestamp")
    raw = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", ts.alias("ts"), "value", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    pick = lambda names, at: F.get(F.array(*map(F.lit, names)), (at % len(names)).cast("int"))
    only = lambda kind, value: F.when(F.col("kind") == kind, value)
    k, usage = F.col("k"), F.col("kind") == "llm_call"
    flavored = F.col("kind").isin("hf_job_submit", "hf_job_complete")
    data = F.struct(
        only("llm_call", F.col("value") / 1000).alias("cost_usd"), *(F.when(usage, k * n).alias(c) for c, n in (("prompt_tokens", 10), ("completion_tokens", 5), ("cache_read_tokens", 3), ("cache_creation_tokens", 1))),
        only("tool_call", pick(_TOOLS, k)).alias("tool"), only("tool_call", F.when(k % 7 == 0, F.struct(pick(_SCRIPTS, k).alias("script")))).alias("arguments"),
        only("tool_output", k % 2 == 0).alias("success"), only("tool_output", pick(_OUTPUTS, k)).alias("output"),
        only("hf_job_submit", k % 20 == 0).alias("push_to_hub"), F.when(flavored, pick(_FLAVORS, k)).alias("flavor"), only("hf_job_complete", pick(_STATES, k)).alias("final_status"), only("hf_job_complete", F.col("value")).alias("wall_time_s"),
        only("sandbox_create", pick(_FLAVORS, k)).alias("hardware"), only("sandbox_destroy", k * 40).alias("lifetime_s"), only("feedback", F.when(k % 3 == 0, "up").otherwise("down")).alias("rating"),
        only("tool_log", F.when(k == 13, "Doom loop found").otherwise("log")).alias("log"), only("pro_cta_click", F.when(k % 3 > 0, F.concat(F.lit("page_"), (k % 3).cast("string")))).alias("source"),
    )
    events = raw.withColumn("kind", F.expr(_KIND)).withColumn("event", F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"), F.col("kind").alias("event_type"), data.alias("data")))
    said = F.struct(F.when(usage, "user").otherwise("tool").alias("role"), F.col("kind").alias("content"))
    in_order = lambda c: F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("event_id", F.col(c).alias("x")))), lambda y: y.x))
    whole = events.withColumn("said", said).groupBy("user_id", F.to_date("ts").alias("day")).agg(F.min("ts").alias("first"), in_order("event").alias("events"), in_order("said").alias("messages"))
    row = F.to_json(
        F.struct(
            F.concat(F.col("user_id").cast("string"), F.lit("_"), F.date_format("day", "yyyy-MM-dd")).alias("session_id"), F.date_format(F.date_trunc("hour", "first"), "yyyy-MM-dd HH:mm:ss").alias("session_start_time"),
            pick(_MODELS, F.col("user_id")).alias("model_name"), F.col("user_id").cast("string").alias("user_id"), "messages", "events",
        )
    )
    return event_log.sessions(whole.select(row.alias("value")))


def _session_sql() -> str:
    hours = "sum(value * gpus / 3600.0) FILTER (kind = 'hf_job_complete')"
    return f"""SELECT session_id, any_value(started) AS started, any_value(user_id)::VARCHAR AS user, count_if(kind = 'llm_call')::BIGINT AS turns, count_if(kind = 'llm_call')::BIGINT AS llm_calls,
  coalesce(sum(k * 10) FILTER (kind = 'llm_call'), 0)::BIGINT AS tokens_prompt, coalesce(sum(k * 5) FILTER (kind = 'llm_call'), 0)::BIGINT AS tokens_completion,
  coalesce(sum(k * 3) FILTER (kind = 'llm_call'), 0)::BIGINT AS tokens_cache_read, coalesce(sum(k) FILTER (kind = 'llm_call'), 0)::BIGINT AS tokens_cache_creation,
  coalesce(sum(value / 1000) FILTER (kind = 'llm_call'), 0) AS cost_usd, count_if(kind = 'tool_output')::BIGINT AS tool_total, count_if(kind = 'tool_output' AND k % 2 = 0)::BIGINT AS tool_ok,
  max((kind = 'error')::INT) AS failed, max((kind = 'undo_complete')::INT) AS regenerated, count_if(kind = 'feedback' AND k % 3 = 0)::BIGINT AS thumbs_up, count_if(kind = 'feedback' AND k % 3 <> 0)::BIGINT AS thumbs_down,
  count_if(kind = 'hf_job_submit')::BIGINT AS jobs_submitted, count_if(kind = 'hf_job_complete' AND k % 5 < 2)::BIGINT AS jobs_succeeded, count_if(kind = 'jobs_access_blocked')::BIGINT AS jobs_blocked,
  count_if(kind = 'pro_cta_click')::BIGINT AS pro_clicks, coalesce({hours}, 0.0) AS gpu_hours,
  coalesce(arg_min(round((epoch_us(ts) - epoch_us(started::TIMESTAMP)) / 1e6, 6), pos) FILTER (kind IN ('tool_call', 'tool_output')), -1.0) AS first_action_s
FROM ev GROUP BY session_id"""


def _rollup_sql(length: int, keep: str = "true") -> str:
    return f"""WITH {EVENTS}, s AS ({_session_sql()})
SELECT replace(left(started, {length}), ' ', 'T') AS bucket, count(*) AS sessions, count(DISTINCT "user") AS users, sum(turns)::BIGINT AS turns, sum(llm_calls)::BIGINT AS llm_calls, sum(tokens_prompt)::BIGINT AS tokens_prompt,
  sum(tokens_completion)::BIGINT AS tokens_completion, sum(tokens_cache_read)::BIGINT AS tokens_cache_read, sum(tokens_cache_creation)::BIGINT AS tokens_cache_creation, round(sum(cost_usd)::DECIMAL(24,8), 4)::DOUBLE AS cost_usd,
  coalesce(round(sum(tokens_cache_read)::DOUBLE / nullif(sum(tokens_cache_read) + sum(tokens_prompt), 0), 4), 0.0) AS cache_hit_ratio, coalesce(round(sum(tool_ok)::DOUBLE / nullif(sum(tool_total), 0), 4), 0.0) AS tool_success_rate,
  round(sum(failed)::DOUBLE / count(*), 4) AS failure_rate, round(sum(regenerated)::DOUBLE / count(*), 4) AS regenerate_rate,
  coalesce(round((quantile_cont(first_action_s, 0.5) FILTER (first_action_s >= 0))::DECIMAL(24,8), 2)::DOUBLE, 0.0) AS first_action_p50,
  coalesce(round((quantile_cont(first_action_s, 0.95) FILTER (first_action_s >= 0))::DECIMAL(24,8), 2)::DOUBLE, 0.0) AS first_action_p95,
  sum(thumbs_up)::BIGINT AS thumbs_up, sum(thumbs_down)::BIGINT AS thumbs_down, sum(jobs_submitted)::BIGINT AS jobs_submitted, sum(jobs_succeeded)::BIGINT AS jobs_succeeded, sum(jobs_blocked)::BIGINT AS jobs_blocked, sum(pro_clicks)::BIGINT AS pro_clicks
FROM s WHERE {keep} GROUP BY 1"""


@query("session_kpis", f"WITH {EVENTS}, s AS ({_session_sql()}) SELECT * EXCLUDE (started) REPLACE (round(cost_usd, 6) AS cost_usd, round(gpu_hours, 6) AS gpu_hours) FROM s")
def session_kpis(spark, sf_dir):
    return trajectories.session_kpis(session_rows(spark, sf_dir)).withColumns({"cost_usd": F.round("cost_usd", 6), "gpu_hours": F.round("gpu_hours", 6)})


@query("session_rollup_hourly", _rollup_sql(13))
def session_rollup_hourly(spark, sf_dir):
    return trajectories.rollup(session_rows(spark, sf_dir), "hour")


@query("session_rollup_daily", _rollup_sql(10))
def session_rollup_daily(spark, sf_dir):
    return trajectories.rollup(session_rows(spark, sf_dir), "day")


@query("session_backfill", _rollup_sql(13, "started >= '2024-01-10 06:00:00' AND started < '2024-01-10 12:00:00'"))
def session_backfill(spark, sf_dir):
    return trajectories.backfill(session_rows(spark, sf_dir), "2024-01-10 12:34:00")


@query("pro_clicks_json", f"""WITH {EVENTS}, c AS (SELECT left(started, 10) AS bucket, CASE WHEN k % 3 > 0 THEN 'page_' || (k % 3) ELSE 'unknown' END AS source, count(*) AS n FROM ev WHERE kind = 'pro_cta_click' GROUP BY ALL)
SELECT bucket, '{{' || string_agg('"' || source || '":' || n, ',' ORDER BY source) || '}}' AS pro_cta_by_source_json FROM c GROUP BY bucket""")
def pro_clicks_json(spark, sf_dir):
    return trajectories.pro_clicks_json(session_rows(spark, sf_dir), "day")


@query("gpu_hours_by_session_day", f"""WITH {EVENTS}, c AS (SELECT left(started, 10) AS bucket, flavor, sum(value * gpus / 3600.0) AS hours FROM ev WHERE kind = 'hf_job_complete' GROUP BY ALL)
SELECT bucket, flavor, round(hours, 6) AS hours FROM c""")
def gpu_hours_by_session_day(spark, sf_dir):
    sums = trajectories.gpu_hours_json(session_rows(spark, sf_dir), "day")
    return sums.select("bucket", F.explode(F.from_json("gpu_hours_by_flavor_json", "map<string,double>")).alias("flavor", "hours")).withColumn("hours", F.round("hours", 6))


_TAGS = f"""WITH {EVENTS}, f AS (SELECT session_id, min(pos) FILTER (kind = 'error') AS e, max(pos) FILTER (kind = 'interrupted') AS i FROM ev GROUP BY session_id),
c AS (SELECT ev.session_id, max(pos) AS c FROM ev JOIN f USING (session_id) WHERE kind = 'turn_complete' AND (e IS NULL OR pos < e) GROUP BY ev.session_id),
s AS (SELECT session_id, any_value(model) AS model, count_if(kind = 'llm_call') AS turns, coalesce(sum(value / 1000) FILTER (kind = 'llm_call'), 0) AS cost,
  coalesce(list(DISTINCT tool) FILTER (kind = 'tool_call'), []) AS tools, coalesce(bool_or(script IN ('from trl import SFTTrainer', 'python finetune.py')) FILTER (kind = 'tool_call' AND tool = 'hf_jobs'), false) AS trains,
  coalesce(list(DISTINCT family) FILTER (kind = 'hf_job_submit'), []) AS gpus, coalesce(bool_or(regexp_matches(flavor, 'x2|x4|x8')) FILTER (kind = 'hf_job_submit'), false) AS multi,
  count_if(kind = 'hf_job_submit') AS jobs, count_if(kind = 'hf_job_submit' AND k % 20 = 0) AS pushed, count_if(kind = 'hf_job_complete' AND state IN ('COMPLETED', 'succeeded')) AS good, count_if(kind = 'hf_job_complete' AND state IN ('failed', 'timeout')) AS bad,
  count_if(kind = 'tool_output' AND (output LIKE '%room%' OR output LIKE '%OutOfMemoryError%' OR output LIKE 'CUDA%')) AS oom, count_if(kind = 'sandbox_create') AS boxes, arg_max(family, pos) FILTER (kind = 'sandbox_create') AS box,
  arg_max(k * 40, pos) FILTER (kind = 'sandbox_destroy') AS lifetime, count_if(kind = 'feedback' AND k % 3 = 0) AS up, count_if(kind = 'feedback' AND k % 3 <> 0) AS down, count_if(kind = 'tool_log' AND k = 13) AS loops, count_if(kind = 'compacted') AS compacted
  FROM ev GROUP BY session_id),
g AS (SELECT *, list_transform(gpus, lambda x: 'gpu:' || x) || CASE WHEN multi THEN ['gpu:multi'] ELSE [] END AS gpu, list_has_any(tools, ['hf_jobs', 'sandbox_create', 'sandbox_exec']) AS computes FROM s)
SELECT session_id, array_to_string(list_sort(list_filter([
  'model:' || CASE model WHEN 'org/Claude-Opus' THEN 'opus' WHEN 'sonnet-x' THEN 'sonnet' WHEN 'b/haiku' THEN 'haiku' WHEN 'Kimi' THEN 'kimi' WHEN 'gpt-9' THEN 'gpt' WHEN 'Qwen' THEN 'qwen' WHEN 'other-one' THEN 'other' ELSE model END,
  'turns:' || CASE WHEN turns < 5 THEN 'short' WHEN turns <= 20 THEN 'medium' ELSE 'long' END, 'cost:' || CASE WHEN cost < 0.10 THEN 'low' WHEN cost < 1 THEN 'med' ELSE 'high' END,
  'feedback:' || CASE WHEN up > 0 AND down > 0 THEN 'mixed' WHEN up > 0 THEN 'up' WHEN down > 0 THEN 'down' ELSE 'none' END,
  'outcome:' || CASE WHEN i IS NOT NULL AND (c IS NULL OR i > c) THEN 'interrupted' WHEN c IS NOT NULL THEN 'completed' WHEN e IS NOT NULL THEN 'errored' ELSE 'ongoing' END,
  CASE WHEN loops > 0 THEN 'outcome:doom_loop' END, CASE WHEN compacted > 0 THEN 'outcome:context_exceeded' END, CASE WHEN jobs >= 1 THEN 'hf_job:submitted' END, CASE WHEN jobs > 1 THEN 'hf_job:multi' END,
  CASE WHEN good > 0 THEN 'hf_job:succeeded' END, CASE WHEN bad > 0 THEN 'hf_job:failed' END, CASE WHEN pushed > 0 THEN 'hf_job:push_to_hub' END, CASE WHEN oom > 0 THEN 'hf_job:oom' END,
  CASE WHEN boxes > 0 THEN 'sandbox:created' END, CASE WHEN boxes > 0 THEN CASE WHEN box = 'none' THEN 'sandbox:cpu' ELSE 'sandbox:gpu' END END, CASE WHEN lifetime > 1800 THEN 'sandbox:long_lived' END,
  CASE WHEN trains THEN 'task:training' WHEN NOT computes AND list_contains(tools, 'generate') THEN 'task:inference' WHEN NOT computes AND list_contains(tools, 'hf_inspect_dataset') THEN 'task:data_prep'
    WHEN len(tools) > 0 AND NOT computes THEN 'task:research_only' END]
  || list_transform(tools, lambda x: 'tool:' || x) || CASE WHEN len(gpu) > 1 THEN list_filter(gpu, lambda x: x <> 'gpu:none') ELSE gpu END, lambda x: x IS NOT NULL)), ',') AS tags
FROM g JOIN f USING (session_id) LEFT JOIN c USING (session_id)"""


@query("tag_session", _TAGS)
def tag_session(spark, sf_dir):
    return trajectories.tagged(session_rows(spark, sf_dir)).select("session_id", F.array_join("tags", ",").alias("tags"))


@query("training_rows", f"WITH {EVENTS} SELECT session_id, any_value(model) AS model, '[]' AS tools, left(any_value(started), 10) AS day, count(*) AS n_messages FROM ev GROUP BY session_id")
def training_rows(spark, sf_dir):
    rows = trajectories.training_rows(session_rows(spark, sf_dir))
    return rows.select("session_id", "model", "tools", "day", F.size(F.from_json("messages", "array<map<string,string>>")).cast("long").alias("n_messages"))
