"""Queries of the KPI rollup."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklore.operators import kpis
from tracklore.plans.registry import query
from tracklore.sources.event_log import from_events

LOG = """log AS (
  SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY event_id) AS pos FROM (
    SELECT event_id, user_id, ts, value, (props->>'$.k')::INT AS k, date_trunc('day', ts) AS session_start,
      user_id || '_' || strftime(ts, '%Y-%m-%d') AS session_id,
      CASE event_type WHEN 'purchase' THEN 'llm_call' WHEN 'click' THEN 'tool_call' WHEN 'view' THEN 'tool_output'
        WHEN 'signup' THEN 'feedback' ELSE event_type END AS kind
    FROM events))"""
USER_LOG = LOG.replace("user_id || '_' || strftime(ts, '%Y-%m-%d')", "user_id::VARCHAR")


def events(spark, sf_dir, by_day=True, placed=True):
    return from_events(spark.read.parquet(f"{sf_dir}/events.parquet"), by_day, placed)


def _metrics(by: str) -> str:
    return f"""SELECT session_id{by}, max(user_id) AS user_id, count(*) AS turns, count_if(kind = 'llm_call')::BIGINT AS llm_calls,
  coalesce(sum(k * 10) FILTER (kind = 'llm_call'), 0)::BIGINT AS tokens_prompt,
  coalesce(sum(k * 5) FILTER (kind = 'llm_call'), 0)::BIGINT AS tokens_completion,
  coalesce(sum(k * 3) FILTER (kind = 'llm_call'), 0)::BIGINT AS tokens_cache_read,
  coalesce(sum(value / 1000) FILTER (kind = 'llm_call'), 0) AS cost_usd,
  count_if(kind = 'tool_output')::BIGINT AS tool_total, count_if(kind = 'tool_output' AND k % 2 = 0)::BIGINT AS tool_ok,
  max((kind = 'error')::INT) AS had_error, max((kind = 'feedback' AND k % 3 = 1)::INT) AS had_undo,
  count_if(kind = 'feedback' AND k % 3 = 0)::BIGINT AS thumbs_up, count_if(kind = 'feedback' AND k % 3 = 1)::BIGINT AS thumbs_down,
  count_if(kind = 'llm_call' AND k % 10 = 0)::BIGINT AS jobs,
  coalesce(arg_min(round((epoch_us(ts) - epoch_us(session_start)) / 1e6, 3), pos) FILTER (kind IN ('tool_call', 'tool_output')), -1.0) AS first_action_s
FROM log GROUP BY session_id{by and ', bucket'}"""


def _rollup(form: str) -> str:
    each = _metrics(f", strftime(ts, '{form}') AS bucket")
    return f"""WITH {LOG}, s AS ({each})
SELECT bucket, count(*) AS sessions, count(DISTINCT coalesce(user_id::VARCHAR, session_id)) AS users, sum(turns)::BIGINT AS turns,
  sum(llm_calls)::BIGINT AS llm_calls, sum(tokens_prompt)::BIGINT AS tokens_prompt, sum(tokens_completion)::BIGINT AS tokens_completion,
  sum(tokens_cache_read)::BIGINT AS tokens_cache_read, round(sum(cost_usd)::DECIMAL(24,8), 4)::DOUBLE AS cost_usd,
  coalesce(round(sum(tokens_cache_read)::DOUBLE / nullif(sum(tokens_cache_read) + sum(tokens_prompt), 0), 4), 0.0) AS cache_hit_ratio,
  coalesce(round(sum(tool_ok)::DOUBLE / nullif(sum(tool_total), 0), 4), 0.0) AS tool_success_rate,
  round(sum(had_error)::DOUBLE / count(*), 4) AS failure_rate, round(sum(had_undo)::DOUBLE / count(*), 4) AS regenerate_rate,
  coalesce(round((quantile_cont(first_action_s, 0.5) FILTER (first_action_s >= 0))::DECIMAL(24,8), 2)::DOUBLE, 0.0) AS first_action_p50,
  coalesce(round((quantile_cont(first_action_s, 0.95) FILTER (first_action_s >= 0))::DECIMAL(24,8), 2)::DOUBLE, 0.0) AS first_action_p95,
  sum(thumbs_up)::BIGINT AS thumbs_up, sum(thumbs_down)::BIGINT AS thumbs_down, sum(jobs)::BIGINT AS jobs
FROM s GROUP BY bucket"""


@query("kpi_hourly", _rollup("%Y-%m-%dT%H"))
def kpi_hourly(spark, sf_dir):
    return kpis.rollup(events(spark, sf_dir, placed=False), "hour")


@query("kpi_daily", _rollup("%Y-%m-%d"))
def kpi_daily(spark, sf_dir):
    return kpis.rollup(events(spark, sf_dir, placed=False), "day")


@query("kpi_session_metrics", f"WITH {LOG}, s AS ({_metrics('')}) SELECT * REPLACE (round(cost_usd, 6) AS cost_usd) FROM s")
def kpi_session_metrics(spark, sf_dir):
    return kpis.session_metrics(events(spark, sf_dir, placed=False)).withColumn("cost_usd", F.round("cost_usd", 6))


_VALUES = """(0, 'cpu-basic', 0), (1, 'cpu-upgrade', 0), (2, 't4-small', 1), (3, 't4-medium', 1), (4, 'l4x1', 1), (5, 'l4x4', 4), (6, 'l40sx1', 1), (7, 'l40sx4', 4), (8, 'l40sx8', 8), (9, 'a10g-small', 1), (10, 'a10g-large', 1),
  (11, 'a10g-largex2', 2), (12, 'a10g-largex4', 4), (13, 'a100-large', 1), (14, 'a100x2', 2), (15, 'a100x4', 4), (16, 'a100x8', 8), (17, 'h100', 1), (18, 'h100x8', 8)"""


@query(
    "kpi_gpu_hours_by_flavor",
    f"""WITH {LOG}, f(i, flavor, gpus) AS (VALUES {_VALUES})
SELECT strftime(ts, '%Y-%m-%d') AS bucket, flavor, round(sum(value * gpus / 3600.0), 6) AS gpu_hours, count(*) AS jobs
FROM log JOIN f ON k % 19 = i WHERE kind = 'llm_call' AND k % 10 = 0 GROUP BY ALL""",
)
def kpi_gpu_hours_by_flavor(spark, sf_dir):
    return kpis.gpu_hours(events(spark, sf_dir, placed=False))


@query(
    "kpi_source_counts",
    f"""WITH {LOG} SELECT strftime(ts, '%Y-%m-%d') AS bucket, CASE WHEN k % 5 = 0 THEN 'unknown' ELSE 'source_' || (k % 5) END AS source,
  count(*) AS clicks FROM log WHERE kind = 'tool_call' GROUP BY ALL""",
)
def kpi_source_counts(spark, sf_dir):
    source = F.when(F.col("k") % 5 == 0, "unknown").otherwise(F.concat(F.lit("source_"), (F.col("k") % 5).cast("string")))
    clicks = events(spark, sf_dir, placed=False).filter("kind = 'tool_call'")
    return clicks.groupBy(kpis.bucket("day").alias("bucket"), source.alias("source")).agg(F.count(F.lit(1)).alias("clicks"))


@query(
    "window_filter_semi",
    f"""WITH {LOG} SELECT session_id, count(*) AS rows_kept FROM log WHERE session_id IN
  (SELECT session_id FROM log WHERE ts >= TIMESTAMP '2024-01-05 10:00:00' AND ts < TIMESTAMP '2024-01-06 11:00:00') GROUP BY session_id""",
)
def window_filter_semi(spark, sf_dir):
    log = events(spark, sf_dir, placed=False)
    inside = kpis.in_window(log, "2024-01-05 10:00:00", "2024-01-06 11:00:00").select("session_id")
    return log.join(inside, "session_id", "left_semi").groupBy("session_id").agg(F.count(F.lit(1)).alias("rows_kept"))


@query("session_two_day_lookback", f"WITH {LOG} SELECT session_id, count(*) AS n FROM log WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-07' GROUP BY session_id")
def session_two_day_lookback(spark, sf_dir):
    raw = kpis.lookback(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts", "2024-01-06")
    return from_events(raw, placed=False).groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
