"""Two-step KPI rollup: per-session partial sums, then one row for each bucket.

The first aggregation is by session and bucket, the second by bucket; both combine before their shuffle but for the exact
percentiles, whose state is one value for each session. Positions, never row order, decide what comes first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklore.sources.event_log import FLAVORS, lookup

TOKENS = {"tokens_prompt": 10, "tokens_completion": 5, "tokens_cache_read": 3}


def bucket(unit: str, at: str = "ts") -> Column:
    return F.date_format(F.date_trunc(unit, at), "yyyy-MM-dd'T'HH" if unit == "hour" else "yyyy-MM-dd")


def flavor_of(k: Column) -> Column:
    names = F.array(*map(F.lit, FLAVORS))
    return F.element_at(names, (k % len(FLAVORS) + 1).cast("int"))


def is_job(log: DataFrame) -> Column:
    return (log.kind == "llm_call") & (log.k % 10 == 0)


def session_metrics(log: DataFrame, *by: Column) -> DataFrame:
    """Partial sums of each session (and bucket); first_action is the time of the action first in position, not in time."""
    calls, outputs, marks = F.col("kind") == "llm_call", F.col("kind") == "tool_output", F.col("kind") == "feedback"
    acts = F.col("kind").isin("tool_call", "tool_output")
    gap = F.round((F.unix_micros("ts") - F.unix_micros("session_start")) / 1e6, 3)
    count = lambda c: F.count_if(c)
    return log.groupBy("session_id", *by).agg(
        F.max("user_id").alias("user_id"),
        F.count(F.lit(1)).alias("turns"),
        count(calls).alias("llm_calls"),
        *(F.coalesce(F.sum(F.when(calls, F.col("k") * n)), F.lit(0)).cast("long").alias(name) for name, n in TOKENS.items()),
        F.coalesce(F.sum(F.when(calls, F.col("value") / 1000)), F.lit(0.0)).alias("cost_usd"),
        count(outputs).alias("tool_total"),
        count(outputs & (F.col("k") % 2 == 0)).alias("tool_ok"),
        F.max((F.col("kind") == "error").cast("int")).alias("had_error"),
        F.max((marks & (F.col("k") % 3 == 1)).cast("int")).alias("had_undo"),
        count(marks & (F.col("k") % 3 == 0)).alias("thumbs_up"),
        count(marks & (F.col("k") % 3 == 1)).alias("thumbs_down"),
        count(calls & (F.col("k") % 10 == 0)).alias("jobs"),
        F.coalesce(F.min_by(F.when(acts, gap), F.when(acts, F.col("pos"))), F.lit(-1.0)).alias("first_action_s"),
    )


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.round(F.try_divide(a, b), 4), F.lit(0.0))


def exact_round(x: Column, digits: int) -> Column:
    """Half up on the decimal value, so that sums in another order round alike."""
    return F.round(x.cast("decimal(24,8)"), digits).cast("double")


def percentile(column: str, p: float) -> Column:
    """Linear interpolation over values of 0 or more; 0 where there are none."""
    return F.coalesce(exact_round(F.percentile(F.when(F.col(column) >= 0, F.col(column)), p), 2), F.lit(0.0))


def rollup(log: DataFrame, unit: str) -> DataFrame:
    each = session_metrics(log, bucket(unit).alias("bucket"))
    total = lambda c: F.sum(c)
    return each.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_distinct(F.coalesce(F.col("user_id").cast("string"), F.col("session_id"))).alias("users"),
        *(total(c).cast("long").alias(c) for c in ("turns", "llm_calls", *TOKENS)),
        exact_round(total("cost_usd"), 4).alias("cost_usd"),
        ratio(total("tokens_cache_read"), total("tokens_cache_read") + total("tokens_prompt")).alias("cache_hit_ratio"),
        ratio(total("tool_ok"), total("tool_total")).alias("tool_success_rate"),
        ratio(total("had_error"), F.count(F.lit(1))).alias("failure_rate"),
        ratio(total("had_undo"), F.count(F.lit(1))).alias("regenerate_rate"),
        percentile("first_action_s", 0.5).alias("first_action_p50"),
        percentile("first_action_s", 0.95).alias("first_action_p95"),
        total("thumbs_up").alias("thumbs_up"),
        total("thumbs_down").alias("thumbs_down"),
        total("jobs").alias("jobs"),
    )


def gpu_hours(log: DataFrame, unit: str = "day") -> DataFrame:
    """Hours by bucket and flavor; flavors without processors keep their row."""
    jobs = log.filter(is_job(log)).withColumn("flavor", flavor_of(F.col("k")))
    hours = F.col("value") * F.coalesce(lookup(F.col("flavor"), 0), F.lit(0)) / 3600.0
    return jobs.groupBy(bucket(unit).alias("bucket"), "flavor").agg(F.round(F.sum(hours), 6).alias("gpu_hours"), F.count(F.lit(1)).alias("jobs"))


def in_window(log: DataFrame, start: str, end: str) -> DataFrame:
    """Events of [start, end)."""
    return log.filter((F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") < F.lit(end).cast("timestamp")))


def lookback(rows: DataFrame, at: str, day: str, days: int = 1) -> DataFrame:
    """Rows of the day or of up to so many days before, by a column of time that is compared as it is stored, so that the filter
    reaches the scan."""
    kind = dict(rows.dtypes)[at]
    first, last = F.date_sub(F.lit(day).cast("date"), days), F.date_add(F.lit(day).cast("date"), 1)
    return rows.filter((F.col(at) >= first.cast(kind)) & (F.col(at) < last.cast(kind)))
