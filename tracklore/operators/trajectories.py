"""Session rows with nested events and messages: the KPI columns and the tags of each session.

Events are exploded once; all columns of a session are sums, extremes and sets of one aggregation, which combines before its
shuffle. Only the positions of completed turns and of outputs are lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklore.operators import kpis, tags
from tracklore.operators.rules import pushes_to_hub
from tracklore.sources.event_log import lookup

TOKENS = {"tokens_prompt": "prompt_tokens", "tokens_completion": "completion_tokens", "tokens_cache_read": "cache_read_tokens", "tokens_cache_creation": "cache_creation_tokens"}
#: Tools that only read, tools of data work, tools that run something, and tools that infer. Fixed values.
RESEARCH = ("research", "github_find_examples", "github_read_file", "github_list_repos", "hf_papers", "explore_hf_docs", "fetch_hf_docs", "hub_repo_details", "plan", "hf_inspect_dataset", "web_search")
DATA_PREP = ("hf_inspect_dataset", "dataset_tools", "hub_repo_details")
COMPUTE = ("hf_jobs", "sandbox_create", "sandbox_exec")
INFERENCE = ("inference", "generate", "run_inference")


def exploded(rows: DataFrame) -> DataFrame:
    """One row for each event, and one without a kind for a session without events: session_id, user_id, model_name,
    started, user_turns, pos, ts, kind, data."""
    spark = rows.sparkSession
    role = lambda m: F.try_variant_get(m, "$.role", "string")
    heard = F.coalesce(F.size(F.filter(F.try_variant_get("messages", "$", "array<variant>"), lambda m: role(m) == "user")), F.lit(0))
    wide = rows.select("session_id", "user_id", "model_name", F.try_to_timestamp("session_start_time").alias("started"), F.greatest(heard, F.lit(0)).alias("user_turns"), "events")
    each = wide.lateralJoin(spark.tvf.variant_explode_outer(F.col("events").outer()))
    text = lambda path: F.try_variant_get("value", path, "string")
    return each.select(
        "session_id", "user_id", "model_name", "started", "user_turns", F.col("pos"),
        F.try_to_timestamp(text("$.timestamp")).alias("ts"), text("$.event_type").alias("kind"), F.try_variant_get("value", "$.data", "variant").alias("data"),
    )


def _text(name: str) -> Column:
    return F.try_variant_get("data", f"$.{name}", "string")


def _number(name: str, kind: str = "double") -> Column:
    return F.coalesce(F.try_variant_get("data", f"$.{name}", kind), F.lit(0).cast(kind))


def _is(*kinds: str) -> Column:
    return F.col("kind").isin(*kinds)


def session_kpis(rows: DataFrame, *by: Column) -> DataFrame:
    """The KPI columns of each session; `by` may add columns of the session to group by, as its bucket."""
    each = exploded(rows)
    gap = F.round((F.unix_micros("ts") - F.unix_micros("started")) / 1e6, 6)
    acts = _is("tool_call", "tool_output") & gap.isNotNull()
    given = lambda name: F.coalesce(F.try_variant_get("data", f"$.{name}", "boolean"), F.lit(False))
    hours = _number("wall_time_s") * F.coalesce(lookup(_text("flavor"), 0), F.lit(0)) / 3600.0
    ended = F.lower(F.coalesce(_text("final_status"), F.lit("")))
    return each.groupBy("session_id", *by).agg(
        F.coalesce(F.max("user_id"), F.first("session_id")).alias("user"),
        F.max("user_turns").cast("long").alias("turns"),
        F.count_if(_is("llm_call")).alias("llm_calls"),
        *(F.coalesce(F.sum(F.when(_is("llm_call"), _number(field, "long"))), F.lit(0)).alias(name) for name, field in TOKENS.items()),
        F.coalesce(F.sum(F.when(_is("llm_call"), _number("cost_usd"))), F.lit(0.0)).alias("cost_usd"),
        F.count_if(_is("tool_output")).alias("tool_total"),
        F.count_if(_is("tool_output") & given("success")).alias("tool_ok"),
        F.coalesce(F.max(_is("error").cast("int")), F.lit(0)).alias("failed"),
        F.coalesce(F.max(_is("undo_complete").cast("int")), F.lit(0)).alias("regenerated"),
        F.count_if(_is("feedback") & (_text("rating") == "up")).alias("thumbs_up"),
        F.count_if(_is("feedback") & (_text("rating") == "down")).alias("thumbs_down"),
        F.count_if(_is("hf_job_submit")).alias("jobs_submitted"),
        F.count_if(_is("hf_job_complete") & ended.isin(*tags.SUCCEEDED)).alias("jobs_succeeded"),
        F.count_if(_is("jobs_access_blocked")).alias("jobs_blocked"),
        F.count_if(_is("pro_cta_click")).alias("pro_clicks"),
        F.coalesce(F.sum(F.when(_is("hf_job_complete"), hours)), F.lit(0.0)).alias("gpu_hours"),
        F.coalesce(F.min_by(F.when(acts, gap), F.when(acts, F.col("pos"))), F.lit(-1.0)).alias("first_action_s"),
    )


def rollup(rows: DataFrame, unit: str) -> DataFrame:
    """One row for each hour or day in which sessions began."""
    each = session_kpis(rows, kpis.bucket(unit, "started").alias("bucket"))
    total = lambda c: F.sum(c).cast("long")
    return each.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_distinct("user").alias("users"),
        *(total(c).alias(c) for c in ("turns", "llm_calls", *TOKENS)),
        kpis.exact_round(F.sum("cost_usd"), 4).alias("cost_usd"),
        kpis.ratio(total("tokens_cache_read"), total("tokens_cache_read") + total("tokens_prompt")).alias("cache_hit_ratio"),
        kpis.ratio(total("tool_ok"), total("tool_total")).alias("tool_success_rate"),
        kpis.ratio(total("failed"), F.count(F.lit(1))).alias("failure_rate"),
        kpis.ratio(total("regenerated"), F.count(F.lit(1))).alias("regenerate_rate"),
        kpis.percentile("first_action_s", 0.5).alias("first_action_p50"),
        kpis.percentile("first_action_s", 0.95).alias("first_action_p95"),
        *(total(c).alias(c) for c in ("thumbs_up", "thumbs_down", "jobs_submitted", "jobs_succeeded", "jobs_blocked", "pro_clicks")),
    )


def counts_json(rows: DataFrame, kind: str, field: str, amount: Column, unit: str, name: str) -> DataFrame:
    """Per bucket a JSON object, keys in order, of sums by a field of one kind of event; as of hours by flavor."""
    some = exploded(rows).filter(_is(kind)).select(kpis.bucket(unit, "started").alias("bucket"), F.coalesce(F.nullif(_text(field), F.lit("")), F.lit("unknown")).alias("key"), amount.alias("x"))
    sums = some.groupBy("bucket", "key").agg(F.sum("x").alias("x"))
    entries = F.array_sort(F.collect_list(F.struct("key", "x")))
    return sums.groupBy("bucket").agg(F.to_json(F.map_from_entries(entries)).alias(name))


def gpu_hours_json(rows: DataFrame, unit: str) -> DataFrame:
    hours = _number("wall_time_s") * F.coalesce(lookup(_text("flavor"), 0), F.lit(0)) / 3600.0
    return counts_json(rows, "hf_job_complete", "flavor", hours, unit, "gpu_hours_by_flavor_json")


def pro_clicks_json(rows: DataFrame, unit: str) -> DataFrame:
    return counts_json(rows, "pro_cta_click", "source", F.lit(1).cast("long"), unit, "pro_cta_by_source_json")


def hours_to_run(now: Column, hours: int) -> Column:
    """Starts of the last complete hours before a time, latest first."""
    top = F.date_trunc("hour", now)
    return F.transform(F.sequence(F.lit(1), F.lit(hours)), lambda i: top - F.make_interval(hours=i))


def backfill(rows: DataFrame, now: str, hours: int = 6) -> DataFrame:
    """The hourly rows of the last complete hours before a time: what a run at start writes anew."""
    top = F.date_trunc("hour", F.lit(now).cast("timestamp"))
    at = F.try_to_timestamp("session_start_time")
    return rollup(rows.filter((at >= top - F.make_interval(hours=F.lit(hours))) & (at < top)), "hour")


def task(tools: Column, scripts: Column) -> Column:
    """training > inference > data_prep > research_only, from names of tools and texts of job scripts; null if none fits."""
    names = lambda values: F.array(*map(F.lit, values))
    computes = F.arrays_overlap(tools, names(COMPUTE))
    trains = F.exists(scripts, lambda s: F.greatest(*(F.contains(F.lower(s), F.lit(w)) for w in tags.TRAINING)))
    return (
        F.when(trains, "training")
        .when(~computes & F.arrays_overlap(tools, names(INFERENCE)), "inference")
        .when(~computes & F.arrays_overlap(tools, names(DATA_PREP)), "data_prep")
        .when((F.size(tools) > 0) & (F.size(F.array_except(tools, names(RESEARCH))) == 0), "research_only")
    )


def tagged(rows: DataFrame) -> DataFrame:
    """session_id, tags: the sorted set of "<namespace>:<value>" strings of each session."""
    each = exploded(rows)
    flavor = F.coalesce(F.nullif(_text("flavor"), F.lit("")), F.lit("cpu-basic"))
    hardware = F.nullif(_text("hardware"), F.lit(""))
    ended = F.lower(F.coalesce(_text("final_status"), F.lit("")))
    names = lambda c, label: F.collect_set(c).alias(label)
    any_of = lambda c, label: F.coalesce(F.bool_or(c), F.lit(False)).alias(label)
    pushed = F.coalesce(F.try_variant_get("data", "$.push_to_hub", "boolean"), F.lit(False))
    script = F.coalesce(F.nullif(_text("arguments.script"), F.lit("")), _text("arguments.command"), F.lit(""))
    facts = each.groupBy("session_id").agg(
        F.max("model_name").alias("model"),
        F.max("user_turns").alias("turns"),
        F.coalesce(F.sum(F.when(_is("llm_call"), _number("cost_usd"))), F.lit(0.0)).alias("cost"),
        names(F.when(_is("tool_call"), F.nullif(_text("tool"), F.lit(""))), "tools"),
        names(F.when(_is("tool_call") & (_text("tool") == "hf_jobs"), script), "scripts"),
        names(F.when(_is("hf_job_submit"), F.coalesce(lookup(flavor, 1), F.lit("none"))), "gpus"),
        any_of(_is("hf_job_submit") & flavor.rlike("x2|x4|x8"), "multi"),
        F.count_if(_is("hf_job_submit")).alias("jobs"),
        any_of(_is("hf_job_submit") & pushed, "pushed"),
        any_of(_is("hf_job_complete") & ended.isin(*tags.SUCCEEDED), "succeeded"),
        any_of(_is("hf_job_complete") & ended.isin(*tags.FAILED), "failed"),
        any_of(_is("tool_output") & tags.out_of_memory(_text("output")), "oom"),
        any_of(_is("sandbox_create"), "sandbox"),
        F.max_by(F.coalesce(hardware, F.lit("")), F.when(_is("sandbox_create"), F.col("pos"))).alias("hardware"),
        F.max_by(F.try_variant_get("data", "$.lifetime_s", "double"), F.when(_is("sandbox_destroy") & F.try_variant_get("data", "$.lifetime_s", "double").isNotNull(), F.col("pos"))).alias("lifetime"),
        F.count_if(_is("feedback") & (_text("rating") == "up")).alias("up"),
        F.count_if(_is("feedback") & (_text("rating") == "down")).alias("down"),
        any_of(_is("tool_log") & F.contains(F.lower(F.coalesce(_text("log"), F.lit(""))), F.lit("doom loop")), "loop"),
        any_of(_is("compacted"), "compacted"),
        F.min(F.when(_is("error"), F.col("pos"))).alias("error"),
        F.max(F.when(_is("interrupted"), F.col("pos"))).alias("interrupted"),
        F.collect_list(F.when(_is("turn_complete"), F.col("pos"))).alias("completed"),
    )
    # A turn counts as completed only before the first error; the last of completion and interruption decides.
    completed = F.array_max(F.filter("completed", lambda p: F.col("error").isNull() | (p < F.col("error"))))
    outcome = (
        F.when(F.col("interrupted").isNotNull() & (completed.isNull() | (F.col("interrupted") > completed)), "interrupted")
        .when(completed.isNotNull(), "completed").when(F.col("error").isNotNull(), "errored").otherwise("ongoing")
    )
    labelled = lambda space, values: F.transform(values, lambda v: F.concat(F.lit(f"{space}:"), v))
    when = lambda condition, tag: F.when(condition, F.array(F.lit(tag) if isinstance(tag, str) else tag)).otherwise(F.array().cast("array<string>"))
    gpu = F.concat(labelled("gpu", F.col("gpus")), when(F.col("multi"), "gpu:multi"))
    family = F.coalesce(lookup(F.col("hardware"), 1), F.lit("none"))
    kind = task(F.col("tools"), F.col("scripts"))
    every = F.concat(
        F.array(
            F.concat(F.lit("model:"), tags.model_family(F.col("model"))), F.concat(F.lit("turns:"), tags.turns_bucket(F.col("turns"))),
            F.concat(F.lit("cost:"), tags.cost_bucket(F.col("cost"))), F.concat(F.lit("feedback:"), tags.feedback(F.col("up"), F.col("down"))), F.concat(F.lit("outcome:"), outcome),
        ),
        when(F.col("loop"), "outcome:doom_loop"), when(F.col("compacted"), "outcome:context_exceeded"), labelled("tool", F.col("tools")),
        when(F.col("jobs") >= 1, "hf_job:submitted"), when(F.col("jobs") > 1, "hf_job:multi"), when(F.col("succeeded"), "hf_job:succeeded"), when(F.col("failed"), "hf_job:failed"),
        when(F.col("pushed"), "hf_job:push_to_hub"), when(F.col("oom"), "hf_job:oom"), tags.without_none(gpu),
        when(F.col("sandbox"), "sandbox:created"), when(F.col("sandbox") & (F.col("hardware") != ""), F.when(family == "none", "sandbox:cpu").otherwise("sandbox:gpu")),
        when(F.coalesce(F.floor("lifetime") > 1800, F.lit(False)), "sandbox:long_lived"), when(kind.isNotNull(), F.concat(F.lit("task:"), kind)),
    )
    return facts.select("session_id", F.array_sort(F.array_distinct(every)).alias("tags"))


def training_rows(rows: DataFrame) -> DataFrame:
    """Session rows as a training set has them: renamed, with tags, missing tools as an empty list, by day of start; rows
    without a session are dropped."""
    kept = rows.filter("session_id IS NOT NULL")
    shaped = kept.select(
        "session_id", F.col("model_name").alias("model"), F.col("session_start_time").alias("timestamp"), F.to_json("messages").alias("messages"),
        F.coalesce(F.to_json("tools"), F.lit("[]")).alias("tools"), F.date_format(F.try_to_timestamp("session_start_time"), "yyyy-MM-dd").alias("day"),
    )
    return shaped.join(tagged(kept), "session_id")


def submitted_pushes(each: DataFrame) -> DataFrame:
    """Job submissions whose script pushes its model."""
    return each.filter(_is("tool_call") & pushes_to_hub(_text("arguments.script")))
