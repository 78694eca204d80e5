"""Rule classifiers, approvals, quotas and admission, as column expressions over tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Substrings that name a class of error, by precedence, and delays in seconds of its retries. Fixed values.
ERRORS = {
    "context_overflow": ("context window exceeded", "maximum context length", "max context length", "prompt is too long", "context length exceeded", "too many input tokens", "input is too long"),
    "rate_limit": ("429", "rate limit", "rate_limit", "too many requests", "too many tokens", "request limit", "throttl"),
    "transient": ("timeout", "timed out", "503", "service unavailable", "502", "bad gateway", "500", "internal server error", "overloaded", "capacity", "connection reset", "connection refused", "connection error", "eof", "broken pipe"),
}
EFFORT = ("invalid", "not supported", "must be one of", "not a valid", "unrecognized", "unknown", "only supported by", "is only supported")
DELAYS = {"rate_limit": (30, 60), "transient": (5, 15, 30)}
#: Job operations that start a run, hardware without graphics processors, and operations of each tool that change something.
#: Fixed values.
RUNS = ("run", "uv", "scheduled run", "scheduled uv")
CPU = ("cpu-basic", "cpu-upgrade")
CHANGES = {
    "hf_private_repos": ("upload_file", "create_repo"),
    "hf_repo_files": ("upload", "delete"),
    "hf_repo_git": ("delete_branch", "delete_tag", "merge_pr", "create_repo", "update_repo"),
}


def holds_any(text: Column, words) -> Column:
    low = F.lower(text)
    out = F.lit(False)
    for w in words:
        out |= F.contains(low, F.lit(w))
    return out


def error_class(message: Column) -> Column:
    """A prompt that is too long is never sent again; of the rest a rate limit goes before other passing errors."""
    out = F.lit("other")
    for name, words in reversed(ERRORS.items()):
        out = F.when(holds_any(message, words), name).otherwise(out)
    return out


def friendly_class(message: Column) -> Column:
    """The kind of advice an error deserves, null for none."""
    has = lambda *words: holds_any(message, words)
    unknown = has("model_not_found") | (has("model") & has("not found", "does not exist"))
    return (
        F.when(has("authentication", "unauthorized", "invalid x-api-key"), "authentication")
        .when(has("insufficient") & has("credit"), "credits")
        .when(has("not supported by provider", "no provider supports"), "provider")
        .when(unknown, "model")
    )


def effort_problem(message: Column) -> Column:
    """Which setting a model refuses: `thinking` altogether, or the level of `effort`; null for neither."""
    has = lambda *words: holds_any(message, words)
    return F.when(has("thinking") & has("not supported"), "thinking").when(has("effort", "output_config") & has(*EFFORT), "effort")


def retry_delay(kind: Column, attempt: Column) -> Column:
    """Null once the delays are used up."""
    out = F.lit(None).cast("int")
    for name, delays in DELAYS.items():
        out = F.when(kind == name, F.get(F.array(*map(F.lit, delays)), attempt)).otherwise(out)
    return out


def daily_cap(plan: Column) -> Column:
    return F.when(F.coalesce(plan, F.lit("")).isin("", "free"), 1).otherwise(20)


def daily_counts(ops: DataFrame) -> DataFrame:
    """Per user and UTC day: increments less refunds in order of time, never below zero. The floor lifts the running sum by as
    much as it has ever been below zero."""
    day = F.to_date("ts").alias("day")
    step = F.when(F.col("op") == "inc", 1).otherwise(-1)
    so_far = F.sum(step).over(Window.partitionBy("user_id", "day").orderBy("ts", "event_id"))
    running = ops.select("user_id", day, "ts", "event_id", "op").withColumn("run", so_far)
    return running.groupBy("user_id", "day").agg((F.max_by("run", F.struct("ts", "event_id")) - F.least(F.min("run"), F.lit(0))).cast("int").alias("used"))


def charged_sessions(starts: DataFrame, cap: int) -> DataFrame:
    """The first `cap` distinct sessions of a user and day are charged; a session is charged once."""
    once = starts.groupBy("user_id", F.to_date("ts").alias("day"), "session_id").agg(F.min("ts").alias("ts"))
    rank = F.row_number().over(Window.partitionBy("user_id", "day").orderBy("ts", "session_id"))
    return once.withColumn("admitted", rank <= cap).select("user_id", "day", "session_id", "admitted")


def capacity_gate(live: DataFrame, total: int = 200, own: int = 10) -> DataFrame:
    """Whether a user may open one more session. The count of all sessions is one row, so its broadcast is bounded."""
    by_user = live.groupBy("user_id").agg(F.count(F.lit(1)).alias("live"))
    everyone = by_user.agg(F.coalesce(F.sum("live"), F.lit(0)).alias("_all"))
    gated = by_user.crossJoin(F.broadcast(everyone))
    return gated.withColumn("may_open", (F.col("live") < own) & (F.col("_all") < total)).drop("_all")


def needs_approval(tool: Column, operation: Column, flavor: Column, valid: Column | None = None, skip_all: Column | None = None, confirm_cpu: Column | None = None, auto_upload: Column | None = None) -> Column:
    """Whether a call waits for a yes. Malformed arguments never wait, as they fail anyway; nor does anything under skip_all.
    Creating a sandbox always waits; a run waits unless it is on plain hardware and confirm_cpu is off; an upload to a
    private repository waits unless auto_upload is on; other operations wait where they are listed in CHANGES."""
    on = lambda c, default: F.coalesce(c, F.lit(default)) if c is not None else F.lit(default)
    does = F.coalesce(operation, F.lit(""))
    plain = F.coalesce(F.nullif(flavor, F.lit("")), F.lit(CPU[0])).isin(*CPU)
    listed = F.lit(False)
    for name, operations in CHANGES.items():
        listed |= (tool == name) & does.isin(*operations)
    run = (tool == "hf_jobs") & does.isin(*RUNS) & (~plain | on(confirm_cpu, True))
    upload = (tool == "hf_private_repos") & (does == "upload_file") & on(auto_upload, False)
    asks = (tool == "sandbox_create") | run | (listed & ~upload)
    return F.coalesce(asks & on(valid, True) & ~on(skip_all, False), F.lit(False))


def split_by_approval(calls: DataFrame, needs: Column) -> tuple[DataFrame, DataFrame]:
    """Calls that wait for a yes, and those that run at once."""
    marked = calls.withColumn("_needs", needs)
    return marked.filter("_needs").drop("_needs"), marked.filter("NOT _needs").drop("_needs")


def decisions(pending: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """Pending calls with the answer to each; no answer is a no."""
    return pending.join(answers, key, "left").withColumn("approved", F.coalesce("approved", F.lit(False)))


def model_id_ok(name: Column) -> Column:
    """Two or more parts without an empty one, before the tag behind the first colon."""
    parts = F.split(F.split_part(name, F.lit(":"), F.lit(1)), "/")
    return F.coalesce((F.size(parts) >= 2) & F.forall(parts, lambda p: p != ""), F.lit(False))


def pushes_to_hub(script: Column) -> Column:
    text = F.coalesce(script, F.lit(""))
    return F.contains(text, F.lit("push_to_hub=True")) | F.contains(text, F.lit("push_to_hub=true")) | F.contains(text, F.lit("hub_model_id"))


def save_pattern(script: Column) -> Column:
    """What a training script does with its model: unsaved, pushed, or null where it loads none."""
    loads, pushes = F.contains(script, F.lit("from_pretrained")), F.contains(script, F.lit("push_to_hub"))
    return F.when(loads & ~pushes, "unsaved").when(loads & pushes, "pushed")


def looks_like_path(script: Column) -> Column:
    """A string without line ends or space around that begins as a path does."""
    begins = F.startswith(script, F.lit("/")) | F.startswith(script, F.lit("./")) | F.startswith(script, F.lit("../"))
    return F.coalesce(begins & (F.regexp_replace(script, F.lit(r"^\s+|\s+$"), F.lit("")) == script) & ~script.rlike(r"[\r\n\x00]"), F.lit(False))


def first_given(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values))


def stage_matches(stage: Column, everything: Column, status: Column) -> Column:
    """Jobs to list: running ones unless everything is asked for; a status asked for is a part of the stage."""
    asked = F.nullif(status, F.lit(""))
    return (F.coalesce(everything, F.lit(False)) | (stage == "RUNNING")) & (asked.isNull() | F.contains(stage, F.upper(asked)))


def visible_to(owner: Column, user: Column) -> Column:
    """Rows of an owner, all rows where no user is given or the user is the developer."""
    given = F.nullif(user, F.lit(""))
    return given.isNull() | (given == "dev") | F.coalesce(owner == given, F.lit(False))


def allowed_tools(tools: DataFrame, allow: tuple[str, ...] | None = None, deny: tuple[str, ...] = (), name: str = "name") -> DataFrame:
    kept = tools if allow is None else tools.filter(F.col(name).isin(*allow))
    return kept.filter(~F.coalesce(F.col(name).isin(*deny), F.lit(False))) if deny else kept
