"""Operators on lists of messages and tool calls: validation, repair, merging, and budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklore.operators.sequences import by_pos


def with_arguments(calls: DataFrame, column: str = "arguments") -> DataFrame:
    """valid: whether the arguments are a JSON object or null; args: the object, or {} where they are not."""
    parsed = F.try_parse_json(column)
    kind = F.schema_of_variant(parsed)
    valid = F.col(column).isNull() | F.coalesce(F.startswith(kind, F.lit("OBJECT")) | (F.lower(F.trim(F.col(column))) == "null"), F.lit(False))
    args = F.when(F.coalesce(F.startswith(kind, F.lit("OBJECT")), F.lit(False)), F.to_json(parsed)).otherwise("{}")
    return calls.withColumns({"valid": valid, "args": args})


def without_cut_calls(messages: DataFrame) -> DataFrame:
    """Calls of a message that ended for length are dropped; their names stay for the note."""
    cut = F.col("finish_reason") == "length"
    names = F.when(cut, F.array_join(F.transform("tool_calls", lambda c: c["name"]), ", "))
    return messages.withColumns({"dropped": names, "tool_calls": F.when(cut, F.slice("tool_calls", 1, 0)).otherwise(F.col("tool_calls"))})


def repaired(log: DataFrame, head: Column, call: Column, result: Column, key: str) -> DataFrame:
    """The log with a stub result at the end of each block for every call in it without one, renumbered. All windows are within
    a session, so one shuffle serves them all."""
    placed = log.withColumns({"block": F.sum(F.when(head, 1).otherwise(0)).over(by_pos()), "_call": call, "_result": result})
    same, block = Window.partitionBy("session_id", "block", key), Window.partitionBy("session_id", "block")
    marked = placed.withColumns({"_answered": F.max(F.col("_result").cast("int")).over(same), "_end": F.max("pos").over(block)})
    row = lambda at, stub: F.struct(at.cast("double").alias("at"), F.col("pos").alias("tie"), F.lit(stub).alias("stub"))
    own = row(F.col("pos"), False)
    lost = F.col("_call") & (F.col("_answered") == 0)
    rows = marked.select("session_id", key, F.explode(F.when(lost, F.array(own, row(F.col("_end") + 0.5, True))).otherwise(F.array(own))).alias("x"))
    order = Window.partitionBy("session_id").orderBy("x.at", "x.tie")
    return rows.select("session_id", key, "x.stub", F.row_number().over(order).alias("pos"))


def parts_to_messages(parts: DataFrame) -> DataFrame:
    """Parts (message, part, kind, text, call_id) back to chat rows: texts of a message joined, results as rows of their own."""
    said = parts.filter("kind = 'text'").groupBy("session_id", "message").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda x: x.text), "").alias("text"))
    results = parts.filter("kind = 'result'").select("session_id", "message", F.lit("tool").alias("role"), "text", "call_id", F.col("part").alias("order"))
    return said.select("session_id", "message", F.lit("assistant").alias("role"), "text", F.lit(None).cast("string").alias("call_id"), F.lit(0).alias("order")).unionByName(results)


def reused_ids(fresh: DataFrame, old: DataFrame) -> DataFrame:
    """Ids of old messages stay where index and role agree."""
    known = old.select("session_id", "index", "role", F.col("id").alias("_old"))
    return fresh.join(known, ["session_id", "index", "role"], "left").withColumn("id", F.coalesce("_old", "id")).drop("_old")


def budget_marks(tokens: DataFrame, warn: int = 170_000, stop: int = 190_000) -> DataFrame:
    """Positions at which the running total first reaches the warning and the stop."""
    running = tokens.withColumn("total", F.sum("tokens").over(by_pos()))
    first = lambda n: F.min(F.when(F.col("total") >= n, F.col("pos")))
    return running.groupBy("session_id").agg(first(warn).alias("warned_at"), first(stop).alias("stopped_at"))


def research_stats(log: DataFrame, last: int = 4) -> DataFrame:
    """Last token count, number of tool calls, the last steps, and seconds from first to last event."""
    steps = F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == "tool_call", F.struct("pos", F.col("k").alias("k"))))), lambda x: x.k)
    return log.groupBy("session_id").agg(
        F.max_by(F.when(F.col("kind") == "llm_call", F.col("k")), F.when(F.col("kind") == "llm_call", F.col("pos"))).alias("tokens"),
        F.count_if(F.col("kind") == "tool_call").alias("tools"),
        F.array_join(F.slice(F.reverse(steps), 1, last).cast("array<string>"), ",").alias("last_steps"),
        (F.unix_seconds(F.max("ts")) - F.unix_seconds(F.min("ts"))).alias("elapsed_s"),
    )


def plan_progress(items: DataFrame, allowed: tuple[str, ...] = ("pending", "in_progress", "completed")) -> DataFrame:
    """done / total of each plan, and whether all of its items are well formed."""
    return items.groupBy("plan_id").agg(
        F.count_if(F.col("status") == "completed").alias("done"),
        F.count(F.lit(1)).alias("total"),
        F.bool_and(F.col("id").isNotNull() & (F.coalesce(F.col("content"), F.lit("")) != "") & F.coalesce(F.col("status").isin(*allowed), F.lit(False))).alias("valid"),
    )


def section_lookup(sections: DataFrame, wanted: str) -> DataFrame:
    """Per document the section asked for: by id, then title, then part of a title, then an id below the one asked for; the
    first of the tier."""
    low, want = F.lower("title"), wanted.lower().strip()
    tier = F.when(F.col("id").isin(want, wanted), 1).when(low == want, 2).when(F.contains(low, F.lit(want)), 3).when(F.startswith("id", F.lit(f"{want}.")), 4)
    best = sections.withColumn("tier", tier).filter("tier IS NOT NULL").groupBy("doc").agg(F.min_by(F.struct("id", "title", "tier"), F.struct("tier", "pos")).alias("x"))
    return best.select("doc", "x.id", "x.title", "x.tier")


def seeds(messages: DataFrame) -> DataFrame:
    """What a new session takes over: no system messages, and none without a role or with a role that is no text."""
    return messages.filter(F.coalesce(F.col("role").isin("user", "assistant", "tool"), F.lit(False)))


def session_info(sessions: DataFrame) -> DataFrame:
    """Sessions with the number of their messages and pending calls, whose arguments are an object or {}."""
    call = lambda c: F.struct(c["name"].alias("tool"), c["id"].alias("tool_call_id"), F.coalesce(F.to_json(F.try_parse_json(c["arguments"])), F.lit("{}")).alias("arguments"))
    pending = F.when(F.coalesce(F.size("calls"), F.lit(0)) > 0, F.transform("calls", call))
    return sessions.select("session_id", "user_id", F.coalesce(F.size("messages"), F.lit(0)).alias("message_count"), pending.alias("pending"))


def cache_marked(values: Column, first: bool, mark: Column) -> Column:
    """A list whose first or last element is another and the rest as they were; null and empty lists stay."""
    at = F.lit(0) if first else F.size(values) - 1
    return F.transform(values, lambda x, i: F.when(i == at, mark(x) if callable(mark) else mark).otherwise(x))


def ordered_calls(fragments: DataFrame) -> DataFrame:
    """Per message its calls in order of their index, as one list."""
    calls = F.transform(F.array_sort(F.collect_list(F.struct("index", "id", "name", "arguments"))), lambda c: F.struct(c["id"].alias("id"), c["name"].alias("name"), c["arguments"].alias("arguments")))
    return fragments.groupBy("session_id").agg(calls.alias("calls"))
