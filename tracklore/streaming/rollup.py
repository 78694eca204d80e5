"""Structured Streaming forms of the rollup, snapshots, quotas and stream parsing.

Each takes a streaming (or static) DataFrame, so that tests hold a stream against its batch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def hourly(events: DataFrame, late: str = "2 days") -> DataFrame:
    """One row an hour of event time; later events than the watermark are dropped, as the two-day lookback would. Users and the
    median are sketches of bounded size, so that the state of an hour does not grow with its events."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return timed.groupBy(F.window("at", "1 hour")).agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("user_id", 0.01).alias("users"), F.sum("value").alias("value"), F.percentile_approx("value", 0.5, 1000).alias("p50")
    ).select(F.date_format("window.start", "yyyy-MM-dd'T'HH").alias("bucket"), "n", "users", F.round("value", 2).alias("value"), F.round("p50", 2).alias("p50"))


def daily_counter(ops: DataFrame) -> DataFrame:
    """Keyed state for each user and UTC day: increments less refunds, floored at zero. A late event counts for its own day."""

    def step(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        used = state.get[0] if state.exists else 0
        for op in pd.concat(parts).sort_values(["ts", "event_id"])["op"]:
            used = used + 1 if op == "inc" else max(0, used - 1)
        state.update((used,))
        yield pd.DataFrame({"user_id": [key[0]], "day": [key[1]], "used": [used]})

    dated = ops.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return dated.groupBy("user_id", "day").applyInPandasWithState(step, "user_id long, day string, used int", "used int", "update", GroupStateTimeout.NoTimeout)


def latest_snapshots(rows: DataFrame) -> DataFrame:
    """The last snapshot of each session by save time; one row of state for each."""
    others = [c for c in rows.columns if c != "session_id"]
    return rows.groupBy("session_id").agg(F.max_by(F.struct(*others), "last_save_time").alias("x")).select("session_id", *(F.col(f"x.{c}").alias(c) for c in others))


def server_events(lines: DataFrame, column: str = "value") -> DataFrame:
    """Payloads of `data: ` lines of a stream of server-sent events; lines that hold no JSON are passed over."""
    line = lines.select(F.explode(F.split(column, "\n")).alias("line")).filter(F.startswith("line", F.lit("data: ")))
    parsed = line.select(F.try_parse_json(F.substr("line", F.lit(7))).alias("data")).filter("data IS NOT NULL")
    return parsed.select(F.try_variant_get("data", "$.event_type", "string").alias("event_type"), F.to_json("data").alias("payload"))


def deltas(fragments: DataFrame) -> DataFrame:
    """Tool calls put together from fragments: arguments in order of position, the last id and name that are not empty."""
    text = F.transform(F.array_sort(F.collect_list(F.struct("pos", "arguments"))), lambda x: F.coalesce(x.arguments, F.lit("")))
    last = lambda c: F.max_by(F.when(F.col(c) != "", F.col(c)), F.when(F.col(c) != "", F.col("pos"))).alias(c)
    return fragments.groupBy("session_id", "index").agg(last("id"), last("name"), F.array_join(text, "").alias("arguments"))


#: Kinds of events that end a turn. Fixed values.
TERMINAL = ("turn_complete", "approval_required", "error", "interrupted", "shutdown")


def until_terminal(events: DataFrame, terminal: tuple[str, ...] = TERMINAL) -> DataFrame:
    """Events of a session up to and with the first terminal one."""
    ends = events.groupBy("session_id").agg(F.min(F.when(F.col("event_type").isin(*terminal), F.col("pos"))).alias("_end"))
    return events.join(ends, "session_id").filter(F.col("_end").isNull() | (F.col("pos") <= F.col("_end"))).drop("_end")


def write_hours(batch: DataFrame, folder: str) -> None:
    """foreachBatch sink: hours of the batch replace those hours, others stay, so that a rerun changes nothing."""
    parts = batch.withColumns({"date": F.substring("bucket", 1, 10), "hour": F.substring("bucket", 12, 2)})
    parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "hour").option("header", True).csv(folder)


def fan_out(events: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Each event once for every subscriber of its session; events without one are discarded. `subscriptions` (session_id,
    subscriber) is a static table, so nothing is held for events."""
    return events.join(subscriptions, "session_id")


def write_each(batch: DataFrame, folder: str) -> None:
    """foreachBatch sink: a folder for each subscriber, one write for all."""
    batch.write.mode("append").partitionBy("subscriber").json(folder)


#: What a stream shows of an event; `close` ends an open text first. Fixed values.
_ENDS = {"turn_complete": "stop", "interrupted": "stop", "shutdown": "stop", "error": "error"}


def _shown(kind: str, content: str, call: str, tool: str, ok: bool, number: int, is_open: bool) -> tuple[list[tuple[str, str, str]], int, bool]:
    """Chunks (type, id, body) of one event, and the state after it: how many texts there were, and whether one is open."""
    close = [("text-end", f"text-{number}", "")] if is_open else []
    plan = tool == "plan_tool" or call.startswith("plan_tool")
    if kind == "assistant_chunk" and content:
        new = number if is_open else number + 1
        return [*([] if is_open else [("text-start", f"text-{new}", "")]), ("text-delta", f"text-{new}", content)], new, True
    if kind == "assistant_message" and content:
        own = f"text-{number + 1}"
        return [("text-start", own, ""), ("text-delta", own, content), ("text-end", own, "")], number + 1, is_open
    if kind in _ENDS:
        return [*close, ("finish-step", "", ""), ("finish", "", _ENDS[kind])], number, False
    if kind in ("assistant_stream_end", "undo_complete"):
        return close, number, False
    if kind == "processing":
        return [("start", "", ""), ("start-step", "", "")], number, is_open
    if kind == "tool_call" and not plan:
        return [*close, ("tool-input-start", call, tool), ("tool-input-available", call, content)], number, False
    if kind == "tool_output" and not plan:
        return [("tool-output-available" if ok else "tool-output-error", call, content)], number, is_open
    if kind == "approval_required":
        return [*close, ("tool-approval-request", f"approval-{call}", call)], number, False
    if kind == "tool_state_change" and not plan and content in ("rejected", "abandoned", "cancelled"):
        return [("tool-output-error", call, "Cancelled by user") if content == "cancelled" else ("tool-output-denied", call, "")], number, is_open
    return [], number, is_open


def chunks(events: DataFrame) -> DataFrame:
    """What a reader is shown of each session's events (session_id, pos, event_type, content, call_id, tool, success): texts are
    opened by their first piece and closed by what ends them, over batches of the stream."""

    def step(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, is_open = state.get if state.exists else (0, False)
        rows = []
        for e in pd.concat(parts).sort_values("pos").itertuples(index=False):
            found, number, is_open = _shown(e.event_type, e.content or "", e.call_id or "", e.tool or "", bool(e.success), number, is_open)
            rows += [(key[0], e.pos, i, *x) for i, x in enumerate(found)]
        state.update((number, is_open))
        yield pd.DataFrame(rows, columns=["session_id", "pos", "n", "type", "id", "body"])

    out = "session_id string, pos long, n int, type string, id string, body string"
    return events.groupBy("session_id").applyInPandasWithState(step, out, "number int, open boolean", "append", GroupStateTimeout.NoTimeout)


def each_hour(stream: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None):
    """Starts the hourly rollup: each trigger, an hour apart unless another is given, writes the hours that are complete, and
    what was missed while down is caught up. Runs of one checkpoint never overlap."""
    query = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 hour"}))
    return query.foreachBatch(lambda batch, _: write_hours(batch, folder)).start()
