"""The event log: one row for each event with an explicit position in its session.

log() reads persisted session rows, whose messages, events and tools are JSON strings; from_events() adapts the `events`
table to the same columns, so that every rollup runs on either."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Graphics processors of a job flavor, and its family; fixed values.
FLAVORS = {
    "cpu-basic": (0, "none"), "cpu-upgrade": (0, "none"), "t4-small": (1, "t4"), "t4-medium": (1, "t4"),
    "l4x1": (1, "l40s"), "l4x4": (4, "l40s"), "l40sx1": (1, "l40s"), "l40sx4": (4, "l40s"), "l40sx8": (8, "l40s"),
    "a10g-small": (1, "a10g"), "a10g-large": (1, "a10g"), "a10g-largex2": (2, "a10g"), "a10g-largex4": (4, "a10g"),
    "a100-large": (1, "a100"), "a100x2": (2, "a100"), "a100x4": (4, "a100"), "a100x8": (8, "a100"), "h100": (1, "h100"), "h100x8": (8, "h100"),
}


def lookup(column, place: int):
    """A literal map over FLAVORS: 19 rows need neither a join nor a broadcast."""
    table = F.create_map(*(F.lit(x) for name, values in FLAVORS.items() for x in (name, values[place])))
    return F.try_element_at(table, column)


def from_events(events: DataFrame, by_day: bool = True, placed: bool = True) -> DataFrame:
    """session_id, user_id, session_start, pos, ts, kind, k and value from the flat events table. Where only the order of positions
    counts, `placed` may be off: pos is then the event's id, and no shuffle numbers the events."""
    ts = F.col("ts").cast("timestamp")
    day = F.date_trunc("day", ts)
    session = F.concat(F.col("user_id").cast("string"), F.lit("_"), F.date_format(ts, "yyyy-MM-dd")) if by_day else F.col("user_id").cast("string")
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.expr("CASE event_type WHEN 'purchase' THEN 'llm_call' WHEN 'click' THEN 'tool_call' WHEN 'view' THEN 'tool_output' WHEN 'signup' THEN 'feedback' ELSE event_type END")
    order = Window.partitionBy("session_id").orderBy("event_id")
    picked = events.select("event_id", "user_id", session.alias("session_id"), day.alias("day"), ts.alias("ts"), kind.alias("kind"), k.alias("k"), "value")
    start = F.col("day") if by_day else F.date_trunc("day", F.min("ts").over(Window.partitionBy("session_id")))
    return picked.withColumns({"pos": F.row_number().over(order) if placed else F.col("event_id"), "session_start": start}).drop("day")


def sessions(raw: DataFrame, column: str = "value") -> DataFrame:
    """Persisted session rows from the first line of each whole text; blank or malformed texts give no row."""
    line = F.trim(F.element_at(F.split(column, "\n"), 1))
    parsed = raw.select(F.try_parse_json(line).alias("row")).filter("row IS NOT NULL")
    text = lambda name: F.try_variant_get("row", f"$.{name}", "string").alias(name)

    def nested(name):
        held = F.try_variant_get("row", f"$.{name}", "string")
        return F.coalesce(F.try_parse_json(held), F.try_parse_json(F.lit("[]"))).alias(name)

    return parsed.select(*map(text, ("session_id", "session_start_time", "session_end_time", "model_name", "user_id")), *map(nested, ("messages", "events", "tools")))


def log(session_rows: DataFrame) -> DataFrame:
    """session_id, pos, ts, kind and data (variant); an event with an unreadable time has a null ts."""
    each = session_rows.lateralJoin(session_rows.sparkSession.tvf.variant_explode(F.col("events").outer()))
    text = lambda path: F.try_variant_get("value", path, "string")
    return each.select(
        "session_id", "user_id", F.try_to_timestamp("session_start_time").alias("session_start"), (F.col("pos") + 1).alias("pos"),
        F.try_to_timestamp(text("$.timestamp")).alias("ts"), text("$.event_type").alias("kind"), F.try_variant_get("value", "$.data", "variant").alias("data"),
    )
