"""Writers: idempotent by partition, so that a rerun of an hour or day replaces it."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklore.functions.redact import scrub_json


def _partitioned(df: DataFrame, by: list[str]):
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)


def write_sessions(rows: DataFrame, folder: str, nested: tuple[str, ...] = ("messages", "events", "tools")) -> None:
    """Redacted session rows, nested columns as JSON strings, by date of start. Rows already sent are left out."""
    clean = rows.filter(F.coalesce(F.col("upload_status"), F.lit("pending")) != "success") if "upload_status" in rows.columns else rows
    clean = clean.withColumns({c: scrub_json(F.col(c).cast("string")) for c in nested})
    _partitioned(clean.withColumn("date", F.to_date("session_start_time")), ["date"]).json(folder)


def write_kpis(rows: DataFrame, folder: str) -> None:
    """CSV with a header by date and hour of the bucket, which stays the first column; quotes only where needed."""
    first = rows.select("bucket", *(c for c in rows.columns if c != "bucket"))
    parts = first.withColumns({"date": F.substring("bucket", 1, 10), "hour": F.substring("bucket", 12, 2)})
    _partitioned(parts, ["date", "hour"]).option("header", True).option("quote", '"').option("escape", '"').csv(folder)


def write_sft(rows: DataFrame, folder: str) -> None:
    """Training rows (operators/trajectories.training_rows) as JSON lines by day."""
    _partitioned(rows.filter("day IS NOT NULL"), ["day"]).json(folder)


def write_status(rows: DataFrame, updates: DataFrame, folder: str, key: str = "session_id", by: str = "date") -> None:
    """The status of some rows of a table that is partitioned by `by`: only their partitions are written anew. `updates` has
    the key and the status."""
    new = updates.select(key, F.col("status").alias("_new"))
    touched = rows.join(new.select(key), key, "left_semi").select(by).distinct()
    changed = rows.join(touched, by, "left_semi").join(new, key, "left").withColumn("status", F.coalesce("_new", "status")).drop("_new")
    _partitioned(changed.select(*rows.columns), [by]).parquet(folder)


def write_spills(outputs: DataFrame, folder: str, key: str, text: str, most: int) -> None:
    """Whole outputs that are shown shortened, beside the table that shows them."""
    outputs.filter(F.length(text) > most).select(key, text).write.mode("overwrite").parquet(folder)


def save_one(text: str, path: str) -> None:
    """One small file of the driver, whole or not at all."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=os.path.dirname(path))
    with os.fdopen(handle, "w") as f:
        f.write(text)
    os.replace(temporary, path)


def newest(rows: DataFrame, k: int, inserted: str) -> DataFrame:
    """The k rows inserted last: a bounded cache that forgets the oldest."""
    return rows.orderBy(F.desc(inserted)).limit(k)


def rekeyed(rows: DataFrame, key: str, old: str, new: str) -> DataFrame:
    """A row moved from one key to another; what the other key held goes."""
    kept = rows.filter(~F.col(key).eqNullSafe(F.lit(new)))
    return kept.withColumn(key, F.when(F.col(key) == old, F.lit(new)).otherwise(F.col(key)))
