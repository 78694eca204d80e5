"""Scalar text functions and cleaning of logs, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ANSI = r"\x1b\[[0-9;?]*[A-Za-z]|\x1b\][^\x07]*\x07"
CONTROL = r"[\x00-\x08\x0b-\x1f]"
#: Typographic characters and their plain forms; zero-width ones have none. Fixed values.
TYPOGRAPHIC, PLAIN = "‘’“”–—− ​‌‍﻿", "''\"\"--- "


def strip_ansi(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ANSI), F.lit(""))


def strip_control(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(CONTROL), F.lit(""))


def normalise(text: Column) -> Column:
    return F.translate(text, TYPOGRAPHIC, PLAIN)


def squeeze(text: Column) -> Column:
    """Tabs to spaces, runs of line ends to one, no space around."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, F.lit(r"\t+"), F.lit(" ")), F.lit(r"\n{2,}"), F.lit("\n")))


def truncate(text: Column, most: int) -> Column:
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most - 3)), F.lit("..."))).otherwise(text)


def head_tail(text: Column, most: int, head_share: float = 0.25) -> Column:
    """First quarter and last three quarters of the room, with a note of what is left out between."""
    head = int(most * head_share)
    note = F.concat(F.lit("\n... ["), (F.length(text) - most).cast("string"), F.lit(" characters omitted] ...\n"))
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(head)), note, F.right(text, F.lit(most - head)))).otherwise(text)


def last_segment(line: Column) -> Column:
    """What a terminal shows of a line with carriage returns."""
    parts = F.filter(F.split(F.regexp_replace(line, F.lit(r"\r$"), F.lit("")), "\r"), lambda x: x != "")
    return F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit(""))


def size_label(size: Column) -> Column:
    units = ("B", "KB", "MB", "GB", "TB", "PB")
    out = F.concat(F.format_string("%.1f", size / 1024.0 ** (len(units) - 1)), F.lit(f" {units[-1]}"))
    for i in range(len(units) - 2, -1, -1):
        out = F.when(size < 1024.0 ** (i + 1), F.concat(F.format_string("%.1f", size / 1024.0**i), F.lit(f" {units[i]}"))).otherwise(out)
    return out


def lines(df: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """One row for each line, numbered from 1."""
    return df.select(*keys, F.posexplode(F.split(text, "\n")).alias("_pos", "line")).select(*keys, (F.col("_pos") + 1).alias("n"), "line")


def line_range(df: DataFrame, first: int, last: int, *keys: str, cap: int = 4000) -> DataFrame:
    return lines(df, *keys).filter(F.col("n").between(first, last)).withColumn("line", F.left("line", F.lit(cap)))


def collapse(numbered: DataFrame, kind: Column, key: str) -> DataFrame:
    """Drops a line of some kind when the next line is of that kind too, so that the last of a run stays."""
    marked = numbered.withColumn("_kind", kind)
    following = F.lead("_kind").over(Window.partitionBy(key).orderBy("n"))
    return marked.withColumn("_next", following).filter(F.col("_kind").isNull() | F.col("_next").isNull() | (F.col("_kind") != F.col("_next"))).drop("_kind", "_next")


def from_first(numbered: DataFrame, pattern: str, key: str) -> DataFrame:
    """Lines from the first match on, if any line matches after the first."""
    start = F.min(F.when(F.col("line").rlike(pattern) & (F.col("n") > 1), F.col("n"))).over(Window.partitionBy(key))
    return numbered.withColumn("_start", F.coalesce(start, F.lit(0))).filter(F.col("n") >= F.col("_start")).drop("_start")
