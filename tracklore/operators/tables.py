"""Profiles, set operators and sorted limits over tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def groups_with_sizes(files: DataFrame, config: str, split: str, size: Column) -> DataFrame:
    return files.groupBy(config, split).agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("size"))


def splits(files: DataFrame, config: str, split: str, pos: str) -> DataFrame:
    """Splits of each configuration, in order of first appearance."""
    first = files.groupBy(config, split).agg(F.min(pos).alias("pos"))
    names = F.transform(F.array_sort(F.collect_list(F.struct("pos", split))), lambda x: x[split])
    return first.groupBy(config).agg(F.array_join(names, ",").alias("splits"))


def message_profile(messages: DataFrame) -> DataFrame:
    return messages.agg(F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"), F.count(F.lit(1)).alias("n"), F.bool_or(F.col("role") == "tool").alias("has_tool_results"))


def top(rows: DataFrame, k: int, *order: Column, keep: Column | None = None) -> DataFrame:
    """The k first by the order, after the filter: a per-partition top-k and one merge, never a full sort."""
    return (rows if keep is None else rows.filter(keep)).orderBy(*order).limit(k)


def sorted_distinct(values: Column) -> Column:
    return F.array_sort(F.array_distinct(values))


def without_prefixes(tags: Column, prefixes: tuple[str, ...], k: int) -> Column:
    good = lambda x: ~F.greatest(*(F.startswith(x, F.lit(p)) for p in prefixes), F.lit(False))
    return F.slice(F.filter(tags, good), 1, k)


def lookup_first(rows: DataFrame, catalog: DataFrame, name: str, default) -> DataFrame:
    """The catalog's value of the raw name, else of the name without prefix and tag, else the default. An id that the catalog
    has twice counts once, with its least value."""
    bare = F.split(F.element_at(F.split(name, "/"), -1), ":")[0]
    once = catalog.groupBy("id").agg(F.min("value").alias("value"))
    raw, cut = once.select(F.col("id").alias("_raw"), F.col("value").alias("_a")), once.select(F.col("id").alias("_cut"), F.col("value").alias("_b"))
    return rows.join(raw, F.col(name) == F.col("_raw"), "left").join(cut, bare == F.col("_cut"), "left").withColumn("value", F.coalesce("_a", "_b", F.lit(default))).drop("_raw", "_cut", "_a", "_b")


def usage(prompt: Column, completion: Column, cache_keys: list[Column], total: Column) -> Column:
    """struct(prompt, completion, cache_read, total) of one call: the first cache count that is not zero, whatever the provider
    calls it, and the total that is reported, or else the sum."""
    count = lambda c: F.coalesce(c, F.lit(0))
    cached = F.coalesce(*(F.nullif(c, F.lit(0)) for c in cache_keys), F.lit(0))
    return F.struct(count(prompt).alias("prompt"), count(completion).alias("completion"), cached.alias("cache_read"), F.coalesce(F.nullif(total, F.lit(0)), count(prompt) + count(completion)).alias("total"))


def union_with_kind(tables: dict[str, DataFrame]) -> DataFrame:
    """Tables of one shape under each other, each row with the name of its table as `kind`."""
    out = None
    for kind, table in tables.items():
        part = table.select(F.lit(kind).alias("kind"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def unpivot_bits(rows: DataFrame, key: str, flags: dict[str, Column]) -> DataFrame:
    """Names of the flags that hold, in the given order."""
    names = F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in flags.items())), lambda x: x.isNotNull())
    return rows.select(key, F.array_join(names, ",").alias("flags"))
