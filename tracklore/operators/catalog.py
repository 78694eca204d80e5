"""Model catalogs: providers of a model, what they offer together, effort levels, and entries that expire."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names that route by policy instead of by provider, and the efforts to try for each asked. Fixed values.
POLICIES = ("fastest", "cheapest", "preferred")
CASCADE = {
    "max": ("max", "xhigh", "high", "medium", "low"),
    "xhigh": ("xhigh", "high", "medium", "low"),
    "high": ("high", "medium", "low"),
    "medium": ("medium", "low"),
    "minimal": ("minimal", "low"),
    "low": ("low",),
}


def live(providers: Column) -> Column:
    return F.filter(providers, lambda p: F.coalesce(p["status"] == "live", F.lit(False)))


def longest_context(providers: Column) -> Column:
    """The longest context of live providers that state one; null without any."""
    return F.array_max(F.filter(F.transform(live(providers), lambda p: p["context_length"]), lambda n: n > 0))


def any_with_tools(providers: Column) -> Column:
    return F.coalesce(F.exists(live(providers), lambda p: F.coalesce(p["supports_tools"], F.lit(False))), F.lit(False))


def pin_served(providers: Column, pin: Column) -> Column:
    """Whether a pinned provider serves the model now; a policy or no pin always does."""
    named = F.nullif(pin, F.lit(""))
    return named.isNull() | F.coalesce(named.isin(*POLICIES), F.lit(False)) | F.coalesce(F.exists(live(providers), lambda p: p["provider"] == named), F.lit(False))


def first_effort(asked: Column, accepted: Column) -> Column:
    """The first level of the cascade of the asked one that is accepted; null if none is."""
    levels = F.create_map(*(x for name, steps in CASCADE.items() for x in (F.lit(name), F.array(*map(F.lit, steps)))))
    return F.get(F.filter(F.try_element_at(levels, asked), lambda x: F.array_contains(accepted, x)), F.lit(0))


def unexpired(rows: DataFrame, now: Column, expires: str = "expires_at") -> DataFrame:
    """Sweep: what has not run out."""
    return rows.filter(F.col(expires) > now)


def fresh_or_stale(cached: DataFrame, fetched: DataFrame, now: Column, key: str, ttl: int = 300) -> DataFrame:
    """Of each key the fetched row, or else, where the fetch failed, the cached one however old; a cached row that is not
    older than `ttl` seconds stays. Both have `value` and `at`."""
    old = cached.select(key, F.col("value").alias("_old"), F.col("at").alias("_at"))
    both = old.join(fetched.select(key, F.col("value").alias("_new")), key, "full")
    young = F.col("_at").isNotNull() & (F.unix_seconds(now) - F.unix_seconds("_at") < ttl)
    return both.select(key, F.when(young, F.col("_old")).otherwise(F.coalesce("_new", "_old")).alias("value"), (~young & F.col("_new").isNull()).alias("stale"))


def capped(asked: Column, default: int = 20, most: int = 50) -> Column:
    """How many results to show: the default, or what is asked up to the cap; null for no positive number."""
    return F.when(asked.isNull(), F.lit(default)).when(asked > 0, F.least(asked, F.lit(most)))


def cap_note(asked: Column, default: int = 20, most: int = 50) -> Column:
    over = F.format_string(f"Requested %d but showing top {most} (maximum).", asked)
    return F.when(asked.isNull(), F.lit(f"Showing top {default} results (set max_results to adjust).")).when(asked > most, over)
