"""What a dataset is like: configurations and splits, column types, sample rows, and the format of its messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklore.functions.formats import ellipsis, markdown_table

#: What a dataset server can do, and keys of messages that a report names. Fixed values.
ABILITIES = ("viewer", "preview", "search", "filter", "statistics")
MESSAGE_KEYS = ("role", "content", "tool_calls", "tool_call_id", "name", "function_call")


def status(flags: dict[str, Column]) -> Column:
    able = F.filter(F.array(*(F.when(F.coalesce(flags[x], F.lit(False)), F.lit(x)) for x in ABILITIES if x in flags)), lambda x: x.isNotNull())
    return F.when(F.size(able) > 0, F.concat(F.lit("valid: "), F.array_join(able, ", "))).otherwise("may have issues")


def structure(splits: DataFrame, config: str, split: str, pos: str, most: int = 10) -> DataFrame:
    """The first rows of configuration and split in order of appearance, configurations first, and how many there are in all."""
    once = splits.groupBy(config, split).agg(F.min(pos).alias("_pos"))
    first = Window.partitionBy(config)
    placed = once.withColumn("_first", F.min("_pos").over(first))
    total = once.agg(F.count(F.lit(1)).alias("total"))
    shown = placed.orderBy("_first", "_pos", config, split).limit(most)
    return shown.select(config, split).crossJoin(F.broadcast(total))


def type_name(kind: Column, dtype: Column, names: Column) -> Column:
    """How a feature is called; a class label of up to five names shows them."""
    few = F.array_join(F.transform(names, lambda n, i: F.concat(n, F.lit("="), i.cast("string"))), ", ")
    many = F.coalesce(F.size(names), F.lit(0))
    label = F.when((many > 0) & (many <= 5), F.concat(F.lit("ClassLabel ("), few, F.lit(")"))).otherwise(F.format_string("ClassLabel (%d classes)", F.greatest(many, F.lit(0))))
    return F.when(kind == "ClassLabel", label).otherwise(F.coalesce(F.nullif(dtype, F.lit("")), kind, F.lit("unknown")))


def schema_rows(df: DataFrame) -> list[tuple[str, str]]:
    """Name and type of each column, from the schema alone."""
    return [(f.name, f.dataType.simpleString() if not isinstance(f.dataType, T.UserDefinedType) else f.dataType.typeName()) for f in df.schema]


def samples(df: DataFrame, order: list[str], n: int = 3, most: int = 150) -> DataFrame:
    """The first rows by an order, every value as text of at most so many characters."""
    return df.orderBy(*order).limit(min(n, 10)).select(*(ellipsis(F.col(c).cast("string"), most).alias(c) for c in df.columns))


def messages_format(messages: Column) -> Column:
    """struct(roles, present keys, has_tool_calls, has_tool_results) of one row's messages, a variant list."""
    rows = F.filter(F.try_variant_get(messages, "$", "array<variant>"), lambda m: F.startswith(F.schema_of_variant(m), F.lit("OBJECT")))
    text = lambda m, k: F.coalesce(F.try_variant_get(m, f"$.{k}", "string"), F.lit(""))
    has = lambda k: F.exists(rows, lambda m: F.array_contains(F.map_keys(F.try_variant_get(m, "$", "map<string,variant>")), k))
    roles = F.array_sort(F.array_distinct(F.filter(F.transform(rows, lambda m: text(m, "role")), lambda r: r != "")))
    keys = F.filter(F.array(*(F.when(has(k), F.lit(k)) for k in MESSAGE_KEYS)), lambda k: k.isNotNull())
    results = F.exists(rows, lambda m: text(m, "role").isin("tool", "function") | (text(m, "tool_call_id") != ""))
    return F.struct(roles.alias("roles"), keys.alias("keys"), (has("tool_calls") | has("function_call")).alias("has_tool_calls"), results.alias("has_tool_results"))


def example_message(messages: DataFrame, key: str, pos: str, role: str, calls: Column) -> DataFrame:
    """Per row the message that shows the format best: the first with calls; else the first assistant's; else, of the others
    that are not the system's, the first."""
    tier = F.when(calls, 0).when(F.col(role) == "assistant", 1).when(~F.col(role).eqNullSafe(F.lit("system")), 2)
    kept = messages.withColumn("_tier", tier).filter("_tier IS NOT NULL")
    return kept.groupBy(key).agg(F.min_by(F.struct(pos, role), F.struct("_tier", pos)).alias("x")).select(key, f"x.{pos}", f"x.{role}")


def report(name: str, flags: dict[str, bool], splits: DataFrame, data: DataFrame, order: list[str], config: str = "config", split: str = "split", pos: str = "pos") -> str:
    """What a driver shows of a dataset: whether it is valid, its first configurations and splits, its columns, and sample rows."""
    able = [x for x in ABILITIES if flags.get(x)]
    shown = structure(splits, config, split, pos).collect()
    lines = [f"# {name}", "", f"Valid ({', '.join(able)})" if able else "May have issues", "", markdown_table(["Config", "Split"], [[r[config], r[split]] for r in shown])]
    if shown and shown[0]["total"] > len(shown):
        lines.append(f"(showing {len(shown)} of {shown[0]['total']})")
    lines += ["", markdown_table(["Column", "Type"], [list(x) for x in schema_rows(data)]), ""]
    for i, row in enumerate(samples(data, order).collect(), 1):
        lines += [f"Row {i}:", *(f"- {c}: {row[c]}" for c in data.columns)]
    return "\n".join(lines)
