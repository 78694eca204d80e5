"""Papers, their citations and resources, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklore.functions.formats import ellipsis
from tracklore.operators.rules import first_given

#: Sort keys of resources by the name a user gives. Fixed values.
SORTS = {"downloads": "downloads", "likes": "likes", "trending": "trendingScore"}


def sort_key(asked: Column) -> Column:
    names = F.create_map(*(F.lit(x) for pair in SORTS.items() for x in pair))
    return F.coalesce(F.try_element_at(names, F.coalesce(asked, F.lit(""))), F.lit(SORTS["downloads"]))


def resources(papers: DataFrame, linked: dict[str, DataFrame], key: str, order: str, most: int = 10) -> DataFrame:
    """Of each paper the first resources of every kind by a number, largest first: tables by kind, with the paper's key, id and
    that number, put one under the other and cut by one window."""
    every = None
    for kind, table in linked.items():
        part = table.select(key, F.lit(kind).alias("kind"), "id", F.col(order).alias("weight"))
        every = part if every is None else every.unionByName(part)
    rank = F.row_number().over(Window.partitionBy(key, "kind").orderBy(F.desc("weight"), "id"))
    return papers.select(key).join(every.withColumn("rank", rank).filter(F.col("rank") <= most), key)


def paper_line(title: Column, upvotes: Column, keywords: Column, own_summary: Column, summary: Column, most: int = 300) -> Column:
    """struct(title, upvotes, keywords, summary) as a list of papers shows it: five keywords, and the written summary first."""
    text = first_given(own_summary, summary)
    return F.struct(F.coalesce(title, F.lit("Unknown")).alias("title"), F.coalesce(upvotes, F.lit(0)).alias("upvotes"), F.array_join(F.slice(keywords, 1, 5), ", ").alias("keywords"), ellipsis(text, most).alias("summary"))


def authors_line(names: Column, most: int = 10) -> Column:
    shown = F.array_join(F.filter(F.slice(names, 1, most), lambda x: F.coalesce(x, F.lit("")) != ""), ", ")
    return F.concat(shown, F.when(F.size(names) > most, F.format_string(" (+%d more)", F.size(names) - most)).otherwise(""))


def citation_entry(entry: Column) -> Column:
    """struct(line, intents, contexts) of a citation (title, year, cites, arxiv, influential, intents, contexts)."""
    line = F.concat(
        F.lit("- **"), F.coalesce(F.nullif(entry["title"], F.lit("")), F.lit("(untitled)")), F.lit("** ("), F.coalesce(entry["year"].cast("string"), F.lit("?")), F.lit(", "),
        F.coalesce(entry["cites"], F.lit(0)).cast("string"), F.lit(" cites)"), F.when(F.coalesce(entry["influential"], F.lit(False)), " **[influential]**").otherwise(""),
        F.when(F.coalesce(entry["arxiv"], F.lit("")) != "", F.concat(F.lit("  arxiv:"), entry["arxiv"])).otherwise(""),
    )
    contexts = F.transform(F.filter(F.slice(entry["contexts"], 1, 2), lambda x: F.coalesce(x, F.lit("")) != ""), lambda x: ellipsis(x, 200))
    return F.struct(line.alias("line"), F.array_join(entry["intents"], ", ").alias("intents"), F.array_join(contexts, "\n").alias("contexts"))


def id_lists(positive: Column, negative: Column) -> Column:
    """struct(positive, negative): lists of prefixed ids from texts with commas."""
    ids = lambda text: F.transform(F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != ""), prefixed)
    return F.struct(ids(positive).alias("positive"), ids(negative).alias("negative"))


def prefixed(arxiv: Column) -> Column:
    return F.concat(F.lit("ARXIV:"), arxiv)


def cache_key(path: Column, params: Column) -> Column:
    """A request's path with its parameters in order of their names."""
    pairs = F.transform(F.array_sort(F.map_entries(params)), lambda e: F.concat(F.lit("('"), e["key"], F.lit("', '"), e["value"], F.lit("')")))
    return F.concat(path, F.lit(":("), F.array_join(pairs, ", "), F.when(F.size(pairs) == 1, ",").otherwise(""), F.lit(")"))


def section_number(heading: Column) -> Column:
    """The number a heading begins with, empty without one."""
    return F.regexp_extract(heading, r"^([A-Z]?\d+(?:\.\d+)*)\s", 1)
