"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations alone.

Sources in code point order, null last, take the weights in turn. Their targets share the sum of all sizes by weight; a
target stops at `repeats` times its source's size, and what is over is shared again by weight until none is above. In each
source, documents are queued in the order of a digest of their id, up to `repeats` rounds long. A copy's virtual finish
time is the words of its source queued up to its end, divided by its source's target, so that all sources reach their
targets at time one. Copies are taken in the order of finish times until the sum of all targets is used up, and the copy
on that line is cut.

Running sums never gather a source or the whole queue: both the queues and the time line are globally range-sorted into as
many ranges as the session has partitions for, each range adds up within itself, and the sums of ranges, few rows, are
added up before them. On the time line only the range that holds the budget's end is looked into.

Null text has size zero; documents of size zero are taken zero times. Rows that repeat a doc_id are documents of their own,
in a queue at neighbouring places. A null doc_id has a digest like any other. With no words at all every target is zero. An
empty table gives an empty table. Other columns pass unchanged; those named like results are replaced."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tracklore.llm._work import Work, aside, restored, row_hash

WORD = r"[^\x20\x09-\x0D]+"


def words(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), repeats: int = 3) -> DataFrame:
    """source, place (from 1), source_size, target; one row for each source of rows with source and size."""
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = by.withColumn("place", F.row_number().over(order).cast("long"))
    ranked = ranked.withColumns({"weight": F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int")).cast("long"), "most": F.col("source_size") * repeats})
    # The fixed point of sharing again: sources in the order of most / weight stop at their most, as long as the level of
    # the rest is above it.
    line = Window.orderBy(F.col("most") / F.col("weight"), "place")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    after = line.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(after)
    leveled = ranked.withColumn("level", level).withColumn("stops", F.col("most") / F.col("weight") <= F.col("level"))
    rest = F.min(F.when(~F.col("stops"), F.struct(F.col("most") / F.col("weight"), "place", "level"))).over(everything).getField("level")
    target = F.when(F.col("stops") | rest.isNull(), F.col("most").cast("double")).otherwise(rest * F.col("weight"))
    return leveled.withColumn("target", target).select("source", "place", "source_size", "target")


def _ranged(work: Work, rows: DataFrame, name: str, *order: str) -> DataFrame:
    """rows, globally range-sorted: `range` is the number of the range of the order that a row lies in."""
    return work.cut(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), name)


def _queued(work: Work, sized: DataFrame, by_source: DataFrame) -> DataFrame:
    """sized with place, source_size, target and `ahead`, the words of its source queued before it."""
    placed = sized.join(by_source, F.equal_null(sized.source, by_source.source)).drop(by_source.source)
    ranged = _ranged(work, placed, "ranged", "place", "digest", "row")
    sums = ranged.groupBy("place", "range").agg(F.sum("size").alias("inside"))
    so_far = Window.partitionBy("place").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("inside").over(so_far), F.lit(0))).drop("inside")
    within = Window.partitionBy("place", "range").orderBy("digest", "row").rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return summed.join(sums, ["place", "range"]).withColumn("ahead", F.col("before") + F.col("within")).drop("range", "before", "within")


def _finish(round_, size="size"):
    """Virtual finish time of a copy: what its source has queued up to its end, by the source's target."""
    return (round_ * F.col("source_size") + F.col("ahead") + F.col(size)) / F.col("target")


#: The order in which copies are taken; no two copies are alike in all of it.
LINE = ("finish", "place", "round", "digest", "row", "ahead")


def _last(work: Work, copies: DataFrame, budget: int) -> Row | None:
    """The copy on the line, with `cut`, the words of it that are taken; None if the budget takes all."""
    line = _ranged(work, copies, "line", *LINE)
    sums = line.groupBy("range").agg(F.sum("size").alias("inside"))
    so_far = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    reached = sums.withColumn("before", F.coalesce(F.sum("inside").over(so_far), F.lit(0))).filter(F.col("before") + F.col("inside") >= budget).orderBy("range").first()
    if reached is None:
        return None
    before = F.coalesce(F.sum("size").over(Window.partitionBy("range").orderBy(*LINE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = line.filter(F.col("range") == reached["range"]).withColumn("cut", F.least(F.col("size"), budget - reached["before"] - before))
    last = inside.filter("cut > 0").orderBy(*(F.desc(c) for c in LINE)).first()
    work.drop("line")
    return last


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), repeats: int = 3, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """docs, without the text, with size, source_size, target and taken (words, copies counted)."""
    work = Work(docs.sparkSession, "mixing")
    results = ("size", "source_size", "target", "taken")
    kept = [c for c in docs.columns if c not in (*results, text)]
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("null")))
    # A row's hash tells apart rows that repeat a doc_id; rows alike in all are alike in result.
    sized = docs.select(aside(kept), F.col(source).alias("source"), words(text).alias("size"), digest.alias("digest"), row_hash(docs).alias("row"))
    sized = work.cut(sized, "sized")
    by_source = work.cut(targets(sized, weights, repeats), "targets")
    queued = work.cut(_queued(work, sized, by_source), "queued")
    work.drop("sized")
    work.drop("ranged")
    budget = by_source.agg(F.sum("source_size")).first()[0] or 0
    rounds = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("round")
    copies = queued.filter("size > 0").select("place", "size", "source_size", "target", "ahead", "digest", "row", rounds).withColumn("finish", _finish(F.col("round")))
    last = _last(work, copies.select(*LINE, "size"), budget) if budget else None
    # Copies before the one on the line are taken whole, that one is cut, and those after it are not taken.
    taken = F.lit(0).cast("long")
    if budget:
        for k in range(repeats):
            if last is None:
                taken += F.col("size")
                continue
            own = F.struct(_finish(F.lit(k)).alias("finish"), "place", F.lit(k).alias("round"), "digest", "row", "ahead")
            line = F.struct(*(F.lit(last[c]).cast(copies.schema[c].dataType).alias(c) for c in LINE))
            taken += F.when(own < line, F.col("size")).when(own == line, F.lit(last["cut"])).otherwise(0)
        taken = F.when(F.col("size") > 0, taken).otherwise(0).cast("long")
    return queued.select(*restored(kept), "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), repeats: int = 3) -> DataFrame:
    """The mixture itself: each row of docs as often as it is taken whole, and the copy on the line cut after its words."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    marked = mix(docs.select(aside(others), "doc_id", "source", "text", F.col("text").alias("_text")), weights, repeats)
    copies = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    rest = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0).cast("int")
    start = F.array_join(F.slice(F.regexp_extract_all("_text", F.lit(f"({WORD})")), F.lit(1), rest), " ")
    texts = F.concat(F.array_repeat(F.col("_text"), copies), F.when(rest > 0, F.array(start)).otherwise(F.array().cast("array<string>")))
    rows = marked.select("_kept", F.explode(texts).alias("_mixed"))
    own = {"text": F.col("_mixed"), "n_chars": F.length("_mixed").cast("long")}
    return rows.select(*(own[c].alias(c) if c in own else F.col("_kept").getField(c).alias(c) for c in docs.columns))
