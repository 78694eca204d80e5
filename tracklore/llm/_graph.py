"""Connected components by minimum labels and pointer jumping, in tables of the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklore.llm._work import Work


def components(work: Work, edges: DataFrame, name: str) -> DataFrame:
    """edges (a, b) -> (node, comp): the smallest node that can be reached. Nodes without edges are absent.

    Each round takes the least label among neighbours, by an aggregation that combines before its shuffle, and then the
    label of that label, so that long chains shorten geometrically. Only the count of changes comes to the driver."""
    both = work.cut(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{name}-edges")
    labels = work.cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("comp")), f"{name}-0")
    for k in range(1, 64):
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("comp").alias("near"))
        pulled = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        over = labels.select(F.col("node").alias("via"), F.col("comp").alias("next"))
        jumped = pulled.join(over, F.col("comp") == F.col("via"), "left").select("node", "old", F.least("comp", "next").alias("comp"))
        done = work.cut(jumped, f"{name}-{k}")
        work.drop(f"{name}-{k - 1}", release=False)
        changed = done.filter("comp != old").limit(1).count()
        labels = done.select("node", "comp")
        if not changed:
            work.drop(f"{name}-edges")
            return labels
    raise RuntimeError("labels did not settle")
