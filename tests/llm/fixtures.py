"""Small tables with the cases that every operator has to bear."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows], DOCS)


def sample(sf="sf0.001"):
    """(doc_id, text) of the driver's smallest documents."""
    import pyarrow.parquet as pq

    t = pq.read_table(f"/root/testdata/{sf}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))
