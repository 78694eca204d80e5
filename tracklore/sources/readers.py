"""Readers of files and of the shapes that APIs return, as DataFrames."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tracklore.sources.event_log import sessions


def session_files(spark: SparkSession, root: str, day: str) -> DataFrame:
    """Sessions of one date folder; only that folder is listed."""
    raw = spark.read.text(f"{root}/{day}", wholetext=True, pathGlobFilter="*.jsonl")
    return sessions(raw)


def unsent_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Local saves whose upload is pending or failed; unreadable files are passed over."""
    raw = spark.read.text(folder, wholetext=True, pathGlobFilter="session_*.json")
    parsed = raw.select(F.try_parse_json("value").alias("row")).filter("row IS NOT NULL")
    pick = lambda n: F.try_variant_get("row", f"$.{n}", "string").alias(n)
    return parsed.select(*map(pick, ("session_id", "upload_status", "upload_url", "last_save_time"))).filter(F.col("upload_status").isin("pending", "failed"))


def file_tree(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Paths and sizes of all files, by path; folders are no rows and contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder).select("path", F.col("length").alias("size")).orderBy("path")


def tree_size(tree: DataFrame) -> DataFrame:
    return tree.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("size"))


def text_files(spark: SparkSession, folder: str, cap: int = 100_000) -> DataFrame:
    """Texts of at most so many characters; of a file that is no text, only that and its size."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    note = F.format_string("[Binary file, %d bytes]", "length")
    return files.select("path", F.when(F.is_valid_utf8(F.col("content")), F.left(F.decode("content", "UTF-8"), F.lit(cap))).otherwise(note).alias("text"))


def job_logs(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of lines of growing log folders, with the file each comes from; a restart goes on after what was read."""
    return spark.readStream.option("recursiveFileLookup", True).text(folder).select(F.input_file_name().alias("path"), F.col("value").alias("line"))


def base64_text(column: Column) -> Column:
    """Decoded text; the raw value where nothing comes of it."""
    return F.coalesce(F.nullif(F.decode(F.unbase64(F.regexp_replace(column, F.lit(r"\s"), F.lit(""))), "UTF-8"), F.lit("")), column)


def content_blocks(blocks: Column) -> Column:
    """Blocks (kind, text, mime, blob, uri) to one text: images, blobs and bare resources as placeholders."""
    given = lambda c: F.nullif(c, F.lit(""))
    resource = lambda b: F.coalesce(given(b["text"]), F.when(given(b["blob"]).isNotNull(), F.concat(F.lit("[Binary data: "), F.coalesce(b["mime"], F.lit("unknown")), F.lit("]"))), F.concat(F.lit("[Resource: "), F.coalesce(b["uri"], F.lit("unknown")), F.lit("]")))
    one = lambda b: F.when(b["kind"] == "text", b["text"]).when(b["kind"] == "image", F.concat(F.lit("[Image: "), b["mime"], F.lit("]"))).when(b["kind"] == "resource", resource(b)).otherwise(b["text"])
    return F.array_join(F.filter(F.transform(blocks, one), lambda x: x.isNotNull()), "\n")


def notebook_text(cells: Column, hidden: tuple[str, ...] = ("hide", "hidden", "remove")) -> Column:
    """Cells (type, source, tags) as Markdown; tagged cells are dropped, and outputs are never read."""
    shown = F.filter(cells, lambda c: ~F.arrays_overlap(F.coalesce(c.tags, F.array().cast("array<string>")), F.array(*map(F.lit, hidden))))
    return F.array_join(F.transform(shown, lambda c: F.when(c.type == "code", F.concat(F.lit("```python\n"), c.source, F.lit("\n```"))).otherwise(c.source)), "\n\n")


#: Methods of an API description. Fixed values.
METHODS = ("get", "post", "put", "patch", "delete", "head", "options")


def endpoints(spec: DataFrame, column: str = "value") -> DataFrame:
    """path and method of each operation of an API description, with its texts and the names of its parameters."""
    tvf = spec.sparkSession.tvf
    paths = spec.select(F.try_variant_get(F.try_parse_json(column), "$.paths", "variant").alias("paths"))
    each = paths.lateralJoin(tvf.variant_explode(F.col("paths").outer())).select(F.col("key").alias("path"), F.col("value").alias("operations"))
    each = each.lateralJoin(tvf.variant_explode(F.col("operations").outer())).filter(F.col("key").isin(*METHODS))
    text = lambda n: F.try_variant_get("value", f"$.{n}", "string").alias(n)
    names = F.transform(F.try_variant_get("value", "$.parameters", "array<variant>"), lambda p: F.coalesce(F.try_variant_get(p, "$.name", "string"), F.lit("")))
    return each.select("path", F.col("key").alias("method"), *map(text, ("operationId", "summary", "description")), F.array_join(F.try_variant_get("value", "$.tags", "array<string>"), " ").alias("tags"), F.coalesce(F.array_join(names, " "), F.lit("")).alias("param_names"))


_ENV = re.compile(r"\$\{(\w+)(?::-([^}]*))?\}")


def config(path: str, environment: dict[str, str] | None = None) -> dict:
    """A JSON configuration with ${NAME} and ${NAME:-default} filled in; a small file of the driver, not data."""
    env = os.environ if environment is None else environment

    def filled(value):
        if isinstance(value, str):
            return _ENV.sub(lambda m: env.get(m[1]) or (m[2] if m[2] is not None else m[0]), value)
        if isinstance(value, dict):
            return {k: filled(v) for k, v in value.items()}
        return [filled(v) for v in value] if isinstance(value, list) else value

    with open(path) as f:
        return filled(json.load(f))


def paged_source(name: str, schema: str, fetch: Callable[[int, int], list[tuple]], size: int = 100, stripes: int = 4) -> type[DataSource]:
    """A batch data source over a paged API: fetch(page, size) gives the rows of a page. Partition i of `stripes` reads pages
    i, i + stripes, and so on, and ends at a short or empty page, so that no number of pages has to be known. The option
    `limit` bounds the rows."""

    class Reader(DataSourceReader):
        def __init__(self, limit: int | None):
            self.limit = limit

        def partitions(self):
            return [InputPartition(i) for i in range(stripes)]

        def read(self, partition) -> Iterator[tuple]:
            page = partition.value
            while self.limit is None or page * size < self.limit:
                rows = fetch(page, size)
                yield from rows if self.limit is None else rows[: self.limit - page * size]
                if len(rows) < size:
                    return
                page += stripes

    class Paged(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def reader(self, schema):
            limit = self.options.get("limit")
            return Reader(None if limit is None else int(limit))

    return Paged
