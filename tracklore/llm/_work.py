"""Tables in the shared folder that cut lineage, Arrow batches of bounded size, and what a Python worker keeps."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators of every operator here: the space and \t \n \v \f \r.
SPACES = b" \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where none is set and all run in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='tracklore-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Work:
    """Intermediate tables of one run. A table is written once, reread from the shared folder, and may be dropped
    as soon as what depends on it has been written; lost executors then cost nothing but the running stage."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def cut(self, df: DataFrame, table: str, codec: str = "zstd") -> DataFrame:
        path = f"{self.root}/{table}"
        df.write.option("compression", codec).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, table: str, release: bool = True) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        if release:
            self.release()

    def release(self) -> None:
        """Let Spark's cleaner see that shuffles of finished steps are unreachable."""
        gc.collect()
        self.spark._jvm.System.gc()


#: Arrow batches of every operator here: at most so many rows and about so many bytes. All set the same, since a lazy
#: DataFrame runs under what the session has by then.
LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def bounded_batches(spark: SparkSession) -> None:
    for key, value in LIMITS.items():
        spark.conf.set(key, value)


def bounded(df: DataFrame, run: Callable, schema) -> DataFrame:
    """df.mapInArrow in batches within LIMITS."""
    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


_held: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], object]):
    """What an operator keeps in a Python worker between tasks. Workers serve one operator after the other, so what
    another operator has left there goes first."""
    if key not in _held:
        trimmed()
        _held[key] = make()
    return _held[key]


def trimmed() -> None:
    """Frees what this worker keeps, and gives memory back to the system."""
    _held.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # other C libraries have no such call
        pass


def named(names: list[str]) -> list[Column]:
    """Columns by name, whatever characters it has."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in names]


def aside(names: list[str]) -> Column:
    """The caller's columns in one, out of the way of an operator's own names."""
    return (F.struct(*named(names)) if names else F.lit(True)).alias("_kept")


def restored(names: list[str]) -> list[Column]:
    return [F.col("_kept").getField(c).alias(c) for c in names]


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns, nulls counted; of kinds that can't be hashed, such as maps, of their JSON."""
    unhashed = lambda f: any(x in f.dataType.simpleString() for x in ("map<", "variant"))
    values = [F.to_json(F.struct(c)) if unhashed(f) else c for f, c in zip(df.schema, named(df.columns))]
    return F.xxhash64(*(x for v in values for x in (v, v.isNull())))


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def groups_of(texts: list[bytes], most: int = 4_000_000, rows: int = 50_000) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most so many rows, and bytes together; a longer text is a range of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and (size + len(text) > most or i - start >= rows):
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def text_bytes(docs: DataFrame, text: str | Column = "text") -> tuple[int, int]:
    """Rows, and bytes of all texts: what the number of fragments is derived from."""
    column = F.col(text) if isinstance(text, str) else text
    row = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()
    return row[0], row[1]
