"""What the training-data operators share: shared storage, expression helpers, word splitting."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, as a Java and RE2 class.
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Bytes of the texts that a Python worker turns into strings, hashes and sets at once, about; a longer text is a piece by itself.
PIECE_BYTES = 1_000_000
#: Bytes of an Arrow batch that goes to a Python worker, about.
BATCH_BYTES = 4_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one where the setting is unset and executors share this machine."""
    held = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not held:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        held = held.get() if held.isDefined() else None
    if not held:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        held = tempfile.mkdtemp(prefix="disclosa-shared-")
        spark.sparkContext.setCheckpointDir(held)
    return held.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: the lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/disclosa/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete what materialise() wrote for tables that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_written", None):
            where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


#: What a Python worker keeps between tasks: the tables of one operator at a time.
_kept: dict[object, object] = {}


def kept_by_worker(key: object, make: Callable[[], object]) -> object:
    """make(), made once a worker while the same operator runs; what another operator left is let go."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def pieces(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """All rows of batches in order, in pieces of about PIECE_BYTES of the texts in column."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(ends, PIECE_BYTES + (ends[at - 1] if at else 0), side="right"))
            yield batch.slice(at, max(1, upto - at))
            at += max(1, upto - at)


def small_batches(spark: SparkSession) -> None:
    """Have Spark send rows to Python workers in Arrow batches of about BATCH_BYTES; a row of more is a batch by itself.

    Spark's own limit is 64 MB, and an executor and its workers hold several batches of every running task. Plans read the
    setting when they run, so it stays with the session; a smaller one is kept. It changes no result.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name, None)
    if held is None or spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(held) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def give_back() -> None:
    """Return the memory that Arrow and the C library hold free: a worker outlives its tasks and else keeps the most it ever took."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def thrifty(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keep: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, which lets go of what another operator kept in the worker (not so with keep) and gives free memory back at its end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep:
            _kept.clear()
        yield from run(batches)
        give_back()

    return task


def free_shuffles(spark: SparkSession) -> None:
    """Have executors delete the shuffle files of ended jobs now: Spark does so only when the driver collects its garbage, whose own memory goes too."""
    gc.collect()  # Python's references to the driver's objects
    give_back()
    spark.sparkContext._jvm.System.gc()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a folder or file at path, in whatever file system it names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, bound as a lambda variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The maximal runs of characters outside SPACE_CLASS; a null text has none."""
    return F.array_remove(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D]", " "), " "), "")


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of a string's UTF-8."""
    return F.sha2(text.cast("binary"), 256)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
