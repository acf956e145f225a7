"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share. Where that is unset, a temporary one if driver and executors are one
    process (local master); on a cluster it must be set, as each executor would write to its own disk."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='inkwell-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts the lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def counted(df: DataFrame, name: str, *more: Column) -> tuple[DataFrame, dict]:
    """staged(df), and its row count "n" with other aggregates, taken while it is written."""
    seen = Observation()
    out = staged(df.observe(seen, F.count(F.lit(1)).alias("n"), *more), name)
    return out, dict(seen.get)


def unstaged(df: DataFrame) -> None:
    """Delete a table of staged() that no later plan reads."""
    path = getattr(df, "_staged_path", None)
    if path:
        jvm, jsc = df.sparkSession._jvm, df.sparkSession._jsc
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(jsc.hadoopConfiguration()).delete(where, True)


def give_back() -> None:
    """Return to the system what this process holds of memory that it has freed: some 100 MB after a task on 1 MB slices, where the C library has that call."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def frugal(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """f for mapInArrow, whose worker stays with the executor after the task, while the JVM needs the memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        give_back()

    return run


def chunks(batches: Iterator[pa.RecordBatch], text: str, most: int, rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `most` bytes of text and `rows` rows at most; one longer text makes a slice of its own."""
    for batch in batches:
        n = batch.num_rows
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < n:
            base = ends[at - 1] if at else 0
            to = max(at + 1, min(at + rows, int(np.searchsorted(ends, base + most, side="right"))))
            yield batch.slice(at, to - at)
            at = to


def raw(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes; null is empty."""
    return [x or b"" for x in batch.column(name).cast(pa.large_binary()).to_pylist()]


def joined(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column one after the other, and where each row starts (one more entry at the end); null is empty."""
    col = batch.column(name).cast(pa.large_binary())
    if col.null_count:
        col = pc.fill_null(col, b"")
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1]
    byte = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None and len(col) else np.zeros(0, np.uint8)
    return byte, offs - offs[0]


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that are done (it does so when the driver's JVM collects its garbage)."""
    spark.sparkContext._jvm.System.gc()


def free_heaps(spark: SparkSession) -> None:
    """Let the executors' JVMs collect their garbage: heap, compiled plans and buffers of stages that are done, which they else keep up to the heap's limit. As many short
    tasks as there are cores; an executor that gets none of them stays as it is."""
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("java_method('java.lang.System', 'gc')")).collect()
