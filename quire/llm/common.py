"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import scratch_path

#: Words are maximal runs of anything but ASCII white space; ``bytes.split()`` cuts at the same characters.
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table. Only Spark opens the path, so it may lie in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back.

    This cuts lineage at a point that every executor can read again, fixes values that depend on where a row
    was computed (partition ids, row ids), and keeps a heavy step from running once per use.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_HELD: dict[str, object] = {}
_HELD_BY: list[int | None] = [None]


def forget_other_stages() -> None:
    """Drop what this Python worker holds for tasks of another stage. Workers live on from stage to stage, and what one
    operator cached would otherwise stay beside the next one's."""
    ctx = TaskContext.get()
    stage = None if ctx is None else ctx.stageId()
    if _HELD_BY[0] != stage:
        _HELD.clear()
        _HELD_BY[0] = stage


def held(name: str, make: Callable[[], object]):
    """A value that a worker makes once per stage: a loaded tokenizer, a cache of bounded size."""
    forget_other_stages()
    if name not in _HELD:
        _HELD[name] = make()
    return _HELD[name]


def release_memory() -> None:
    """Give memory that this worker has freed back to the system; else it stays beside the JVM's until the worker ends."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


@contextmanager
def small_batches(spark: SparkSession, max_bytes: int = 4 << 20) -> Iterator[None]:
    """Arrow batches of about so many bytes for what runs meanwhile: each stands in the JVM's direct memory and twice in a
    Python worker (the next is read while one is held). Results don't depend on it."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(max_bytes))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def byte_slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of each piece hold at most ``max_bytes`` together, one row at least."""
    import pyarrow.compute as pc

    forget_other_stages()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        at = total = 0
        for i, size in enumerate(sizes):
            if i > at and total + size > max_bytes:
                yield batch.slice(at, i - at)
                at, total = i, 0
            total += size
        if at < len(sizes):
            yield batch.slice(at)


def partition_id() -> int:
    """Number of the partition that the calling task computes; the same in every attempt."""
    ctx = TaskContext.get()
    return 0 if ctx is None else ctx.partitionId()


def train_side(doc_id: Column) -> Column:
    """True for rows whose labels may be learned: CRC-32 of the id as text, modulo 3, is not 1 (null ids: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def held_out(doc_id: Column) -> Column:
    """True for rows whose labels are kept for tests: that remainder is 1 (null ids: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


#: A text longer than this serves for no fit (it is scored like any other); the sample has at most ``rows`` times it.
SAMPLE_TEXT_BYTES = 1 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, rows: int, text_bytes: int = SAMPLE_TEXT_BYTES) -> DataFrame:
    """``(doc_id, text, y)`` of at most ``rows`` labelled training rows with texts of at most ``text_bytes`` bytes: the ids
    with the smallest hash, one row per id.

    Of conflicting labels the larger counts; of several texts of an id the one with the least hash (copies are combined
    where they are). Only the ids of the sample, ``rows`` at most, are broadcast, so the texts of other rows move nowhere.
    """
    ids = (
        labels.select("doc_id", F.col(target).cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & train_side(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    texts = docs.select("doc_id", "text").where(F.octet_length("text") <= text_bytes).join(F.broadcast(ids), "doc_id")
    return texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"), F.max("y").alias("y")).select(
        "doc_id", F.col("t.text").alias("text"), "y")
