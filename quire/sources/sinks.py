"""Sinks: registry snapshots (SNK1), the Markdown store (SNK2, SNK6), the image store (SNK3).

Datasets are immutable: a registry change writes a new snapshot folder, then a one-row pointer file of its own names
it. Pointers are never overwritten; the largest version that has one is current. So a write that fails at any point
leaves the last registry in place, and a rerun of the same version rewrites the same folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

IMAGE_BUCKETS = 256


def write_registry_snapshot(registry: DataFrame, base: str, version: int) -> str:
    """SNK1: write ``registry`` as snapshot ``version``, then its pointer under ``<base>/current``."""
    target = f"{base.rstrip('/')}/v={version}"
    registry.write.mode("overwrite").parquet(target)
    spark = registry.sparkSession
    spark.createDataFrame([(version,)], "version bigint").coalesce(1).write.mode("overwrite").json(
        f"{base.rstrip('/')}/current/v={version}")
    return target


def read_registry(spark: SparkSession, base: str) -> DataFrame:
    pointers = spark.read.schema("version bigint").json(f"{base.rstrip('/')}/current/*")
    version = pointers.agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{base.rstrip('/')}/v={version}")


def write_markdown_store(rows: DataFrame, path: str) -> None:
    """SNK2/SNK6: one row per ``doc_key`` (the file hash, else the id); of rows with one key the largest id stays,
    as the last file written does in a folder."""
    last = F.max_by("markdown", "id").alias("markdown")
    rows.groupBy("doc_key").agg(last).write.mode("overwrite").parquet(path)


def write_image_store(images: DataFrame, path: str) -> None:
    """SNK3: ``(file_id, image_name, bytes)`` partitioned by a bucket of ``file_id``."""
    images.select("file_id", "image_name", "bytes").withColumn(
        "bucket", F.pmod(F.col("file_id"), F.lit(IMAGE_BUCKETS))
    ).write.mode("overwrite").partitionBy("bucket").parquet(path)
