"""Offset pages without sorting the table per page (TOP4).

``write_pages`` range-partitions rows by their order once and stores every range in a folder of its own, with a
directory of (range, rows before it, rows). Page k then reads the one or few ranges that its rows lie in and numbers the
rows of these only. The directory has one row per range and is all that the driver sees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_pages(rows: DataFrame, order: list[str], path: str, ranges: int) -> None:
    """Store ``rows`` for paging in ``order`` (unique) under ``path``."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{path}/input")  # range bounds are sampled: sample and split the same rows
    placed = spark.read.schema(rows.schema).parquet(f"{path}/input").repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id())
    placed.write.mode("overwrite").partitionBy("range").parquet(f"{path}/rows")
    schema = T.StructType([*rows.schema, T.StructField("range", T.IntegerType())])
    counts = spark.read.schema(schema).parquet(f"{path}/rows").groupBy("range").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    counts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).write.mode("overwrite").parquet(f"{path}/directory")


def read_page(spark: SparkSession, path: str, order: list[str], page: int, size: int) -> DataFrame:
    """Page ``page`` (from 0) of ``size`` rows, with the row's ``position`` (from 0)."""
    first, stop = page * size, (page + 1) * size
    directory = spark.read.parquet(f"{path}/directory")
    ranges = [r[0] for r in directory.where((F.col("before") < stop) & (F.col("before") + F.col("rows") > first)).select("range").collect()]
    schema = T.StructType([*spark.read.parquet(f"{path}/input").schema, T.StructField("range", T.IntegerType())])
    rows = spark.read.schema(schema).parquet(f"{path}/rows").where(F.col("range").isin(ranges))
    numbered = rows.withColumn("_n", F.row_number().over(Window.partitionBy("range").orderBy(*order)))
    placed = numbered.join(F.broadcast(directory.select("range", "before")), "range").withColumn("position", F.col("before") + F.col("_n") - 1)
    return placed.where((F.col("position") >= first) & (F.col("position") < stop)).drop("_n", "before", "range")
