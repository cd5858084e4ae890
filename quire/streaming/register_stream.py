"""Incremental registration as a Structured Streaming query (ST1-ST4).

Catalogue files arriving in a folder are read with ``readStream``; every micro-batch runs the batch registration
job (``quire.operators.register``) inside ``foreachBatch``:

* the dedup state is the registry itself (ST3), kept as a compacted base and a log of changes
  (``quire.sources.registry_log``): a batch opens the buckets of its own paths and hashes and appends its own rows; no
  unbounded state store is kept;
* each batch writes its verdicts and new rows under ``batch_id=<n>`` with overwrite and then commits; a replayed batch
  (after a failure) rewrites the same folders, or finds its commit and changes nothing;
* ``trigger(availableNow=True)`` runs until idle (ST1); ``processingTime`` polls (ST2). Parsing, cleaning and late work
  are the other stream's (``quire.streaming.cycle_stream``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from quire.operators import register as R
from quire.sources.registry_log import RegistryLog

CATALOGUE_SCHEMA = StructType([
    StructField("id", LongType()), StructField("full_path", StringType()), StructField("status", IntegerType()),
])


def register_batch_writer(spark: SparkSession, out_dir: str, listing: DataFrame, base_registry: DataFrame,
                          hasher: R.Hasher, now: int):
    """The ``foreachBatch`` function: register one micro-batch of catalogue rows against the registry so far."""
    log = RegistryLog(spark, f"{out_dir}/state")
    log.create(base_registry)

    def run(batch: DataFrame, batch_id: int) -> None:
        if log.committed(batch_id):
            return
        verdicts_path, rows_path = f"{out_dir}/verdicts/batch_id={batch_id}", f"{out_dir}/registry/batch_id={batch_id}"
        R.register_verdicts(batch, listing, log, hasher).write.mode("overwrite").parquet(verdicts_path)
        verdicts = spark.read.parquet(verdicts_path)
        new_rows = R.new_registry_rows(verdicts, log, now).select(*base_registry.columns)
        new_rows.write.mode("overwrite").parquet(rows_path)
        log.commit(batch_id, spark.read.schema(new_rows.schema).parquet(rows_path))

    return run


def start_register_stream(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str, listing: DataFrame,
                          base_registry: DataFrame, hasher: R.Hasher, now: int, trigger: dict | None = None,
                          files_per_batch: int = 1):
    """Start the stream over catalogue parquet files in ``source_dir``; returns the ``StreamingQuery``."""
    stream = (
        spark.readStream.schema(CATALOGUE_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
        .parquet(source_dir)
    )
    writer = stream.writeStream.foreachBatch(
        register_batch_writer(spark, out_dir, listing, base_registry, hasher, now)
    ).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()


def read_verdicts(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(f"{out_dir}/verdicts").drop("batch_id")
