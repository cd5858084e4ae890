"""What the streams read: registry rows are computed once per write, the listing is not the contents."""

import pytest
from pyspark.sql import functions as F

from quire.plans.queries import QUERIES
from quire.session import scratch_path
from quire.sources.registry_log import RegistryLog


def test_rows_of_the_log_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def path(k):
        seen.add(1)
        return f"/p{k}"

    named = F.udf(path, "string")
    registry = spark.range(50).select("id", named("id").alias("original_path"), F.lit("h").alias("file_hash"))
    log = RegistryLog(spark, scratch_path(spark, "log-cost"))
    log.create(registry)
    assert seen.value == 50
    assert log.known("original_path", spark.createDataFrame([("/p7",), ("/x",)], "original_path string")).collect()[0][0] == "/p7"
    log.commit(0, registry.limit(0))
    assert log.rows().count() == 50 and log.known("file_hash", spark.createDataFrame([("h",)], "file_hash string")).count() == 1


def test_listing_of_the_register_stream_is_a_table_of_its_own(spark, monkeypatch):
    import quire.streaming.register_stream as stream

    given = []

    def start(*args, **kwargs):
        given.append(args[4])
        raise KeyboardInterrupt

    monkeypatch.setattr(stream, "start_register_stream", start)
    with pytest.raises(KeyboardInterrupt):
        QUERIES["stream_register"](spark, "/root/testdata/sf0.001")
    assert given[0].columns == ["path", "length"] and not any("documents" in f for f in given[0].inputFiles())
