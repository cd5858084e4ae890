"""Registry log and the stream of parser replies: replays, failing batches, late claims, bounded reads."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from quire.operators import batching as B
from quire.sources.registry_log import RegistryLog
from quire.streaming import cycle_stream as C

NOW = 1_700_000_000
REGISTRY = ("id bigint, file_name string, file_uid string, file_ext string, file_size bigint, file_hash string, original_path string, "
            "parse_path string, parse_status tinyint, clean_status tinyint, created_at bigint, updated_at bigint")


def registry(spark, n, first=1):
    i = F.col("id")
    return spark.range(first, first + n).select(
        "id", F.concat(F.lit("f"), i, F.lit(".pdf")).alias("file_name"), F.concat(F.lit("u"), i).alias("file_uid"), F.lit("pdf").alias("file_ext"),
        i.alias("file_size"), F.concat(F.lit("h"), i).alias("file_hash"), F.concat(F.lit("/s/f"), i, F.lit(".pdf")).alias("original_path"),
        F.lit("").alias("parse_path"), F.lit(0).cast("tinyint").alias("parse_status"), F.lit(0).cast("tinyint").alias("clean_status"),
        F.lit(0).cast("bigint").alias("created_at"), F.lit(0).cast("bigint").alias("updated_at"))


def test_log_reads_stay_flat_and_replays_change_nothing(spark):
    read = {}
    for n in (8_000, 32_000):  # beyond the least number of buckets, below which buckets are smaller
        log = RegistryLog(spark, tempfile.mkdtemp(prefix="quire-log-"), rows_per_bucket=400)
        log.create(registry(spark, n))
        log.create(registry(spark, 1))  # there is one already
        state = log._state()
        asked = spark.createDataFrame([("/s/f7.pdf",), ("/s/f1900.pdf",), ("/none",)], "original_path string")
        read[n] = log._parts(state, "path", log._wanted(asked, state.buckets))[0].count()
        assert {r[0] for r in log.known("original_path", asked).collect()} == {"/s/f7.pdf", "/s/f1900.pdf"}
    assert read[32_000] < 2 * read[8_000] < 4_000
    changed = registry(spark, 2, 6).withColumn("parse_status", F.lit(2).cast("tinyint")).unionByName(registry(spark, 1, 50_000))
    log.commit(1, changed)
    before = log.rows().orderBy("id").collect()
    assert len(before) == 32_001 and log.max_id() == 50_000
    log.commit(1, registry(spark, 3, 70_000))  # a replay of the number
    log._write(registry(spark, 5, 80_000), 0, 2, state.buckets)  # a commit that ended before its manifest
    assert log.rows().orderBy("id").collect() == before
    assert log.rows(where=F.col("parse_status") == 2).count() == 2
    ids = spark.createDataFrame([(6,), (50_000,), (80_000,)], "id bigint")
    assert sorted((r.id, r.parse_status) for r in log.rows(ids).collect()) == [(6, 2), (50_000, 0)]
    assert log.known("file_hash", spark.createDataFrame([("h50000",), ("h80000",)], "file_hash string")).collect() == [("h50000",)]
    log.compact()
    assert log.rows().orderBy("id").collect() == before and log.committed(1)


def test_log_from_an_empty_registry(spark):
    log = RegistryLog(spark, tempfile.mkdtemp(prefix="quire-log-"))
    log.create(registry(spark, 0))
    asked = spark.createDataFrame([("/s/f1.pdf",)], "original_path string")
    assert log.rows().count() == 0 and log.known("original_path", asked).count() == 0 and log.max_id() == 0
    log.commit(0, registry(spark, 0))
    log.commit(1, registry(spark, 1))
    assert [r.id for r in log.rows().collect()] == [1] and log.known("original_path", asked).count() == 1


def cycle(spark, n=6):
    base = tempfile.mkdtemp(prefix="quire-cycle-")
    log = RegistryLog(spark, f"{base}/state")
    late = registry(spark, 2, 100).withColumn("parse_status", F.lit(2).cast("tinyint")).withColumn("clean_status", F.lit(1).cast("tinyint"))
    late = late.withColumn("parse_path", F.lit("/md/old.md")).withColumn("updated_at", F.lit(NOW - 3600) - (F.col("id") % 2))
    rows = registry(spark, n).unionByName(late)
    claimed = B.claims(rows.where("parse_status = 0").select("id", "file_name", "file_uid", "file_ext", "file_size", "file_hash", "original_path"), ["id"], 5)
    claimed = claimed.withColumn("route", F.lit("parser"))
    requests = rows.where(f"parse_status = 0 and id < {n}").select(
        F.col("id").alias("batch_no"), "id", "file_uid", "file_name", F.col("file_name").alias("local_name"), F.col("original_path").alias("absolute_path"), "file_ext", "file_hash")
    requests.write.parquet(f"{base}/requests")
    C.start_cycles(log, rows, claimed, spark.read.parquet(f"{base}/requests"), NOW)
    store = spark.createDataFrame([("/md/old.md", bytearray(b"old"))], "path string, content binary")
    replies = lambda df: df.select(F.col("id").alias("batch_no"), F.lit(200).alias("status_code"), F.when(F.col("id") == 2, '{"status": "failure"}').otherwise("{}").alias("body"))
    return base, C.Cycle(log, f"{base}/out", spark.read.parquet(f"{base}/requests"), store, replies, NOW)


def send(spark, base, numbers):
    rows = [(i, 200, json.dumps({"results": {f"f{i}.pdf": {"md": f"# Text {i}"}}})) for i in numbers]
    spark.createDataFrame(rows, C.REPLIES).coalesce(1).write.mode("append").parquet(f"{base}/source")


def states(cyc):
    return {r.id: (r.parse_status, r.clean_status) for r in cyc.log.rows().collect()}


def run(spark, base, cyc, **options):
    C.start_cycle_stream(spark, cyc, f"{base}/source", f"{base}/checkpoint", **options).awaitTermination()


def test_a_raising_batch_between_two_good_ones(spark):
    base, cyc = cycle(spark)
    assert states(cyc) == {**dict.fromkeys(range(1, 6), (1, 0)), 6: (-1, 0), 100: (2, 1), 101: (2, 1)}
    tries = []

    def steps(c, replies, batch_id):
        tries.append(batch_id)
        if batch_id == 1:
            raise RuntimeError("parser said no")
        return C.process(c, replies, batch_id)

    for numbers in ([1, 2], [3, 4], [5]):
        send(spark, base, numbers)
        run(spark, base, cyc, steps=steps)
    assert tries == [0, 1, 1, 2]
    # 2 was refused by the upload; 3 and 4 still run; 101 was late and is cleaned, 100 is just in time
    want = {1: (2, 2), 2: (2, -1), 3: (1, 0), 4: (1, 0), 5: (2, 2), 6: (-1, 0), 100: (2, 1), 101: (2, 2)}
    assert states(cyc) == want
    dead = C.dead_letters(cyc).collect()
    assert sorted(r.batch_no for r in dead) == [3, 4] and all("parser said no" in r.error for r in dead)
    assert {r.doc_key for r in C.read_sink(cyc, "markdown").collect()} == {"h1", "h2", "h5"}
    assert sorted(r.id for r in C.read_sink(cyc, "cleaned").collect()) == [1, 2, 5, 101]
    before = cyc.log.rows().orderBy("id").collect()
    C.batch_writer(cyc)(spark.createDataFrame([(1, 200, "{}")], C.REPLIES), 0)  # a replay of the first batch
    assert cyc.log.rows().orderBy("id").collect() == before
    C.requeue(cyc, f"{base}/source")
    run(spark, base, cyc)
    assert states(cyc) == {**want, 3: (2, 2), 4: (2, 2)}


def test_sinks_without_a_commit_are_not_seen(spark):
    base, cyc = cycle(spark)
    replies = spark.createDataFrame([(1, 200, json.dumps({"results": {"f1.pdf": "text"}}))], C.REPLIES)
    changed = C.process(cyc, replies, 0)
    assert spark.read.parquet(f"{base}/out/markdown").count() == 1 and C.read_sink(cyc, "markdown").count() == 0
    assert states(cyc)[1] == (1, 0)
    cyc.log.commit(1, changed)
    assert C.read_sink(cyc, "markdown").count() == 1 and states(cyc)[1] == (2, 2)


def test_polling_goes_on_after_a_failing_batch(spark):
    base, cyc = cycle(spark)
    send(spark, base, [1])

    def steps(c, replies, batch_id):
        if batch_id == 0:
            raise ValueError("first")
        return C.process(c, replies, batch_id)

    query = C.start_cycle_stream(spark, cyc, f"{base}/source", f"{base}/checkpoint", {"processingTime": "1 second"}, steps=steps)
    try:
        query.processAllAvailable()
        send(spark, base, [5])
        query.processAllAvailable()
        assert query.exception() is None and query.isActive
    finally:
        query.stop()
    assert states(cyc)[1] == (1, 0) and states(cyc)[5] == (2, 2)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        C.dead_letters(cycle(spark)[1]).count()
