"""Parser replies as a stream: match, verdict, clean, upload, sinks and state in one micro-batch (ST1, ST2, ST4).

Claimed files have been sent to the parser (``start_cycles``: T1, routes, the outcomes that need no parser). Its replies
arrive as files; each micro-batch

1. takes back clean claims that were not finished in time (ST4: T6 on running rows whose claim is older than ``stale``),
2. matches its replies to the requests they answer, judges them (FLT8, T3) and stores Markdown and images,
3. cleans every cleanable row, those just parsed included, judges the upload replies and sets the clean states (T2, T4),
4. writes its sinks under ``batch_id`` and then commits the changed registry rows. The commit's manifest makes the rows
   and all sinks of the batch visible together: ``read_sink`` gives the batches that have one.

A batch that raises is tried again (``attempts``); then its replies go to the dead-letter table with the error, the
commit is marked as failed, and the stream goes on (ST2). Its files stay running; ``requeue`` puts the replies back into
the source. A replayed batch finds its manifest and does nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import batching as B
from quire.operators import documents as D
from quire.operators import replies as RP
from quire.operators import state as S
from quire.operators import upload as U
from quire.sources.registry_log import RegistryLog

REPLIES = "batch_no bigint, status_code int, body string"
SINKS = ("markdown", "images", "cleaned", "outcomes")


@dataclass
class Cycle:
    """What a micro-batch needs besides its replies."""

    log: RegistryLog
    out: str
    requests: DataFrame
    store: DataFrame
    upload_replies: Callable[[DataFrame], DataFrame]
    now: int
    stale: int = S.STALE_SECONDS
    output_dir: str = "/md"
    attempts: int = 2


def start_cycles(log: RegistryLog, registry: DataFrame, claimed: DataFrame, requests: DataFrame, now: int) -> None:
    """Create the log and commit the claims (T1): parser files run; passthrough files are done, files of no known type
    and files that were not found at their source fail (SET1, SET4, J6)."""
    log.create(registry)
    sent = requests.select("id").withColumn("sent", F.lit(True))
    rows = claimed.join(sent, "id", "left")
    settled = rows.where((F.col("route") != "parser") | F.col("sent").isNull())
    outcomes = B.passthrough_results(settled.where("route = 'passthrough'")).unionByName(
        settled.where("route <> 'passthrough'").select("id", F.lit(False).alias("ok"), F.lit(None).cast("string").alias("parse_path")))
    running = B.mark_claimed(registry.join(claimed.select("id"), "id", "left_semi"), claimed, "parse_status", now)
    log.commit(_commit(None), S.apply_parse_results(running, outcomes, now + 1).select(*registry.columns))


def _commit(batch_id: int | None) -> int:
    """Commit number of a micro-batch; the claims come first."""
    return 0 if batch_id is None else batch_id + 1


def process(cycle: Cycle, replies: DataFrame, batch_id: int) -> DataFrame:
    """Steps 1 to 4 up to the commit: writes the sinks of a batch and returns the changed registry rows."""
    spark = replies.sparkSession

    def sink(name: str, rows: DataFrame) -> DataFrame:
        path = f"{cycle.out}/{name}/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    asked = cycle.requests.join(replies.select("batch_no").distinct(), "batch_no", "left_semi")
    results = sink("results", RP.file_results(RP.matched_files(asked, replies)))
    verdicts = RP.parse_verdicts(results, asked, cycle.output_dir)
    current = cycle.log.rows(asked.select("id"))
    columns = current.columns
    parsed = sink("parsed", S.apply_parse_results(current, verdicts, cycle.now + 1).select(*columns))
    markdown = sink("markdown", RP.markdown_store_rows(results, asked))
    sink("images", RP.stored_images(asked, replies))

    open_rows = cycle.log.rows(where=(F.col("clean_status") == S.RUNNING) | S.is_cleanable())
    open_rows = open_rows.join(parsed.select("id"), "id", "left_anti").unionByName(parsed)
    recovered = S.recover_stale_clean(open_rows, cycle.now, cycle.stale)
    # one text per path: of files with one hash the one with the largest id, as in the Markdown store
    fresh = markdown.groupBy("doc_key").agg(F.max_by("markdown", "id").alias("markdown")).select(
        F.concat(F.lit(cycle.output_dir.rstrip("/") + "/"), "doc_key", F.lit(".md")).alias("path"),
        F.encode("markdown", "UTF-8").alias("content"))
    store = cycle.store.join(fresh.select("path"), "path", "left_anti").unionByName(fresh)
    claimed = recovered.where(S.is_cleanable()).select("id", "file_name", "original_path", "parse_path")
    outcomes = sink("outcomes", U.clean_outcomes(claimed, store, cycle.upload_replies(claimed)))
    texts = store.select(F.col("path").alias("parse_path"), U.read_markdown(F.col("content")).alias("markdown"))
    sink("cleaned", D.clean_documents(outcomes.where("has_markdown").join(texts, "parse_path")).select("id", "cleaned"))
    final = S.apply_clean_results(recovered, outcomes.select("id", "ok"), cycle.now + 1)
    asked_ids = parsed.select("id", F.lit(True).alias("asked"))
    changed = final.join(asked_ids, "id", "left").where("recovered_processing or clean_updated or asked")
    return sink("changed", changed.select(*columns))


def batch_writer(cycle: Cycle, steps: Callable[[Cycle, DataFrame, int], DataFrame] = process) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function; ``steps`` is what is tried."""

    def run(batch: DataFrame, batch_id: int) -> None:
        number = _commit(batch_id)
        if cycle.log.committed(number):
            return
        for attempt in range(1, cycle.attempts + 1):
            try:
                changed = steps(cycle, batch, batch_id)
                break
            except Exception as error:  # noqa: BLE001 - whatever a batch raises, the stream goes on
                if attempt < cycle.attempts:
                    continue
                reason = f"{type(error).__name__}: {error}"[:2000]
                batch.withColumn("error", F.lit(reason)).write.mode("overwrite").parquet(f"{cycle.out}/dead_letters/batch_id={batch_id}")
                cycle.log.commit(number, None, error=reason)
                return
        cycle.log.commit(number, changed)

    return run


def start_cycle_stream(spark: SparkSession, cycle: Cycle, source: str, checkpoint: str, trigger: dict | None = None,
                       files_per_batch: int = 1000, steps: Callable = process):
    """Start the stream over reply files in ``source``: ``availableNow`` unless a trigger is given."""
    stream = spark.readStream.schema(REPLIES).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    writer = stream.writeStream.foreachBatch(batch_writer(cycle, steps)).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_sink(cycle: Cycle, name: str) -> DataFrame:
    """A sink's rows of the batches that are committed and did not fail."""
    spark = cycle.log.spark
    done = cycle.log.manifests().where("not failed and commit > 0").select((F.col("commit") - 1).cast("int").alias("batch_id")).distinct()
    return spark.read.parquet(f"{cycle.out}/{name}").join(F.broadcast(done), "batch_id", "left_semi").drop("batch_id")


def dead_letters(cycle: Cycle) -> DataFrame:
    """Replies of failed batches ``(batch_no, status_code, body, error, batch_id)``."""
    return cycle.log.spark.read.parquet(f"{cycle.out}/dead_letters")


def requeue(cycle: Cycle, source: str) -> None:
    """Put the replies of failed batches back into the source as new files."""
    dead_letters(cycle).select("batch_no", "status_code", "body").write.mode("append").parquet(source)
