"""Registry state: views by state (SRC3, FLT5, FLT6) and transitions.

The reference keeps all progress in two status columns updated row by row. Here every transition is a pure function
``registry [x events] -> registry``: predicates on the registry itself are plain ``when`` columns (no shuffle);
transitions driven by another table join on the unique ``id`` (or on the path for the source check). Each
transition also leaves a boolean flag column, so the number of rows it changed is one aggregate away
(``transition_counts``).

Status codes: -1 failed, 0 pending, 1 running, 2 done.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import py_strip

FAILED, PENDING, RUNNING, DONE = -1, 0, 1, 2
STALE_SECONDS = 3600  # default age after which a running clean row is taken back


# ------------------------------------------------------------------------------------------------ views


def is_cleanable() -> Column:
    """FLT5: ``clean_status = 0 AND parse_status = 2 AND parse_path <> ''`` (NULL and '' drop; a blank passes)."""
    return (F.col("clean_status") == PENDING) & (F.col("parse_status") == DONE) & (F.col("parse_path") != "")


def is_parsed() -> Column:
    """FLT6: ``parse_status = 2 AND parse_path <> ''``."""
    return (F.col("parse_status") == DONE) & (F.col("parse_path") != "")


def pending_parse(registry: DataFrame) -> DataFrame:
    """SRC3: rows waiting for parsing."""
    return registry.filter(F.col("parse_status") == PENDING).select(
        "id", "file_name", "file_uid", "file_ext", "file_size", "file_hash", "original_path"
    )


def failed_parse(registry: DataFrame) -> DataFrame:
    return registry.filter(F.col("parse_status") == FAILED).select("id", "original_path")


def pending_clean(registry: DataFrame) -> DataFrame:
    return registry.filter(is_cleanable()).select(
        "id", "file_name", "file_uid", "file_ext", "file_size", "file_hash", "original_path", "parse_path"
    )


def parsed(registry: DataFrame) -> DataFrame:
    return registry.filter(is_parsed()).select(
        "id", "file_name", "file_uid", "file_ext", "file_hash", "original_path", "parse_path"
    )


# ------------------------------------------------------------------------------------------------ transitions


def _set(df: DataFrame, cond: Column, column: str, value, now: int, flag: str) -> DataFrame:
    hit = F.coalesce(cond, F.lit(False))
    return (
        df.withColumn(flag, hit)
        .withColumn(column, F.when(F.col(flag), F.lit(value).cast("tinyint")).otherwise(F.col(column)))
        .withColumn("updated_at", F.when(F.col(flag), F.lit(now).cast("bigint")).otherwise(F.col("updated_at")))
    )


def recover_stale_clean(registry: DataFrame, now: int, stale_seconds: int | None = STALE_SECONDS,
                        flag: str = "recovered_processing") -> DataFrame:
    """Running clean rows back to pending; with ``stale_seconds`` only those not updated for that long
    (strict ``<``)."""
    cond = F.col("clean_status") == RUNNING
    if stale_seconds is not None:
        cond = cond & (F.col("updated_at") < now - stale_seconds)
    return _set(registry, cond, "clean_status", PENDING, now, flag)


def recover_failed(registry: DataFrame, column: str, now: int, flag: str = "recovered_failed") -> DataFrame:
    """Failed rows back to pending (``column`` is ``parse_status`` or ``clean_status``)."""
    return _set(registry, F.col(column) == FAILED, column, PENDING, now, flag)


def recover_running_parse(registry: DataFrame, now: int, flag: str = "recovered_processing") -> DataFrame:
    """Every running parse row back to pending (no age test)."""
    return _set(registry, F.col("parse_status") == RUNNING, "parse_status", PENDING, now, flag)


def recover_clean(registry: DataFrame, now: int, stale_seconds: int | None = STALE_SECONDS) -> DataFrame:
    """T6 then T7 on the clean state; the two flags are disjoint because T7 sees T6's result."""
    return recover_failed(recover_stale_clean(registry, now, stale_seconds), "clean_status", now)


def source_exists(registry: DataFrame, listing: DataFrame) -> DataFrame:
    """Flag ``source_exists``: ``original_path`` is non-blank and is a listed file (path taken as stored)."""
    files = listing.select(F.col("path").alias("original_path")).distinct().withColumn("_listed", F.lit(True))
    blank = py_strip(F.coalesce(F.col("original_path"), F.lit(""))) == ""
    return (
        registry.join(files, "original_path", "left")
        .withColumn("source_exists", ~blank & F.coalesce(F.col("_listed"), F.lit(False)))
        .drop("_listed")
    )


def recover_parse(registry: DataFrame, listing: DataFrame, now: int) -> DataFrame:
    """Running -> pending; failed with an existing source -> pending; other failed rows stay failed but are
    touched (``updated_at = now``). Flags: ``recovered_processing``, ``recovered_failed``, ``kept_failed``."""
    df = recover_running_parse(registry, now)
    df = source_exists(df, listing)
    failed = F.col("parse_status") == FAILED
    df = df.withColumn("recovered_failed", failed & F.col("source_exists"))
    df = df.withColumn("kept_failed", failed & ~F.col("source_exists"))
    touched = F.col("recovered_failed") | F.col("kept_failed")
    return (
        df.withColumn("parse_status", F.when(F.col("recovered_failed"), F.lit(PENDING).cast("tinyint"))
                      .otherwise(F.col("parse_status")))
        .withColumn("updated_at", F.when(touched, F.lit(now).cast("bigint")).otherwise(F.col("updated_at")))
        .drop("source_exists")
    )


def apply_status(registry: DataFrame, ids: DataFrame, column: str, value: int, now: int,
                 flag: str = "updated") -> DataFrame:
    """T5: set ``column = value`` for the given ids (an empty id table changes nothing)."""
    marks = ids.select("id").distinct().withColumn("_hit", F.lit(True))
    df = registry.join(marks, "id", "left")
    return _set(df, F.col("_hit"), column, value, now, flag).drop("_hit")


def apply_parse_results(registry: DataFrame, results: DataFrame, now: int) -> DataFrame:
    """``results(id, ok, parse_path)``: success -> parse 2 with the path; failure -> parse -1."""
    r = results.select("id", F.col("ok").alias("_ok"), F.col("parse_path").alias("_path"))
    df = registry.join(r, "id", "left")
    hit = F.col("_ok").isNotNull()
    return (
        df.withColumn("parse_status", F.when(F.col("_ok"), F.lit(DONE)).when(hit, F.lit(FAILED))
                      .otherwise(F.col("parse_status")).cast("tinyint"))
        .withColumn("parse_path", F.when(F.col("_ok"), F.col("_path")).otherwise(F.col("parse_path")))
        .withColumn("updated_at", F.when(hit, F.lit(now).cast("bigint")).otherwise(F.col("updated_at")))
        .withColumn("parse_updated", hit)
        .drop("_ok", "_path")
    )


def apply_clean_results(registry: DataFrame, results: DataFrame, now: int) -> DataFrame:
    """``results(id, ok)``: success -> clean 2, failure -> clean -1."""
    r = results.select("id", F.col("ok").alias("_ok"))
    df = registry.join(r, "id", "left")
    hit = F.col("_ok").isNotNull()
    return (
        df.withColumn("clean_status", F.when(F.col("_ok"), F.lit(DONE)).when(hit, F.lit(FAILED))
                      .otherwise(F.col("clean_status")).cast("tinyint"))
        .withColumn("updated_at", F.when(hit, F.lit(now).cast("bigint")).otherwise(F.col("updated_at")))
        .withColumn("clean_updated", hit)
        .drop("_ok")
    )


def apply_one_step_results(registry: DataFrame, results: DataFrame, now: int) -> DataFrame:
    """``results(id, outcome, parse_path)`` with outcome 'parse_failed' (parse -1), 'clean_failed' (both -1),
    'uploaded' (both 2, path set) or 'upload_failed' (both -1)."""
    r = results.select("id", F.col("outcome").alias("_o"), F.col("parse_path").alias("_path"))
    df = registry.join(r, "id", "left")
    o = F.col("_o")
    both_failed = o.isin("clean_failed", "upload_failed")
    return (
        df.withColumn("parse_status", F.when(o == "uploaded", F.lit(DONE))
                      .when((o == "parse_failed") | both_failed, F.lit(FAILED))
                      .otherwise(F.col("parse_status")).cast("tinyint"))
        .withColumn("clean_status", F.when(o == "uploaded", F.lit(DONE)).when(both_failed, F.lit(FAILED))
                    .otherwise(F.col("clean_status")).cast("tinyint"))
        .withColumn("parse_path", F.when(o == "uploaded", F.col("_path")).otherwise(F.col("parse_path")))
        .withColumn("updated_at", F.when(o.isNotNull(), F.lit(now).cast("bigint")).otherwise(F.col("updated_at")))
        .drop("_o", "_path")
    )


def transition_counts(df: DataFrame, flags: list[str]) -> DataFrame:
    """Rows changed per transition flag, one row."""
    return df.agg(*[F.count_if(F.col(f)).alias(f) for f in flags])


def status_summary(registry: DataFrame) -> DataFrame:
    """Rows per ``(parse_status, clean_status)``."""
    return registry.groupBy("parse_status", "clean_status").agg(F.count(F.lit(1)).alias("files"))
