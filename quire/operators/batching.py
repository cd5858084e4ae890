"""Claims, routing and parser request batches (W2, W3, TOP1, TOP2, TOP4, TOP5, SET1, SET2, SET4, PRJ2, AGG5, FLT9).

The reference claims a few rows at a time, in order, until nothing is pending; here all claims of a run are numbered
at once: ``claim_no = (dense rank in claim order - 1) div claim_size`` from the two-phase numbering (no single-task
window). Request batches are then formed inside each claim by windows partitioned by ``claim_no``: a claim holds
at most ``claim_size`` rows, so those windows are small and many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.paths import path_name, safe_local_name
from quire.functions.text import py_strip
from quire.operators.numbering import dense_number
from quire.operators.state import RUNNING, is_cleanable

# Fixed values that must equal the reference's.
PARSER_TYPES = ("pdf", "docx", "xlsx", "pptx")
PASSTHROUGH_TYPES = ("txt",)
LARGE_FILE_BYTES = 100 * 1024 * 1024
PARSE_CLAIM_SIZE = 5
CLEAN_CLAIM_SIZE = 5
REQUEST_BATCH_SIZE = 2


def normalized_ext(c: Column) -> Column:
    """``str(ext or '').lower().lstrip('.')``."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"^\.+", "")


def route(ext: Column, mode: str = "standalone", passthrough_types=PASSTHROUGH_TYPES) -> Column:
    """SET1 (standalone: parser / passthrough / unsupported) and SET2 (``mode='one_step'``: parser / unsupported)."""
    e = normalized_ext(ext)
    if mode == "one_step":
        return F.when(e.isin(*PARSER_TYPES), F.lit("parser")).otherwise(F.lit("unsupported"))
    return (
        F.when(e.isin(*PARSER_TYPES), F.lit("parser"))
        .when(e.isin(*passthrough_types), F.lit("passthrough"))
        .otherwise(F.lit("unsupported"))
    )


def by_extension(files: DataFrame) -> DataFrame:
    """AGG5: files per normalised extension (counts and id range; no per-group lists)."""
    return files.groupBy(normalized_ext(F.col("file_ext")).alias("ext")).agg(
        F.count(F.lit(1)).alias("files"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


def claims(rows: DataFrame, order: list[str], claim_size: int) -> DataFrame:
    """Consecutive claims of ``claim_size`` rows in ``order``: adds ``claim_no`` and ``claim_pos`` (from 0)."""
    numbered = dense_number(rows, order, name="_seq", start=0)
    return (
        numbered.withColumn("claim_no", F.floor(F.col("_seq") / claim_size).cast("bigint"))
        .withColumn("claim_pos", (F.col("_seq") % claim_size).cast("int"))
        .drop("_seq")
    )


def parse_claims(registry: DataFrame, claim_size: int = PARSE_CLAIM_SIZE) -> DataFrame:
    """T1 + W2: every pending parse row gets its claim, in id order (TOP1 is claim 0)."""
    pending = registry.filter(F.col("parse_status") == 0).select(
        "id", "file_name", "file_uid", "file_ext", "file_size", "file_hash", "original_path"
    )
    return claims(pending, ["id"], claim_size)


def clean_claims(registry: DataFrame, claim_size: int = CLEAN_CLAIM_SIZE) -> DataFrame:
    """T2 + W2: every cleanable row gets its claim, smallest file first (ties by id; TOP2 is claim 0)."""
    pending = registry.filter(is_cleanable()).select(
        "id", "file_name", "file_uid", "file_ext", "file_size", "file_hash", "original_path", "parse_path"
    )
    return claims(pending, ["file_size", "id"], claim_size)


def mark_claimed(registry: DataFrame, claimed: DataFrame, column: str, now: int) -> DataFrame:
    """T1/T2 state change: claimed rows become running."""
    from quire.operators.state import apply_status

    return apply_status(registry, claimed, column, RUNNING, now, flag="claimed")


def first_claim(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """TOP1/TOP2: the first ``n`` rows in claim order (a top-k: ``TakeOrderedAndProject``)."""
    return rows.orderBy(*order).limit(n)


def is_large(size: Column, limit: int = LARGE_FILE_BYTES) -> Column:
    """FLT9: strictly over the limit; a size that does not parse counts as not large."""
    return F.coalesce(size.try_cast("bigint"), F.lit(0)) > limit


def request_rows(files: DataFrame, local_root: str | None = "/tmp/parse") -> DataFrame:
    """PRJ2: request fields of each file: uploaded under its own name (else the local name), the local copy named
    safely under ``<root>/<id>/``. The one-step flow (``local_root=None``) keeps no copies: the file's path and name in
    the request are those of its original path."""
    if local_root is None:
        path = F.coalesce(F.col("original_path"), F.lit(""))
        base = path_name(path)
        name = F.coalesce(F.nullif(F.col("file_name"), F.lit("")), base)
        return files.select("*", base.alias("local_name"), name.alias("request_name"), name.alias("upload_name"), path.alias("absolute_path"))
    local = safe_local_name(F.coalesce(F.col("file_name"), F.lit("")), F.col("id"))
    name = F.coalesce(F.nullif(F.col("file_name"), F.lit("")), local)
    return files.select(
        "*",
        local.alias("local_name"),
        name.alias("request_name"),
        name.alias("upload_name"),
        F.concat(F.lit(local_root.rstrip("/") + "/"), F.col("id").cast("string"), F.lit("/"), local).alias(
            "absolute_path"
        ),
    )


def request_batches(files: DataFrame, batch_size: int = REQUEST_BATCH_SIZE,
                    large_limit: int = LARGE_FILE_BYTES) -> DataFrame:
    """Inside each claim, up to ``batch_size`` small files per request, each large file alone; a large file
    closes the open batch; claim order is kept.

    Input ``files(claim_no, claim_pos, file_size, ...)`` holds only files found at the source. Adds ``large``,
    ``batch_in_claim`` (from 1) and ``batch_pos`` (from 0).
    """
    by_claim = Window.partitionBy("claim_no").orderBy("claim_pos")
    df = files.withColumn("large", is_large(F.col("file_size"), large_limit))
    df = df.withColumn("seg", F.sum(F.col("large").cast("int")).over(
        by_claim.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    small_rank = Window.partitionBy("claim_no", "seg", "large").orderBy("claim_pos")
    df = df.withColumn("_rn", F.row_number().over(small_rank) - 1)
    df = df.withColumn(
        "sub", F.when(F.col("large"), F.lit(0)).otherwise(1 + F.floor(F.col("_rn") / batch_size)).cast("bigint")
    )
    df = df.withColumn("batch_in_claim", F.dense_rank().over(Window.partitionBy("claim_no").orderBy("seg", "sub")))
    df = df.withColumn("batch_pos", F.when(F.col("large"), F.lit(0)).otherwise(F.col("_rn") % batch_size))
    return df.drop("seg", "sub", "_rn")


def passthrough_results(files: DataFrame) -> DataFrame:
    """SET4: passthrough files are parsed as themselves: ``parse_path = original_path``; a blank path fails."""
    path = py_strip(F.coalesce(F.col("original_path"), F.lit("")))
    return files.select("id", (path != "").alias("ok"), F.when(path != "", path).alias("parse_path"))


def restore_order(results: DataFrame) -> DataFrame:
    """TOP5: results back in request order (claim, batch, position): their ``position`` from 0."""
    return dense_number(results, ["claim_no", "batch_in_claim", "batch_pos"], name="position", start=0)
