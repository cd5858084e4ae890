"""Run counters (AGG2, AGG3, AGG4): one aggregate pass, per claim plus the total via ``rollup``; or, as totals of a run,
observed while its rows are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def parse_counters(rows: DataFrame) -> DataFrame:
    """AGG2 over claimed rows ``(claim_no, route, downloaded, ok)``: picked, downloaded, success, failed,
    unsupported, passthrough per claim, and the total (``claim_no`` NULL) with the number of claims as ``cycles``.
    Unsupported files also count as failed, passthrough files also as success; files not found at the source fail."""
    ok = F.coalesce(F.col("ok"), F.lit(False))
    parser = F.col("route") == "parser"
    counters = rows.rollup("claim_no").agg(
        F.countDistinct("claim_no").alias("cycles"),
        F.count(F.lit(1)).alias("picked"),
        F.count_if(parser & F.coalesce(F.col("downloaded"), F.lit(False))).alias("downloaded"),
        F.count_if(ok).alias("success"),
        F.count_if(~ok).alias("failed"),
        F.count_if(F.col("route") == "unsupported").alias("unsupported"),
        F.count_if((F.col("route") == "passthrough") & ok).alias("passthrough"),
    )
    return counters


def clean_counters(rows: DataFrame) -> DataFrame:
    """AGG3 over cleaned rows ``(claim_no, ok)``: picked, success, failed, uploaded per claim and in total."""
    ok = F.coalesce(F.col("ok"), F.lit(False))
    return rows.rollup("claim_no").agg(
        F.count(F.lit(1)).alias("picked"), F.count_if(ok).alias("success"), F.count_if(~ok).alias("failed"),
        F.count_if(ok).alias("uploaded"),
    )


def upload_counters(rows: DataFrame) -> DataFrame:
    """AGG4 over raw-upload verdicts ``(verdict)``: picked, success, failed, uploaded, skipped."""
    v = F.col("verdict")
    return rows.agg(
        F.count(F.lit(1)).alias("picked"), F.count_if(v == "uploaded").alias("success"),
        F.count_if(v == "failed").alias("failed"), F.count_if(v == "uploaded").alias("uploaded"),
        F.count_if(v == "skipped").alias("skipped"),
    )


def parse_totals() -> list[Column]:
    """AGG2 over all rows ``(claim_no, route, downloaded, ok)``, without the number of claims."""
    ok, parser = F.coalesce(F.col("ok"), F.lit(False)), F.col("route") == "parser"
    return [
        F.count(F.lit(1)).alias("picked"), F.count_if(parser & F.coalesce(F.col("downloaded"), F.lit(False))).alias("downloaded"),
        F.count_if(ok).alias("success"), F.count_if(~ok).alias("failed"), F.count_if(F.col("route") == "unsupported").alias("unsupported"),
        F.count_if((F.col("route") == "passthrough") & ok).alias("passthrough"),
    ]


def clean_totals() -> list[Column]:
    """AGG3 over the registry rows of a clean run ``(recovered_processing, recovered_failed, claimed, ok)``."""
    ok, picked = F.coalesce(F.col("ok"), F.lit(False)), F.col("claimed")
    return [
        F.count_if("recovered_processing").alias("recovered_processing"), F.count_if("recovered_failed").alias("recovered_failed"),
        F.count_if(picked).alias("picked"), F.count_if(picked & ok).alias("success"), F.count_if(picked & ~ok).alias("failed"),
        F.count_if(picked & ok).alias("uploaded"),
    ]


def upload_totals() -> list[Column]:
    """AGG4 over raw-upload verdicts."""
    v = F.col("verdict")
    return [F.count(F.lit(1)).alias("picked"), F.count_if(v == "uploaded").alias("success"), F.count_if(v == "failed").alias("failed"),
            F.count_if(v == "uploaded").alias("uploaded"), F.count_if(v == "skipped").alias("skipped")]


def written_with_totals(rows: DataFrame, path: str, totals: list[Column]) -> dict[str, int]:
    """Write ``rows`` and return the totals that were observed in the same pass; no second scan."""
    seen = Observation()
    rows.observe(seen, *totals).write.mode("overwrite").parquet(path)
    return seen.get
