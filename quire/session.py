"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on: AQE re-plans joins and coalesces/splits partitions at runtime,
# skewed joins are split, UTC keeps epoch-second columns stable, and the UI stays off (no server).
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "quire", extra: dict | None = None) -> SparkSession:
    """Return a session with the engine defaults; existing cluster settings win over nothing else."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is only read; without it nothing may be written, as a local
    folder of one machine is not the others'. With a local master (tests) a fresh folder under the system temp
    directory is used, once per application.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app not in _BASES:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        if not configured:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="quire-ckpt-")
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        _BASES[app] = configured
    return _BASES[app]


_BASES: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written intermediate table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{os.getpid()}-{next(_COUNTER)}"


def _counter():
    n = 0
    while True:
        n += 1
        yield n


_COUNTER = _counter()
