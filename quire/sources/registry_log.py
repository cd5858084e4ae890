"""The registry as a compacted base and an append-only log of changes (SNK1, ST3).

::

    <base>/gen=<g>/rows/commit=<n>/bucket=<b>   rows that commit n wrote, by a hash of the id; commit -1 is the base
    <base>/gen=<g>/path|hash/commit=<n>/...     their paths and hashes, by a hash of the value
    <base>/manifests/gen=<g>/commit=<n>         one small file, written last: the commit counts from then on

A change writes its own rows only. A reader of some ids, paths or hashes opens their buckets only; the number of
buckets follows the number of rows when a generation is written, so what a batch reads does not grow with the registry.
A commit that fails leaves no manifest and is written again under the same number; one that has a manifest is skipped,
so a replay changes nothing. The driver holds the manifests since the last compaction and bucket numbers of a batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 20_000
LEAST_BUCKETS = 16
KEYS = {"original_path": "path", "file_hash": "hash"}
MANIFEST = "gen long, commit long, buckets int, max_id long, failed boolean, error string"
BASE = -1


@dataclass
class _State:
    gen: int
    buckets: int
    max_id: int
    commits: list[int]


class RegistryLog:
    """Reads and commits of one registry folder; ``buckets`` fixes the number of buckets (tests)."""

    def __init__(self, spark: SparkSession, base: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> None:
        self.spark, self.base, self.rows_per_bucket = spark, base.rstrip("/"), rows_per_bucket

    # -------------------------------------------------------------------------------------------- manifests

    def _exists(self, path: str) -> bool:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def manifests(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST).json(f"{self.base}/manifests/*/*")

    def exists(self) -> bool:
        return self._exists(f"{self.base}/manifests")

    def _state(self) -> _State:
        rows = self.manifests().collect()  # one per commit since the last compaction
        base = max((r for r in rows if r.commit == BASE), key=lambda r: r.gen)
        own = [r for r in rows if r.gen == base.gen]
        return _State(base.gen, base.buckets, max(r.max_id for r in own), sorted(r.commit for r in own if r.commit != BASE and not r.failed))

    def committed(self, commit: int) -> bool:
        return self.manifests().where(F.col("commit") == commit).limit(1).count() > 0

    def _sign(self, gen: int, commit: int, buckets: int, max_id: int, error: str | None = None) -> None:
        row = [(gen, commit, buckets, max_id, error is not None, error)]
        self.spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("overwrite").json(f"{self.base}/manifests/gen={gen}/commit={commit}")

    # -------------------------------------------------------------------------------------------- writing

    def create(self, registry: DataFrame) -> None:
        """Generation 0; nothing happens where the folder holds a registry."""
        if not self.exists():
            self._write_base(registry, 0)

    def compact(self) -> None:
        """Write the current rows as the next generation, with buckets for their number."""
        self._write_base(self.rows(), self._state().gen + 1)

    def _write_base(self, registry: DataFrame, gen: int) -> None:
        facts = registry.agg(F.count(F.lit(1)), F.max("id")).first()
        buckets = max(LEAST_BUCKETS, -(-facts[0] // self.rows_per_bucket))
        registry.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{self.base}/gen={gen}/columns")
        self._write(registry, gen, BASE, buckets)
        self._sign(gen, BASE, buckets, facts[1] or 0)

    def _write(self, rows: DataFrame, gen: int, commit: int, buckets: int) -> None:
        def put(df: DataFrame, key: str, table: str) -> None:
            bucketed = df.withColumn("bucket", _bucket(F.col(key), buckets))
            bucketed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._path(gen, table, commit))

        put(rows, "id", "rows")
        # paths and hashes come from the written rows: what gives the rows (hashes of contents, say) runs once
        stored = self.spark.read.schema(rows.schema).parquet(self._path(gen, "rows", commit))
        for column, table in KEYS.items():
            put(stored.select("id", F.col(column).alias("value")), "value", table)

    def _path(self, gen: int, table: str, commit: int) -> str:
        return f"{self.base}/gen={gen}/{table}/commit={commit}"

    def commit(self, commit: int, changed: DataFrame | None, error: str | None = None) -> None:
        """Append whole rows that are new or have changed; ``error`` records a batch that failed."""
        if self.committed(commit):
            return
        state, top = self._state(), None
        if changed is not None:
            self._write(changed, state.gen, commit, state.buckets)
            path = self._path(state.gen, "rows", commit)
            top = self.spark.read.parquet(path).agg(F.max("id")).first()[0] if self._has_rows(path) else None
        self._sign(state.gen, commit, state.buckets, max(state.max_id, top or 0), error)

    def _has_rows(self, path: str) -> bool:
        """Whether a commit wrote any row (an empty one has no bucket folder and no schema)."""
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/bucket=*")
        return bool(at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at))

    # -------------------------------------------------------------------------------------------- reading

    def max_id(self) -> int:
        return self._state().max_id

    def _wanted(self, values: DataFrame, buckets: int) -> list[int]:
        return [r[0] for r in values.select(_bucket(F.col(values.columns[0]), buckets)).distinct().collect()]

    def _parts(self, state: _State, table: str, wanted: list[int] | None) -> tuple[DataFrame, DataFrame | None]:
        """The base and the committed changes of a table, cut to the wanted buckets."""

        def read(commits: list[int]) -> DataFrame | None:
            paths = [p for p in (self._path(state.gen, table, n) for n in commits) if self._has_rows(p)]
            if not paths:
                return None
            found = self.spark.read.option("basePath", f"{self.base}/gen={state.gen}/{table}").parquet(*paths)
            return found if wanted is None else found.where(F.col("bucket").isin(wanted))

        base, log = read([BASE]), read(state.commits)
        return (self.spark.read.schema(self._schema(state.gen, table)).parquet(self._path(state.gen, table, BASE)) if base is None else base), log

    def _schema(self, gen: int, table: str) -> str:
        """Columns of a table whose base has no row."""
        rows = self.spark.read.parquet(f"{self.base}/gen={gen}/columns").schema
        kinds = {"rows": [(f.name, f.dataType.simpleString()) for f in rows]}
        kinds |= {t: [("id", "bigint"), ("value", rows[c].dataType.simpleString())] for c, t in KEYS.items()}
        return ", ".join(f"{n} {k}" for n, k in [*kinds[table], ("commit", "int"), ("bucket", "int")])

    def rows(self, ids: DataFrame | None = None, where: Column | None = None) -> DataFrame:
        """Current rows: all, those of a one-column table of ids, or those for which ``where`` holds (pushed to the scans)."""
        state = self._state()
        base, log = self._parts(state, "rows", None if ids is None else self._wanted(ids, state.buckets))
        columns = [c for c in base.columns if c not in ("bucket", "commit")]
        if log is not None:
            latest = log.groupBy("id").agg(F.max_by(F.struct(*columns), "commit").alias("r")).select("r.*")
            base = base.join(log.select("id").distinct(), "id", "left_anti")
        if where is not None:
            base = base.where(where)
            latest = latest.where(where) if log is not None else None
        found = base.select(*columns)
        if log is not None:
            found = found.unionByName(latest)
        return found if ids is None else found.join(ids.toDF("id").distinct(), "id", "left_semi")

    def known(self, column: str, values: DataFrame) -> DataFrame:
        """Of a one-column table of paths or hashes, the distinct ones that the registry holds."""
        state = self._state()
        base, log = self._parts(state, KEYS[column], self._wanted(values, state.buckets))
        held = base.select("value")
        if log is not None:
            held = held.unionByName(log.select("value"))
        return held.withColumnRenamed("value", column).join(values.distinct(), column, "left_semi").distinct()


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
