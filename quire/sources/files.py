"""File sources: the catalogue table (SRC1), content hashes (S4), stored files, parser replies (SRC4).

Files are listed by ``quire.sources.inventory``. Bytes are read only for the files that still need a hash, by
``hash_files``: a ``mapInPandas`` over the (partitioned) path table that streams each file in 1 MiB chunks into SHA-256,
so memory per task stays flat whatever the file size. A file that cannot be read is told apart from one that is not
there by its ``error``.
"""

from __future__ import annotations

import hashlib
import os
import posixpath
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.paths import content_hash
from quire.sources.inventory import open_storage

CHUNK_BYTES = 1024 * 1024  # hash read size (fixed value of the reference)


def read_catalogue(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """SRC1: catalogue rows ``(id, full_path, status)``; the registration job filters ``status = 3``, which
    reaches the scan. For a JDBC catalogue pass ``fmt='jdbc'`` with ``partitionColumn='id'`` and bounds."""
    reader = spark.read.format(fmt)
    for key, value in options.items():
        reader = reader.option(key, value)
    df = reader.load(path) if fmt != "jdbc" else reader.load()
    return df.select(F.col("id").cast("bigint"), F.col("full_path").cast("string"), F.col("status").cast("int"))


def _sha256_stream(uri: str) -> tuple[str | None, str | None]:
    """``(hash, None)``, ``(None, None)`` for a file that is not there, or ``(None, error)``."""
    try:
        fs, path, _ = open_storage(uri)
        digest = hashlib.sha256()
        with fs.open_input_stream(path) as stream:
            while True:
                chunk = stream.read(CHUNK_BYTES)
                if not chunk:
                    break
                digest.update(chunk)
    except FileNotFoundError:
        return None, None
    except (OSError, ValueError) as error:  # pyarrow's ArrowInvalid, for a scheme it lacks, is a ValueError
        return None, str(error)
    return digest.hexdigest(), None


def _hash_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [_sha256_stream(u) for u in batch["uri"]]
        yield pd.DataFrame({"path": batch["path"], "file_hash": [h for h, _ in found], "error": [e for _, e in found]})


def hash_files(paths: DataFrame) -> DataFrame:
    """S4 for files on storage: ``(path, uri)`` -> ``(path, file_hash, error)``; a file that cannot be read has an
    ``error``, one that is gone neither."""
    return paths.select("path", "uri").mapInPandas(_hash_batches, "path string, file_hash string, error string")


def spark_hasher(spark: SparkSession, listing: DataFrame):
    """A registration ``hasher`` for storage that only Spark reads: hashes the wanted files of a listing in the scan.

    Spark reads what lies under the wanted files' common folder (its reader takes folders, not a table of files);
    ``listing_hasher`` reads wanted files only. A file that the scan does not give back is either one of no bytes,
    which the listing knows, or gone: its hash stays NULL.
    """

    def hasher(paths: DataFrame) -> DataFrame:
        wanted = listing.join(paths.select("path").distinct(), "path", "left_semi").select("path", "uri", "length")
        bounds = wanted.agg(F.min("uri"), F.max("uri")).first()
        if bounds[0] is None:
            return wanted.select("path", F.lit(None).cast("string").alias("file_hash"), F.lit(None).cast("string").alias("error"))
        root = os.path.commonpath([u.rsplit("/", 1)[0] for u in bounds])
        scan = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true").load(root)
        hashed = scan.select(_slashes(F.col("path")).alias("uri"), content_hash(F.col("content")).alias("file_hash"))
        none = F.when(F.col("length") == 0, F.sha2(F.lit("").cast("binary"), 256))
        return wanted.withColumn("uri", _slashes(F.col("uri"))).join(hashed, "uri", "left").select(
            "path", F.coalesce("file_hash", none).alias("file_hash"), F.lit(None).cast("string").alias("error"))

    return hasher


def _slashes(uri: Column) -> Column:
    """One spelling of a URI: the index writes file:///x, rows file:/x."""
    return F.regexp_replace(uri, "^file:/+", "file:/")


def listing_hasher(listing: DataFrame):
    """A registration ``hasher`` for a real listing: joins the requested paths to their URIs, then streams them."""

    def hasher(paths: DataFrame) -> DataFrame:
        wanted = listing.select("path", "uri").join(paths.select("path").distinct(), "path", "left_semi")
        return hash_files(wanted)

    return hasher


def store_files(files: DataFrame, root: str) -> DataFrame:
    """Write ``(path, content)`` rows as files under ``root``, in tasks; ``(path, uri)`` of each. Reruns overwrite."""

    def store(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, top, prefix = open_storage(root.rstrip("/"))
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                fs.create_dir(posixpath.dirname(f"{top}{path}"), recursive=True)
                with fs.open_output_stream(f"{top}{path}") as stream:
                    stream.write(content)
            yield pd.DataFrame({"path": batch["path"], "uri": prefix + top + batch["path"]})

    return files.select("path", "content").mapInPandas(store, "path string, uri string")


def remove_files(files: DataFrame) -> DataFrame:
    """Delete files by ``uri``, in tasks; a file that is gone already counts as deleted."""

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["uri"]:
                fs, path, _ = open_storage(uri)
                try:
                    fs.delete_file(path)
                except FileNotFoundError:
                    pass
            yield batch

    return files.select("uri").mapInPandas(remove, "uri string")


def read_replies(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SRC4: parser replies ``(batch_no, status_code, body)``; bodies are parsed later, once, as VARIANT."""
    return spark.read.format(fmt).load(path).select(
        F.col("batch_no").cast("bigint"), F.col("status_code").cast("int"), F.col("body").cast("string"))
