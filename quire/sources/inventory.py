"""File inventory as a Python Data Source (SRC2).

``spark.read.format("file_inventory").load(root)`` gives ``(path, uri, modificationTime, length)`` of every file under
a folder, files of no bytes included. Partitions are folders and are listed in tasks: the driver only looks for the
folders of the upper levels, until it has ``folders`` of them (256 unless set) or no level is left; each of the lowest
is walked by a task of its own, and the files that lie beside upper folders are listed by a task per such folder. A task
yields Arrow batches of ``BATCH`` rows, so neither side holds a list of all files.

``path`` is the location as the catalogue names it: without scheme, host and the ``mount`` option's prefix. A folder
that goes away while it is read has no files; a root that is not there gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

NAME = "file_inventory"
BATCH = 8192
FOLDERS = 256
SCHEMA = "path string, uri string, modificationTime timestamp, length bigint"


def open_storage(uri: str) -> tuple[pafs.FileSystem, str, str]:
    """(file system, path in it, prefix that makes a URI of such a path)."""
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", uri):
        return pafs.LocalFileSystem(), uri, "file:"
    uri = re.sub("^file:/+", "file:///", uri)
    fs, path = pafs.FileSystem.from_uri(quote(uri, safe="/:@?=&+,;"))
    scheme, host = re.match(r"([A-Za-z][A-Za-z0-9+.-]*:)(//[^/]*)?", uri).groups()
    return fs, path, "file:" if scheme == "file:" else scheme + (host or "") if path.startswith("/") else scheme + "//"


@dataclass
class Folder(InputPartition):
    """A folder to list, with everything below it or only its own files."""

    uri: str
    deep: bool

    def __post_init__(self) -> None:
        super().__init__(self.uri)


class FileInventory(DataSource):
    """Options: ``path`` (the root), ``mount`` (prefix that paths leave out), ``folders`` (partitions to aim at)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return InventoryReader(self.options.get("path", ""), self.options.get("mount", ""), int(self.options.get("folders", FOLDERS)))


class InventoryReader(DataSourceReader):
    def __init__(self, root: str, mount: str, folders: int) -> None:
        self.root, self.mount, self.folders = root, mount.rstrip("/"), folders

    def partitions(self) -> list[Folder]:
        upper: list[Folder] = []
        lowest = [self.root.rstrip("/") or "/"]
        while len(lowest) < self.folders:
            below = [sub for folder in lowest for sub in _subfolders(folder)]
            if not below:
                break
            upper += [Folder(folder, False) for folder in lowest]
            lowest = below
        return upper + [Folder(folder, True) for folder in lowest]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        fs, top, prefix = open_storage(partition.uri)
        rows: list[tuple] = []
        todo = [top]
        while todo:
            for entry in _entries(fs, todo.pop()):
                if entry.type == pafs.FileType.Directory:
                    if partition.deep:
                        todo.append(entry.path)
                elif entry.type == pafs.FileType.File:
                    path = entry.path if entry.path.startswith("/") else "/" + entry.path
                    named = path[len(self.mount):] if self.mount and path.startswith(self.mount + "/") else path
                    rows.append((named, prefix + entry.path, entry.mtime, entry.size))
                    if len(rows) >= BATCH:
                        yield _batch(rows)
                        rows = []
        if rows:
            yield _batch(rows)


def _entries(fs: pafs.FileSystem, folder: str) -> list[pafs.FileInfo]:
    try:
        return fs.get_file_info(pafs.FileSelector(folder, recursive=False, allow_not_found=True))
    except (FileNotFoundError, NotADirectoryError):
        return []


def _subfolders(uri: str) -> list[str]:
    fs, path, prefix = open_storage(uri)
    return sorted(prefix + e.path for e in _entries(fs, path) if e.type == pafs.FileType.Directory)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    paths, uris, times, sizes = zip(*rows)
    times = [t if t is None else t.astimezone(timezone.utc) if isinstance(t, datetime) else t for t in times]
    return pa.RecordBatch.from_arrays(
        [pa.array(paths), pa.array(uris), pa.array(times, pa.timestamp("us", tz="UTC")), pa.array(sizes, pa.int64())],
        names=["path", "uri", "modificationTime", "length"])


def list_files(spark: SparkSession, root: str, mount: str = "", folders: int = FOLDERS) -> DataFrame:
    """SRC2: the inventory of ``root``."""
    spark.dataSource.register(FileInventory)
    return spark.read.format(NAME).option("mount", mount).option("folders", folders).load(root)
