"""File listing and streaming hashes on a small folder; registry snapshot round trip."""

import hashlib
import os
import tempfile

from pyspark.sql import functions as F

from quire.operators.register import register_verdicts
from quire.sources.files import hash_files, listing_hasher, remove_files, spark_hasher, store_files
from quire.sources.inventory import InventoryReader, list_files
from quire.sources.sinks import read_registry, write_markdown_store, write_registry_snapshot


def test_listing_and_hash(spark):
    root = tempfile.mkdtemp(prefix="quire-files-")
    os.makedirs(f"{root}/volume1/share")
    data = {"a.pdf": b"hello", "b.txt": b"x" * (3 * 1024 * 1024 + 7), "empty.md": b""}
    for name, body in data.items():
        with open(f"{root}/volume1/share/{name}", "wb") as fh:
            fh.write(body)
    listing = list_files(spark, root, mount=root)
    got = {r.path: r.length for r in listing.collect()}
    assert got == {f"/volume1/share/{n}": len(b) for n, b in data.items()}
    want = {f"/volume1/share/{n}": hashlib.sha256(b).hexdigest() for n, b in data.items()}
    assert {r.path: r.file_hash for r in hash_files(listing).collect()} == want
    table = spark.createDataFrame(listing.collect(), listing.schema)  # as listed, before a file goes
    os.remove(f"{root}/volume1/share/a.pdf")
    asked = table.select("path").union(spark.createDataFrame([("/nowhere.pdf",)], "path string"))
    for hasher in (spark_hasher(spark, table), listing_hasher(table)):
        got = {r.path: r.file_hash for r in hasher(asked).collect()}
        assert got == {**want, "/volume1/share/a.pdf": None}


def test_folders_become_partitions(spark):
    root = tempfile.mkdtemp(prefix="quire-tree-")
    rows = [(f"/v{i % 3}/s{i % 5}/d{i % 2}/f {i}é#%.txt", bytes(str(i), "ascii") if i % 4 else b"") for i in range(60)] + [("/top.md", b"x"), ("/v1/mid.md", b"")]
    files = spark.createDataFrame(rows, "path string, content binary").repartition(4)
    uris = {r.path: r.uri for r in store_files(files, root).collect()}
    for folders in (1, 4, 10_000):
        listing = list_files(spark, root, root, folders)
        got = {r.path: (r.uri, r.length, r.modificationTime is not None) for r in listing.collect()}
        assert got == {p: (uris[p], len(c), True) for p, c in rows}
        assert listing.rdd.getNumPartitions() == len(InventoryReader(root, root, folders).partitions())
    parts = InventoryReader(root, "", 10_000).partitions()
    assert len(parts) == 1 + 3 + 15 + 30 and sum(p.deep for p in parts) == 30
    assert InventoryReader(root, "", 1).partitions()[0].deep
    assert {r.path: r.file_hash for r in hash_files(listing).collect()} == {p: hashlib.sha256(c).hexdigest() for p, c in rows}
    remove_files(listing.filter("path like '/v0/%'")).collect()
    assert {r.path for r in list_files(spark, root, root).collect()} == {p for p, _ in rows if not p.startswith("/v0/")}
    assert list_files(spark, f"{root}/gone").count() == 0


def test_unreadable_and_missing_files(spark):
    root = tempfile.mkdtemp(prefix="quire-files-")
    os.mkdir(f"{root}/folder.pdf")  # cannot be read as a file
    rows = [("/a.pdf", f"file:{root}/gone.pdf"), ("/b.pdf", f"file:{root}/folder.pdf"), ("/c.pdf", "nosuchscheme://x/y")]
    got = {r.path: r for r in hash_files(spark.createDataFrame(rows, "path string, uri string")).collect()}
    assert got["/a.pdf"].file_hash is None and got["/a.pdf"].error is None
    assert got["/b.pdf"].error and got["/c.pdf"].error
    nas = spark.createDataFrame([(i, p, 3) for i, p in enumerate(["/a.pdf", "/b.pdf", "/d.pdf"])], "id long, full_path string, status int")
    listing = spark.createDataFrame([("/a.pdf", 1), ("/b.pdf", 1)], "path string, length long")
    registry = spark.createDataFrame([], "id long, original_path string, file_hash string")
    hashes = spark.createDataFrame([(r.path, r.file_hash, r.error) for r in got.values()], "path string, file_hash string, error string")
    verdicts = register_verdicts(nas, listing, registry, lambda paths: hashes.join(paths, "path"))
    assert {r.original_path: r.verdict for r in verdicts.collect()} == {"/a.pdf": "missing_remote", "/b.pdf": "failed", "/d.pdf": "missing_remote"}


def test_registry_snapshot(spark):
    base = tempfile.mkdtemp(prefix="quire-reg-")
    df = spark.range(3).withColumn("v", F.lit("a"))
    write_registry_snapshot(df, base, 1)
    write_registry_snapshot(df.withColumn("v", F.lit("b")), base, 2)
    assert {r.v for r in read_registry(spark, base).collect()} == {"b"}
    df.write.parquet(f"{base}/v=3")  # a snapshot that failed before its pointer was written
    assert {r.v for r in read_registry(spark, base).collect()} == {"b"}


def test_markdown_store_keeps_the_largest_id(spark):
    path = tempfile.mkdtemp(prefix="quire-md-")
    rows = spark.createDataFrame([("h", i, f"text {i}") for i in range(50)] + [("k", 1, "other")], "doc_key string, id long, markdown string")
    write_markdown_store(rows.repartition(7), path)
    assert {(r.doc_key, r.markdown) for r in spark.read.parquet(path).collect()} == {("h", "text 49"), ("k", "other")}


def test_pages_open_their_ranges_only(spark):
    from quire.operators.paging import read_page, write_pages

    path = tempfile.mkdtemp(prefix="quire-pages-")
    ids = sorted({i * i % 10_007 for i in range(3000)})
    write_pages(spark.createDataFrame([(i, f"v{i}") for i in ids], "id long, v string").repartition(5), ["id"], path, ranges=20)
    for page in (0, 1, 7, len(ids) // 70, 10_000):
        got = [(r.position, r.id) for r in read_page(spark, path, ["id"], page, 70).orderBy("position").collect()]
        assert got == list(enumerate(ids))[page * 70 : page * 70 + 70]
    files = read_page(spark, path, ["id"], 7, 70)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(range" in files or "PartitionFilters: [range" in files
    write_pages(spark.createDataFrame([], "id long, v string"), ["id"], f"{path}/none", ranges=4)
    assert read_page(spark, f"{path}/none", ["id"], 0, 10).count() == 0
