"""Registration verdicts on the catalogue of FIXTURES.md section 1, plus path/identity properties."""

import posixpath
import random
import uuid
from pathlib import PurePosixPath

from pyspark.sql import functions as F

from quire.functions import paths as P
from quire.operators import register as R

NOW = 1700010000


def _inputs(spark):
    cat = [
        (1, "/volume1/share/a.pdf", 3), (2, "/volume1/share/a.pdf", 3), (3, "/share/copy of a.PDF", 3),
        (4, "/share/~$b.docx", 3), (5, "/share/~$b.pdf", 3), (6, "/share/tool.exe", 3), (7, None, 3),
        (17, "   ", 3), (8, "/share/gone.txt", 3), (9, "/share/gone.txt", 3), (10, "/share/known.md", 3),
        (11, "/share/KNOWN.md", 3), (12, "/share/c.pptx", 1), (13, "\\share\\d.xlsx", 3), (14, "/share/.txt", 3),
        (15, "/share/noext", 3), (16, "/share/dot.", 3),
    ]
    files = [
        ("/share/a.pdf", b"A"), ("share/copy of a.PDF", b"A"), ("/share/~$b.pdf", b"B"), ("/share/KNOWN.md", b"K"),
        ("/share/known.md", b"k"), ("/share/d.xlsx", b"D"), ("/share/empty.txt", b""),
    ]
    nas = spark.createDataFrame(cat, "id bigint, full_path string, status int")
    inv = spark.createDataFrame(files, "path string, content binary").withColumn("length", F.length("content"))
    reg = spark.createDataFrame([(100, "/share/known.md", "h-known")], "id bigint, original_path string, file_hash string")
    return nas, inv, reg


def test_verdicts(spark):
    nas, inv, reg = _inputs(spark)
    out = {r.id: r.verdict for r in R.register_verdicts(nas, inv, reg, R.table_hasher(inv)).collect()}
    assert out == {
        1: "inserted", 2: "skipped_existing", 3: "skipped_existing", 4: "skipped_temp", 5: "inserted",
        6: "skipped_unsupported", 7: "missing_remote", 17: "missing_remote", 8: "missing_remote",
        9: "missing_remote", 10: "skipped_existing", 11: "inserted", 13: "inserted", 14: "skipped_unsupported",
        15: "skipped_unsupported", 16: "skipped_unsupported",
    }
    counts = R.scan_counters(R.register_verdicts(nas, inv, reg, R.table_hasher(inv))).first().asDict()
    assert counts["fetched"] == 16 and counts["inserted"] == 4 and counts["missing_remote"] == 4


def test_new_rows(spark):
    nas, inv, reg = _inputs(spark)
    v = R.register_verdicts(nas, inv, reg, R.table_hasher(inv))
    rows = {r.catalogue_id: r for r in R.new_registry_rows(v, reg, NOW).collect()}
    assert [rows[i].id for i in (1, 5, 11, 13)] == [101, 102, 103, 104]
    r13 = rows[13]
    assert r13.original_path == "\\share\\d.xlsx" and r13.file_name == "d.xlsx" and r13.file_ext == "xlsx"
    assert rows[1].file_uid == uuid.uuid5(uuid.NAMESPACE_URL, f"{rows[1].file_hash}:/volume1/share/a.pdf").hex
    assert rows[1].parse_status == 0 and rows[1].created_at == NOW


def _random_paths(n=400, seed=7):
    rnd = random.Random(seed)
    parts = ["", ".", "..", "a", "b.c", "volume1", "x y", "é", "d.", ".e", "~$f.docx"]
    out = []
    for _ in range(n):
        p = "/".join(rnd.choice(parts) for _ in range(rnd.randint(0, 5)))
        p = rnd.choice(["", "/", "//", "///", " ", "\\"]) + p + rnd.choice(["", "/", " ", "/."])
        out.append(p)
    return out


def test_normpath_ext_name_match_python(spark):
    paths = _random_paths()
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string")
    got = df.select("i", P.normalize_path(F.col("p")).alias("n"), P.file_ext(F.col("p")).alias("e"),
                    P.path_name(F.col("p")).alias("m")).collect()
    for r in got:
        p = paths[r.i]
        assert r.n == posixpath.normpath(p.strip().replace("\\", "/")), p
        assert r.e == PurePosixPath(p).suffix.lower().lstrip("."), p
        assert r.m == PurePosixPath(p).name, p


def test_uid_matches_uuid5(spark):
    rows = [("h" * 64, "/volume1/共享/文件.pdf"), ("0" * 64, "/a b/c.txt"), ("", "")]
    df = spark.createDataFrame(rows, "h string, p string")
    got = [r[0] for r in df.select(P.file_uid(F.col("h"), F.col("p"))).collect()]
    assert got == [uuid.uuid5(uuid.NAMESPACE_URL, f"{h}:{p}").hex for h, p in rows]


def test_candidates_docstring_example(spark):
    df = spark.createDataFrame([("/volume1/share/a.pdf",)], "p string")
    assert df.select(P.path_candidates(F.col("p"))).first()[0] == [
        "/volume1/share/a.pdf", "/share/a.pdf", "share/a.pdf", "volume1/share/a.pdf"]


def test_status_filter_reaches_scan(spark, tmp_path):
    nas, _, _ = _inputs(spark)
    nas.write.parquet(str(tmp_path / "nas"))
    plan = R.catalogue_rows(spark.read.parquet(str(tmp_path / "nas")))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,3)]" in plan


def test_long_paths_and_copies_register(spark):
    """No length or size makes a verdict: the first of equal files is new whatever its path."""
    long_dir = "/share/" + "d" * 260
    nas = spark.createDataFrame([(1, f"{long_dir}/a.pdf", 3), (2, "/share/b.pdf", 3), (3, "/share/c.pdf", 3)],
                                "id bigint, full_path string, status int")
    inv = spark.createDataFrame([(f"{long_dir}/a.pdf", b"S"), ("/share/b.pdf", b"S"), ("/share/c.pdf", b"S")],
                                "path string, content binary").withColumn("length", F.length("content"))
    reg = spark.createDataFrame([], "id bigint, original_path string, file_hash string")
    got = {r.id: r.verdict for r in R.register_verdicts(nas, inv, reg, R.table_hasher(inv)).collect()}
    assert got == {1: "inserted", 2: "skipped_existing", 3: "skipped_existing"}
