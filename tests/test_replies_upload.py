"""Parser replies (FIXTURES.md section 5), upload replies (section 7) and raw-upload paths (section 8)."""

import base64
import hashlib
import json
import random
import re
import time
from pathlib import PurePosixPath

from pyspark.sql import functions as F

from quire.operators import replies as RP
from quire.operators import reply_reader as reader
from quire.operators import upload as U


def _requests(spark, rows):
    return spark.createDataFrame(
        [(b, i, uid, name, name, f"/tmp/parse/{i}/{name}", "pdf", "h") for b, i, uid, name in rows],
        "batch_no bigint, id bigint, file_uid string, file_name string, local_name string, absolute_path string, "
        "file_ext string, file_hash string")


def _match(spark, requests, replies):
    reps = spark.createDataFrame(replies, "batch_no bigint, status_code int, body string")
    out = RP.parse_results(requests, reps).select("id", "parse_status", "markdown_content").collect()
    return {r.id: (r.parse_status, r.markdown_content) for r in out}


def test_reply_shapes(spark):
    req = _requests(spark, [
        (1, 1, "u1", "a.pdf"), (1, 2, "u2", "b.docx"), (1, 3, "u3", "c.pdf"),
        (2, 4, "u4", "b.docx"), (2, 5, "u5", "c.pdf"),
        (3, 6, "u6", "a.pdf"),
        (4, 7, "u7", "a.pdf"), (4, 8, "u8", "q.pdf"),
        (5, 9, "u9", "a.pdf"), (6, 10, "u10", "a.pdf"), (7, 11, "u11", "a.pdf"),
        (8, 12, "u12", "a.pdf"), (8, 13, "u13", "b.pdf"), (9, 14, "u14", "a.pdf"),
    ])
    got = _match(spark, req, [
        (1, 200, '{"results": {"u1": {"md_content": "x"}, "b.docx": {"markdown": "y"}, "c": "z"}}'),
        (2, 200, '{"results": [{"original_file_name": "b.docx", "md": "y"}, 5, {"name": "c", "content": "z"}]}'),
        (3, 200, '{"results": {}, "result": {"a.pdf": {"md_content": "x"}}}'),
        (4, 200, '{"results": {"zzz": {"md_content": "x"}}}'),
        (5, 200, '{"results": {"a.pdf": {"md_content": "  ", "md": "x"}}}'),
        (6, 200, '{"results": {"a.pdf": {"md_content": 5}}}'),
        (7, 200, "busy"),
        (8, 200, '{"results": {"x.pdf": "1", "y.pdf": "2"}}'),
        (9, 503, '{"results": {"a.pdf": "x"}}'),
    ])
    assert got == {
        1: ("success", "x"), 2: ("success", "y"), 3: ("success", "z"), 4: ("success", "y"), 5: ("success", "z"),
        6: ("success", "x"), 7: ("success", "x"), 8: ("success", "x"), 9: ("success", "x"),
        10: ("success", None), 11: ("success", None), 12: ("success", None), 13: ("success", None),
        14: ("failed", None),
    }


def test_images_and_rewrite(spark):
    req = _requests(spark, [(1, 7, "u7", "a.pdf")])
    body = ('{"results": {"a.pdf": {"md_content": "![alt](images/p1.png?x=1) see p1.png, not xp1.png or d/p1.png",'
            ' "images": [{"filename": "q.png", "data": "aGVsbG8="}, "aGVsbG8=", {"name": "empty.png"},'
            ' {"name": "p1.png", "base64": "data:image/png;base64,aGVs\\nbG8="}, {"name": "bad.png", "data": "a*b"},'
            ' {"name": "pad.png", "data": "aGVsbG8"}]}}}')
    got = _match(spark, req, [(1, 200, body)])
    assert got[7][1] == "![alt](/images/7/p1.png) see /images/7/p1.png, not xp1.png or d/p1.png"
    reps = spark.createDataFrame([(1, 200, body)], "batch_no bigint, status_code int, body string")
    stored = {r.image_name: bytes(r.bytes) for r in RP.stored_images(req, reps).collect()}
    assert stored == {"q.png": b"hello", "image_2.png": b"hello", "p1.png": b"hello"}


def test_upload_reply_verdicts(spark):
    bodies = ['{"status":"success"}', '{"status":"failure"}', '{"status":"partial_success"}',
              '{"status":"duplicated"}', "ok"]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = [r[0] for r in df.select(U.reply_ok(F.lit(200), F.col("body"))).collect()]
    assert got == [True, False, False, True, True]


def test_raw_upload_paths(spark):
    parsed = spark.createDataFrame(
        [(1, "/md/a.md", "s"), (2, "b.markdown", "s"), (3, "/md/../x/c.md", "s"), (4, "/md/d.txt", "s"),
         (5, "/md/e.txt", "s"), (6, "/md2/f.md", "s")], "id bigint, parse_path string, original_path string")
    store = spark.createDataFrame([("/md/a.md", b"A"), ("/md/b.markdown", b"B"), ("/x/c.md", b"C"),
                                   ("/md/d.txt", b"D")], "path string, content binary")
    replies = spark.createDataFrame([(i, 200, '{"status":"success"}') for i in range(1, 7)],
                                    "batch_no bigint, status_code int, body string")
    got = {r.id: r.verdict for r in U.raw_upload_verdicts(parsed, store, replies, "/md").collect()}
    assert got == {1: "uploaded", 2: "uploaded", 3: "skipped", 4: "skipped", 5: "failed", 6: "skipped"}


def test_payload(spark):
    docs = spark.createDataFrame([(1, 1, "t1", "s1"), (1, 0, "t0", "s0"), (2, 0, "u", None)],
                                 "batch_no bigint, pos int, text string, file_source string")
    out = {r.batch_no: r.payload for r in U.payloads(docs).collect()}
    assert out == {1: '{"texts":["t0","t1"],"file_sources":["s0","s1"]}', 2: '{"texts":["u"],"file_sources":[""]}'}


def test_cleaned_store_rows(spark):
    df = spark.createDataFrame([(3, "x\n")], "id bigint, cleaned string")
    assert U.cleaned_store_rows(df, save=False) is None
    assert [tuple(r) for r in U.cleaned_store_rows(df).collect()] == [("3", 3, "x\n")]


def test_repeated_keys_and_unnamed_items(spark):
    requests = spark.createDataFrame(
        [(1, 10, "", "a.pdf", "a.pdf", "/t/a.pdf"), (2, 20, "u", "b.pdf", "b.pdf", "/t/b.pdf"), (3, 30, "v", "c.pdf", "c.pdf", "/t/c.pdf")],
        "batch_no long, id long, file_uid string, file_name string, local_name string, absolute_path string")
    good = base64.b64encode(b"png").decode()
    bodies = [
        (1, 200, json.dumps({"results": [{"name": "x", "md": "first"}, {"md": "unnamed"}]})),
        (2, 200, '{"results": {"u": {"md": "old"}, "u": {"md": "new"}, "w": {"md": "-"}}}'),
        (3, 200, json.dumps({"results": [{"name": "v", "md": "![](i.png)", "images": [{"name": "i.png", "content": good}, {"name": "i.png", "content": "!"}, {"name": "j.png", "content": good}]}]})),
    ]
    replies = spark.createDataFrame(bodies, "batch_no long, status_code int, body string")
    got = {r.id: r for r in RP.matched_files(requests, replies).collect()}
    assert got[10].raw_markdown == "unnamed"  # an item without a name is named ''
    assert got[20].raw_markdown == "new"  # of repeated keys the last
    assert got[30].names == ["j.png"]  # the later entry of a name replaces the earlier one, even one that won't decode


def test_repeated_status_and_large_replies(spark):
    rows = [(1, '{"status": "success", "status": "failure"}'), (2, '{"status": "failure", "status": "success"}'), (3, "not json"), (4, None), (5, '{"status": "partial_success"}')]
    df = spark.createDataFrame(rows, "i int, body string")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    got = {r.i: r.ok for r in df.select("i", U.reply_ok(F.lit(200), F.col("body")).alias("ok")).collect()}
    assert got == {1: False, 2: True, 3: True, 4: True, 5: False}


def test_no_text_or_content_in_shuffles(spark):
    """Verdicts move flags and hashes, never texts or file bytes."""
    from quire.operators.register import table_hasher

    parsed = spark.createDataFrame([(1, "/md/a.md", "/a")], "id long, parse_path string, original_path string")
    store = spark.createDataFrame([("/md/a.md", bytearray(b"x"))], "path string, content binary")
    replies = spark.createDataFrame([(1, 200, "{}")], "batch_no long, status_code int, body string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [U.raw_upload_verdicts(parsed, store, replies, "/md"), table_hasher(store)(parsed.select(F.col("parse_path").alias("path")).distinct())]
        for df in plans:
            for line in df._jdf.queryExecution().optimizedPlan().toString().split("\n"):
                if "Join" in line:
                    assert "content" not in line and "text" not in line
            joined = df._jdf.queryExecution().sparkPlan().toString()
            assert joined.index("Join") < joined.index("content")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_replies_of_any_size(spark):
    """Images and Markdown of more than 25 MB, a data URI of 2 MiB in the Markdown, repeated keys: exact bytes and text."""
    image = bytes(range(256)) * 100_000
    inline = base64.b64encode(image[: 3 << 19]).decode()
    text = "long, " * 5_000_000 + f"![x](data:image/png;base64,{inline}) ![big](big.png)"
    data = base64.b64encode(image).decode()
    body = '{"results": {"a.pdf": "old", "a.pdf": ' + json.dumps({"md_content": text, "images": {
        "big.png": "data:image/png;base64," + data, "small.png": base64.b64encode(b"s").decode()}}) + '}, "other": "' + "x" * (1 << 20) + '"}'
    requests = spark.createDataFrame([(1, 10, "", "a.pdf", "a.pdf", "/t/a.pdf")],
                                     "batch_no long, id long, file_uid string, file_name string, local_name string, absolute_path string")
    replies = spark.createDataFrame([(1, 200, body)], "batch_no long, status_code int, body string")
    got = {r.image_name: (r.n, r.h) for r in RP.stored_images(requests, replies).select(
        "image_name", F.octet_length("bytes").alias("n"), F.sha2("bytes", 256).alias("h")).collect()}
    assert got == {"big.png": (len(image), hashlib.sha256(image).hexdigest()), "small.png": (1, hashlib.sha256(b"s").hexdigest())}
    (file,) = RP.matched_files(requests, replies).select("names", F.sha2("raw_markdown", 256).alias("raw"), F.sha2("markdown", 256).alias("md")).collect()
    assert file.raw == hashlib.sha256(text.encode()).hexdigest()
    assert file.md == hashlib.sha256(text.replace("![big](big.png)", "![big](/images/10/big.png)").encode()).hexdigest()
    assert file.names == ["big.png", "small.png"]


def test_reader_equals_json(spark):
    """Event reading against ``json.loads`` on random values, whole, cut and damaged."""
    rng = random.Random(3)

    def value(depth):
        kind = rng.randrange(9 if depth else 5)
        if kind > 6:
            return {rng.choice(["results", "result", "a", "é\n", ""]): value(depth - 1) for _ in range(rng.randrange(4))}
        if kind > 4:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return [None, True, rng.choice([0, 1.5, -3, 0.0]), rng.choice(["", "x", 'q"\\u\u2028'])][rng.randrange(4)]

    def loaded(v):
        return {k: loaded(x) for k, x in v.members().items()} if v.kind == "object" else [loaded(x) for x in v.elements()] if v.kind == "array" else v.load()

    for _ in range(4000):
        text = json.dumps(value(4), indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        if rng.random() < 0.5:
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(["", ",", "}", '"', " ", "1"]) + text[at + rng.randrange(2):]
        try:
            whole, ok = json.loads(text), True
        except ValueError:
            whole, ok = None, False
        is_json, found = reader.container(text)
        assert is_json == ok
        results = (whole.get("results") or whole.get("result")) if isinstance(whole, dict) else None
        assert (None if found is None else loaded(found)) == (results if isinstance(results, (dict, list)) else None)
    assert reader.container("[" * 100_000) == (False, None) and reader.container(None) == (False, None)


def plain_rewrite(text, urls):
    def ref(m):
        name = PurePosixPath(m.group(2).strip().split("#", 1)[0].split("?", 1)[0]).name
        return f"![{m.group(1)}]({urls[name]})" if name in urls else m.group(0)

    text = re.sub(r"!\[([^\]]*)]\(([^)]+)\)", ref, text)
    for old, new in urls.items():
        text = re.sub(rf"(?<![\w/.-]){re.escape(old)}(?![\w/.-])", lambda _: new, text)
    return text


def test_image_rewrite_takes_one_pass():
    rng = random.Random(6)
    names = ["p.png", "a b.png", "b.png", "ü-1.jpg", "x(1).png", "1", "b", "images", "."]
    marks = [*names, " ", " ", "![", "](", ")", "/", "-", "![f](d/b.png?x)", "\n"]
    for _ in range(3000):
        urls = {n: f"/images/1/{n}" for n in rng.sample(names, rng.randrange(6))}
        text = "".join(rng.choice(marks) for _ in range(rng.randrange(14)))
        assert reader.rewritten(text, urls) == plain_rewrite(text, urls)
    took = []
    text = " ".join(f"p{i}.png word" for i in range(20_000))
    for n in (10, 10_000):
        began = time.perf_counter()
        reader.rewritten(text, {f"p{i}.png": f"/images/1/p{i}.png" for i in range(n)})
        took.append(time.perf_counter() - began)
    assert took[1] < 10 * took[0] + 0.5


def test_text_that_cannot_be_written_is_a_row_error(spark):
    req = _requests(spark, [(1, 1, "u1", "a.pdf"), (1, 2, "u2", "b.pdf")])
    reps = spark.createDataFrame([(1, 200, '{"results": {"a.pdf": "x \\ud800 y \\ud83d\\ude00", "b.pdf": "fine"}}')], "batch_no bigint, status_code int, body string")
    got = {r.id: r for r in RP.matched_files(req, reps).collect()}
    assert got[1].raw_markdown == "x � y \U0001f600" and "UnicodeEncodeError" in got[1].error
    assert got[2].raw_markdown == "fine" and got[2].error is None
    results = RP.parse_results(req, reps)
    assert {r.id: r.ok for r in RP.parse_verdicts(results, req).collect()} == {1: False, 2: True}
    uploads = spark.createDataFrame([(1, 200, "{}")], "batch_no bigint, status_code int, body string")
    assert {r.id: r.outcome for r in U.one_step_outcomes(results, uploads, "batch_no").collect()} == {1: "clean_failed", 2: "uploaded"}
