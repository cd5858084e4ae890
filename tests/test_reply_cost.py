"""What reading a reply costs: bodies are not sorted, strings are walked once, images decoded once."""

import base64
import json

from pyspark.sql import functions as F

from quire.operators import replies as RP
from quire.operators import reply_reader as reader
from quire.plans import adapters as A

REQUEST = "batch_no bigint, id bigint, file_uid string, file_name string, local_name string, absolute_path string"


def _walk(body: str):
    _, results = reader.container(body)
    return next(iter(results.members().values())).members()


def test_bodies_are_not_sorted(spark):
    requests = spark.createDataFrame([(1, 1, "u", "a.pdf", "a.pdf", "/t/a.pdf")], REQUEST)
    replies = spark.createDataFrame([(1, 200, '{"results": {"u": "text"}}')], "batch_no bigint, status_code int, body string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for rows in (RP.matched_files(requests, replies), RP.stored_images(requests, replies)):
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan
            rows.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_strings_of_a_reply_are_walked_once(monkeypatch):
    body = json.dumps({"results": {"u": {"md": "text", "images": {f"p{k}.png": "aGk=" for k in range(20)}}}})
    calls = []
    scan = reader.scanstring
    monkeypatch.setattr(reader, "scanstring", lambda *a: calls.append(a[1]) or scan(*a))
    members = _walk(body)
    assert members["md"].load() == "text"
    assert [n for n, _, _ in reader.stored_images(members)] == [f"p{k}.png" for k in range(20)]
    assert len(calls) == len(set(calls)) == body.count('"') // 2


def test_images_are_decoded_once_and_the_last_good_one_of_a_name_is_stored(monkeypatch):
    b64 = [base64.b64encode(f"i{k}".encode()).decode() for k in range(4)]
    images = {"x/a.png": b64[0], "b.png": b64[1], "y/a.png": b64[2], "bad.png": "a*b", "z/a.png": "a*b", "c.png": b64[3]}
    body = json.dumps({"results": {"u": {"md": "text", "images": images}}})
    decode, decoded = reader.decoded_image, []
    monkeypatch.setattr(reader, "decoded_image", lambda text: decoded.append(text) or decode(text))
    assert list(reader.stored_images(_walk(body))) == [
        ("a.png", b"i0", False), ("b.png", b"i1", True), ("a.png", b"i2", True), ("c.png", b"i3", True)]
    assert decoded.count(b64[1]) == decoded.count(b64[3]) == decoded.count(b64[0]) == 1


def test_mentions_one_by_one_equal_one_pass(monkeypatch):
    text = "p1.png p1.png,xp1.png p1.pngx (p1.png) a/p1.png p1.png\n-p1.png _p1.png \u00e9p1.png\u00b2 p1.png"
    urls = {"p1.png": "/images/7/p1.png", "p2.png": "/images/7/p2.png", "png": "/images/7/png"}
    few = reader.rewritten(text, urls)
    monkeypatch.setattr(reader, "_FEW_NAMES", 0)
    assert few == reader.rewritten(text, urls) and few.count("/images/7/p1.png") == 5


def test_blanks_in_base64(monkeypatch):
    assert reader.decoded_image(" aG \n\x1c\x1fk= ") == b"hi" == reader.decoded_image("aG\u00a0k\u2003=")
    assert reader.decoded_image("aG\x00k=") is None and reader.decoded_image("é") is None


def test_json_strings_of_the_adapters(spark):
    texts = [None, "", "]", "[a]", 'a"\\[\u00e9\u2028\n]', "\U0001f600["]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", A._json_str(F.col("t")).alias("j")).collect()
    assert all(json.loads(r.j) == r.t for r in rows) and len(rows) == len(texts)
