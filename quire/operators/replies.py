"""Parser replies: container, per-file match, Markdown, images, rewrite, outcomes.

Operators: SRC4 and JS1 (reply and container), J4/J5 (object / array match with the single-entry fallback), J6/SET3 (files
without a result), JS2-JS6 (Markdown, images, strict base64, URL), J8/J9 (image rewrite and dangling references), FLT8,
FLT10, PRJ3, SNK2, T3 inputs, AGG2.

Replies are rows ``(batch_no, status_code, body)``, one per batch; requests are rows ``(batch_no, id, file_uid,
file_name, local_name, absolute_path, ...)``. A batch's requests (a few, gathered into a row) are joined to its reply
once, so a body crosses the network once; an Arrow function then reads the body by events
(``quire.operators.reply_reader``) and gives one row per file, or one row per image where images are asked for. Bodies
and strings may be of any size that a Spark string holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.clean import MD_IMAGE
from quire.functions.paths import path_name
from quire.functions.text import has_text, py_strip
from quire.operators import reply_reader as reader

BATCH_ROWS, BATCH_SIZE = 1000, 1 << 20

# ------------------------------------------------------------------------------------------------ containers


def _answered(status_code: int | None) -> bool:
    """FLT10: a request not answered 2xx failed."""
    return status_code is not None and 200 <= status_code < 300


def reply_audit(replies: DataFrame) -> DataFrame:
    """Per reply: HTTP success (FLT10), JSON or not, container form and its number of entries."""

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for number, status, body in zip(*(batch.column(c).to_pylist() for c in ("batch_no", "status_code", "body"))):
                is_json, results = reader.container(body)
                size = 0 if results is None else len(results.members()) or len(results.elements())
                rows.append((number, status, _answered(status), is_json, "none" if results is None else results.kind, size))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows) if rows else [[]] * 6, out)], schema=out)

    schema = T.StructType([replies.schema["batch_no"], replies.schema["status_code"], T.StructField("response_success", T.BooleanType()),
                           T.StructField("is_json", T.BooleanType()), T.StructField("form", T.StringType()), T.StructField("entries", T.IntegerType())])
    out = _arrow_schema(schema)
    return replies.select("batch_no", "status_code", "body").mapInArrow(audit, schema)


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batched(rows: Iterator[dict], schema: pa.Schema, size: Callable[[dict], int]) -> Iterator[pa.RecordBatch]:
    """Rows as batches that close once they hold ``BATCH_ROWS`` rows, or ``BATCH_SIZE`` bytes or characters."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= BATCH_SIZE or len(held) >= BATCH_ROWS:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


# ------------------------------------------------------------------------------------------------ matching


def _asked(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """``(batch_no, asked, status_code, body)``: the requests of a batch, whose size is a parameter, with its reply.

    The requests are the hashed side: bodies are large and stream past them, where a merge join would sort them."""
    asked = requests.groupBy("batch_no").agg(F.collect_list(F.struct(*requests.columns)).alias("asked"))
    return asked.hint("shuffle_hash").join(replies.select("batch_no", "status_code", "body"), "batch_no", "left")


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch of ``_asked``; a body becomes a string when its row is reached."""
    for asked, status, body in zip(batch.column("asked").to_pylist(), batch.column("status_code").to_pylist(), batch.column("body")):
        yield {"asked": asked, "status_code": status, "body": body.as_py()}


def _answers(row: dict) -> Iterator[tuple[dict, str | None, reader.Value | None]]:
    """(request, form of the reply, item) of the files asked for in one batch."""
    _, results = reader.container(row["body"])
    form = None if results is None else results.kind
    entries, items, names = {}, [], []
    if results is not None:
        entries, items = results.members(), results.elements()
        names = [reader.item_name(x) for x in items]
    for file in row["asked"]:
        yield file, form, None if results is None else reader.find_item(results, entries, items, names, file)


_FILE_FACTS = [("response_success", T.BooleanType()), ("status_code", T.IntegerType()), ("form", T.StringType()),
               ("raw_markdown", T.StringType()), ("markdown", T.StringType()), ("names", T.ArrayType(T.StringType())),
               ("error", T.StringType())]


def matched_files(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """J4, J5, JS2-JS6, J8: per requested file its batch's facts, the Markdown as it came (NULL unless answered and not
    empty) and with its stored images' URLs, and the names under which images are stored, in order. Markdown that
    cannot be written (JSON can name half a surrogate pair) has an ``error``; U+FFFD stands for what is wrong.

    No image content leaves the function; ``reply_images`` gives that.
    """
    schema = T.StructType([*requests.schema, *[T.StructField(c, t) for c, t in _FILE_FACTS]])
    out = _arrow_schema(schema)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(files(batches), out, lambda row: len(row["raw_markdown"] or "") + len(row["markdown"] or ""))

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in _rows(batch):
                status = row["status_code"]
                for file, form, item in _answers(row):
                    raw = text = names = error = None
                    if item is not None and _answered(status):
                        members = item.members()
                        raw = reader.item_markdown(item, members)
                        if raw is not None:
                            stored = {n: reader.image_url(file["id"], n) for n, _, _ in reader.stored_images(members)}
                            raw, error = reader.writable(raw)
                            names, text = list(stored), reader.rewritten(raw, stored)
                    yield {**file, "response_success": None if status is None else _answered(status), "status_code": status,
                           "form": form, "raw_markdown": raw, "markdown": text, "names": names, "error": error}

    return _asked(requests, replies).mapInArrow(match, schema)


def stored_images(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """JS3-JS6 + SNK3: decoded images ``(file_id, image_name, url, bytes, pos)``, one row each; undecodable ones and
    those of files without Markdown are skipped; of two entries with the same base name the later one is stored."""
    schema = T.StructType([T.StructField("file_id", requests.schema["id"].dataType), T.StructField("image_name", T.StringType()),
                           T.StructField("url", T.StringType()), T.StructField("bytes", T.BinaryType()), T.StructField("pos", T.IntegerType())])
    out = _arrow_schema(schema)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(images(batches), out, lambda row: len(row["bytes"]))

    def images(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in _rows(batch):
                if not _answered(row["status_code"]):
                    continue
                for file, _, item in _answers(row):
                    members = {} if item is None else item.members()
                    if item is None or reader.item_markdown(item, members) is None:
                        continue
                    for pos, (name, data, stored) in enumerate(reader.stored_images(members)):
                        if stored:
                            yield {"file_id": file["id"], "image_name": name, "url": reader.image_url(file["id"], name),
                                   "bytes": data, "pos": pos}

    return _asked(requests.select("batch_no", "id", "file_uid", "file_name", "local_name", "absolute_path"), replies).mapInArrow(decode, schema)


def dangling_references(files: DataFrame) -> DataFrame:
    """J9 over ``files(id, raw_markdown, names)``: image references of the parsed Markdown with no stored image of
    that base name (the reference leaves them unchanged)."""
    refs = files.select(
        "id", "names",
        F.posexplode(F.regexp_extract_all(F.col("raw_markdown"), F.lit(MD_IMAGE), 2)).alias("pos", "ref"),
    )
    refs = refs.withColumn("image_name", path_name(F.regexp_extract(py_strip(F.col("ref")), r"^([^#?]*)", 1)))
    return refs.filter(~F.coalesce(F.array_contains("names", F.col("image_name")), F.lit(False))).select(
        "id", "pos", "image_name")


def parse_results(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """``file_results`` of the matched files, in one plan (see there for a written table in between)."""
    return file_results(matched_files(requests, replies))


def file_results(m: DataFrame) -> DataFrame:
    """PRJ3: one parse result per requested file of ``matched_files``, which is better written first where it has
    several readers.

    ``parse_status`` is 'success' for every file of an answered (2xx) request and 'failed' otherwise; the Markdown
    is the matched item's, rewritten to the URLs of the images stored for it, or NULL.
    """
    return m.select(
        F.col("file_ext").alias("file_type"), "id", "file_uid", "file_name", "absolute_path",
        F.when(F.col("response_success"), F.lit("success")).otherwise(F.lit("failed")).alias("parse_status"),
        F.when(F.col("response_success"), F.col("status_code")).alias("status_code"),
        F.coalesce(F.col("response_success"), F.lit(False)).alias("response_success"),
        F.col("markdown").alias("markdown_content"), "batch_no", "error",
    )


def is_parsed_result() -> Column:
    """FLT8: answered, with Markdown that is not blank and can be written."""
    return (F.col("parse_status") == "success") & has_text(F.col("markdown_content")) & F.col("error").isNull()


def parse_verdicts(results: DataFrame, requested: DataFrame, output_dir: str = "/md") -> DataFrame:
    """FLT8 + SNK2 + J6/SET3: per requested file ``(id, ok, parse_path)`` for T3.

    Success needs status 'success' and non-blank Markdown; the Markdown is stored as ``<dir>/<hash or id>.md``.
    Requested files with no result at all fail, and those whose Markdown cannot be written.
    """
    ok = is_parsed_result()
    key = F.coalesce(F.nullif(F.col("file_hash"), F.lit("")), F.col("id").cast("string"))
    got = results.select("id", "parse_status", "markdown_content", "error")
    missing = requested.join(got, "id", "left_anti").select("id", F.lit(False).alias("ok"), "file_hash")
    found = requested.select("id", "file_hash").join(got, "id").select("id", ok.alias("ok"), "file_hash")
    both = found.unionByName(missing)
    return both.select(
        "id", "ok", F.when(F.col("ok"), F.concat(F.lit(output_dir.rstrip("/") + "/"), key, F.lit(".md"))).alias(
            "parse_path")
    )


def markdown_store_rows(results: DataFrame, requested: DataFrame) -> DataFrame:
    """SNK2: ``(doc_key, markdown)``: one object per document, named by its hash, else its id."""
    rows = results.filter(is_parsed_result()).join(requested.select("id", "file_hash"), "id")
    key = F.coalesce(F.nullif(F.col("file_hash"), F.lit("")), F.col("id").cast("string"))
    return rows.select(key.alias("doc_key"), "id", F.col("markdown_content").alias("markdown"))



def insert_image_refs(existing: DataFrame, candidates: DataFrame) -> DataFrame:
    """SNK5: ``(file_uid, image_file, inserted)`` for every distinct candidate; ``inserted`` is false when the pair
    is already present. Appending the inserted rows to ``existing`` gives the new table."""
    distinct = candidates.select("file_uid", "image_file").dropDuplicates()
    present = existing.select("file_uid", "image_file").dropDuplicates().withColumn("_present", F.lit(True))
    return distinct.join(present, ["file_uid", "image_file"], "left").select(
        "file_uid", "image_file", F.col("_present").isNull().alias("inserted"))
