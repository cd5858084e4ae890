"""Driver tables -> the engine's input tables.

The driver ships generic tables (``documents``, ``pages``, ...). These adapters derive from them the tables the engine
works on: a file catalogue, a file inventory, a task registry, a Markdown store. Every rule is a plain projection of
``documents`` keyed by ``k = doc_id``, so the adapters are narrow (no shuffle) and grow with the input. The same rules
are written in DuckDB SQL in ``quire.plans.oracle`` so that both sides start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed parameters of the adapters (test-data shaping rules; not reference values).
BASE_TIME = 1700000000
NOW = 1700004100  # "now" for driver-table queries: rows with k < 500 are older than the 3600 s stale limit
CATALOGUE_EXTS = ("pdf", "docx", "xlsx", "PPTX", "txt", "md", "exe", "pdf")
REGISTRY_EXTS = ("pdf", "docx", "xlsx", "pptx", "txt", "md", "markdown", "pdf")
STATES = (-1, 0, 1, 2)
MD_ROOT = "/md"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _s(c: Column) -> Column:
    return c.cast("string")


def _catalogue_path(m: Column) -> Column:
    """'/volume1/share<m % 20>/[~$]doc<m>.<ext>'; the temp prefix, folder and ext all derive from m."""
    prefix = F.when(m % 23 == 0, F.lit("~$")).otherwise(F.lit(""))
    return F.concat(
        F.lit("/volume1/share"), _s(m % 20), F.lit("/"), prefix, F.lit("doc"), _s(m), F.lit("."),
        _pick(CATALOGUE_EXTS, m % 8),
    )


def nas_files(documents: DataFrame) -> DataFrame:
    """Catalogue ``(id, full_path, status)``: a repeated path every 41 rows, blanks every 97, status 1 every 10."""
    k = F.col("doc_id")
    m = F.when(k % 41 == 8, k - 8).otherwise(k)
    path = (
        F.when(k % 97 == 5, F.when(k % 2 == 0, F.lit(None).cast("string")).otherwise(F.lit("  ")))
        .otherwise(_catalogue_path(m))
    )
    return documents.select(
        k.alias("id"), path.alias("full_path"), F.when(k % 10 == 9, 1).otherwise(3).cast("int").alias("status")
    )


def inventory(documents: DataFrame, with_content: bool = True) -> DataFrame:
    """Files that exist ``(path, modificationTime, length[, content])``.

    One file per document under its own path, absent every 13th; stored under the full path, without '/volume1',
    or relative, by ``k % 3`` (drives the candidate search).
    """
    k = F.col("doc_id")
    full = _catalogue_path(k)
    rel = F.substring(full, F.lit(10), F.length(full))  # drop '/volume1/'
    path = F.when(k % 3 == 0, full).when(k % 3 == 1, F.concat(F.lit("/"), rel)).otherwise(rel)
    cols = [
        path.alias("path"),
        F.timestamp_seconds(F.lit(BASE_TIME) + k).alias("modificationTime"),
        F.octet_length(F.col("text")).cast("bigint").alias("length"),
    ]
    if with_content:
        cols.append(F.encode(F.col("text"), "UTF-8").alias("content"))
    return documents.filter(k % 13 != 0).select(*cols)


def stored_inventory(documents: DataFrame) -> DataFrame:
    """The inventory as files of a mounted folder ``(path, content, vanishes)``: absolute paths, every 11th file (from 2)
    without bytes, every 17th (from 3) gone after the folder was listed."""
    k = F.col("doc_id")
    path = F.when(k % 3 == 0, _catalogue_path(k)).otherwise(F.substring(_catalogue_path(k), F.lit(9), F.length(_catalogue_path(k))))
    content = F.when(k % 11 == 2, F.lit("")).otherwise(F.col("text"))
    return documents.filter(k % 13 != 0).select(path.alias("path"), F.encode(content, "UTF-8").alias("content"), (k % 17 == 3).alias("vanishes"))


def registry(documents: DataFrame) -> DataFrame:
    """Task registry, one row per document.

    Every 29th row is registered under its catalogue path, every 31st under its content hash; the others carry an
    archive path and a hash of other bytes. Both states cycle through (-1, 0, 1, 2); ``parse_path`` takes the
    shapes the raw-upload rules distinguish.
    """
    k = F.col("doc_id")
    m = F.when(k % 41 == 8, k - 8).otherwise(k)
    ext = _pick(REGISTRY_EXTS, k % 8)
    original = F.when(k % 29 == 0, _catalogue_path(m)).otherwise(
        F.concat(F.lit("/archive/"), F.col("source"), F.lit("/doc"), _s(k), F.lit("."), ext)
    )
    file_hash = F.when(k % 31 == 0, F.sha2(F.col("text"), 256)).otherwise(
        F.sha2(F.concat(F.col("text"), F.lit("#v0")), 256)
    )
    parse_path = (
        F.when(k % 17 == 0, F.when(k % 3 == 0, F.lit(None)).when(k % 3 == 1, F.lit("")).otherwise(F.lit(" ")))
        .when(k % 7 == 2, F.concat(F.lit(MD_ROOT + "/../x/doc"), _s(k), F.lit(".md")))
        .when(k % 11 == 4, F.concat(F.lit(MD_ROOT + "/doc"), _s(k), F.lit(".txt")))
        .when(k % 5 == 3, F.concat(F.lit("doc"), _s(k), F.lit(".markdown")))
        .otherwise(F.concat(F.lit(MD_ROOT + "/doc"), _s(k), F.lit(".md")))
        .cast("string")
    )
    return documents.select(
        k.alias("id"),
        F.concat(F.lit("doc"), _s(k), F.lit("."), ext).alias("file_name"),
        F.md5(original).alias("file_uid"),
        ext.alias("file_ext"),
        F.octet_length(F.col("text")).cast("bigint").alias("file_size"),
        file_hash.alias("file_hash"),
        original.alias("original_path"),
        parse_path.alias("parse_path"),
        _pick(STATES, k % 4).cast("tinyint").alias("parse_status"),
        _pick(STATES, F.floor(k / 4) % 4).cast("tinyint").alias("clean_status"),
        F.lit(BASE_TIME).cast("bigint").alias("created_at"),
        (F.lit(BASE_TIME) + k).cast("bigint").alias("updated_at"),
    )


def markdown_store(documents: DataFrame) -> DataFrame:
    """Markdown files that exist ``(path, content)``: the parse output of every document, missing every 19th;
    every 23rd (from 5) ends with a byte that is not UTF-8.

    Stored under the path its registry row resolves to (absolute under the root, or the relative name placed under
    the root); '.txt' outputs exist too, so that the suffix rule has work.
    """
    k = F.col("doc_id")
    path = (
        F.when(k % 7 == 2, F.concat(F.lit("/x/doc"), _s(k), F.lit(".md")))
        .when(k % 11 == 4, F.concat(F.lit(MD_ROOT + "/doc"), _s(k), F.lit(".txt")))
        .when(k % 5 == 3, F.concat(F.lit(MD_ROOT + "/doc"), _s(k), F.lit(".markdown")))
        .otherwise(F.concat(F.lit(MD_ROOT + "/doc"), _s(k), F.lit(".md")))
    )
    content = F.encode(F.col("text"), "UTF-8")
    damaged = F.concat(content, F.unhex(F.lit("FF")))  # one invalid UTF-8 byte every 23rd (from 5)
    return documents.filter(k % 19 != 7).select(
        path.alias("path"), F.when(k % 23 == 5, damaged).otherwise(content).alias("content"))


def messy_paths(documents: DataFrame) -> DataFrame:
    """Catalogue paths written in six untidy ways by ``k % 6`` (blanks, backslashes, './' and '//', '..', two
    leading slashes, relative); all of them normalise back to the clean path, except the two-slash and relative
    forms, which normalisation keeps."""
    k = F.col("doc_id")
    c = _catalogue_path(k)
    raw = (
        F.when(k % 6 == 0, F.concat(F.lit("  "), c, F.lit("\t")))
        .when(k % 6 == 1, F.replace(c, F.lit("/"), F.lit("\\")))
        .when(k % 6 == 2, F.regexp_replace(c, r"/([^/]*)\z", "//./$1"))
        .when(k % 6 == 3, F.replace(c, F.lit("/volume1/"), F.lit("/volume1/tmp/../")))
        .when(k % 6 == 4, F.concat(F.lit("/"), c))
        .otherwise(F.substring(c, F.lit(2), F.length(c)))
    )
    return documents.select(k.alias("id"), raw.alias("raw_path"))


def clean_inputs(documents: DataFrame) -> DataFrame:
    """Documents as cleaning input ``(id, markdown, original_path, source)``; every 7th name carries quotes."""
    k = F.col("doc_id")
    original = F.concat(
        F.lit("/corpus/"), F.col("source"), F.lit("/doc"), _s(k),
        F.when(k % 7 == 0, F.lit('"q"')).otherwise(F.lit("")), F.lit(".txt"),
    )
    return documents.select(k.alias("id"), F.col("text").alias("markdown"), original.alias("original_path"), "source")


def archive_listing(documents: DataFrame) -> DataFrame:
    """Listing ``(path, length)`` of the registry's archive sources; every 13th is missing."""
    k = F.col("doc_id")
    path = F.concat(F.lit("/archive/"), F.col("source"), F.lit("/doc"), _s(k), F.lit("."), _pick(REGISTRY_EXTS, k % 8))
    return documents.filter(k % 13 != 0).select(path.alias("path"), F.octet_length("text").cast("bigint").alias("length"))


def source_listing(documents: DataFrame) -> DataFrame:
    """Every listed source file: the catalogue inventory and the archive."""
    return inventory(documents, with_content=False).select("path", "length").unionByName(archive_listing(documents))


def parse_outcomes(registry_df: DataFrame) -> DataFrame:
    """Parse results for the running rows ``(id, ok, parse_path)``: every third fails; outputs are keyed by hash."""
    k = F.col("id")
    return registry_df.filter(F.col("parse_status") == 1).select(
        "id", (k % 3 != 0).alias("ok"), F.concat(F.lit(MD_ROOT + "/"), F.col("file_hash"), F.lit(".md")).alias(
            "parse_path")
    )


def _json_str(c: Column) -> Column:
    """A JSON string literal of ``c`` (escaped by ``to_json``)."""
    listed = F.to_json(F.array(c))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)  # without the brackets


def reply_markdown(k: Column, text: Column) -> Column:
    """The Markdown the parser returns for document k: its text, an image reference and a bare mention unless
    ``k % 5 = 0``, a reference to an image that is never returned when ``k % 7 = 1``."""
    return F.concat(
        text,
        F.when(k % 5 != 0, F.concat(F.lit("\n![fig](images/p"), _s(k), F.lit(".png)\nsee p"), _s(k), F.lit(".png")))
        .otherwise(F.lit("")),
        F.when(k % 7 == 1, F.concat(F.lit("\n![gone](missing"), _s(k), F.lit(".png)"))).otherwise(F.lit("")),
    )


def _images_json(k: Column) -> Column:
    """Images of document k (unless ``k % 5 = 0``) in one of three shapes by ``k % 3``; in the first shape an
    undecodable extra image when ``k % 5 = 4``."""
    b64 = F.base64(F.encode(F.concat(F.lit("img-"), _s(k)), "UTF-8"))
    junk = F.base64(F.encode(F.concat(F.lit("junk-"), _s(k)), "UTF-8"))
    name = F.concat(F.lit("p"), _s(k), F.lit(".png"))
    wrapped = F.concat(F.lit("data:image/png;base64,"), F.substring(b64, 1, 4), F.lit("\n"), F.substring(b64, 5, 200))
    shape0 = F.concat(
        F.lit('"images": {'), _json_str(F.concat(F.lit("images/"), name)), F.lit(": "), _json_str(b64),
        F.when(k % 5 == 4, F.concat(F.lit(', "bad'), _s(k), F.lit('.png": "a*b"'))).otherwise(F.lit("")), F.lit("}"),
    )
    shape1 = F.concat(F.lit('"images": {'), _json_str(name), F.lit(': {"base64": '), _json_str(wrapped), F.lit("}}"))
    shape2 = F.concat(
        F.lit('"images": [{"filename": '), _json_str(name), F.lit(', "data": '), _json_str(b64), F.lit("}, "),
        _json_str(junk), F.lit(', {"name": "empty.png"}]'),
    )
    return F.when(k % 5 == 0, F.lit(None)).when(k % 3 == 0, shape0).when(k % 3 == 1, shape1).otherwise(shape2)


REPLY_FORMS = ("by_uid", "by_name", "by_stem", "array", "second_container", "not_json")


def parser_replies(requests: DataFrame, documents: DataFrame) -> DataFrame:
    """Replies ``(batch_no, status_code, body)``, one per request batch, in six shapes by ``batch_no % 6``:
    results keyed by uid / by file name / by stem (bare string items), an array with varying name fields and a
    non-object item, an empty ``results`` with the entries under ``result``, and a body that is not JSON. A batch
    of one file answers under an unrelated key every other time (single-entry fallback); every 7th batch (from 3)
    is answered 503."""
    k = F.col("id")
    form = F.col("batch_no") % 6
    md = F.col("md")
    images = F.col("images")
    with_images = lambda head: F.concat(head, F.when(images.isNotNull(), F.concat(F.lit(", "), images))
                                        .otherwise(F.lit("")), F.lit("}"))
    name_field = F.when(F.col("batch_pos") == 0, F.lit("file_name")).otherwise(F.lit("name"))
    item = (
        F.when(form == 0, with_images(F.concat(F.lit('{"md_content": '), md)))
        .when(form == 1, with_images(F.concat(F.lit('{"markdown": '), md)))
        .when(form == 2, md)
        .when(form == 3, with_images(F.concat(F.lit('{"'), name_field, F.lit('": '), _json_str(F.col("file_name")),
                                              F.lit(', "md": '), md)))
        .otherwise(with_images(F.concat(F.lit('{"content": '), md)))
    )
    key = (
        F.when((F.col("batch_size") == 1) & (F.col("batch_no") % 2 == 1) & form.isin(0, 1, 4), F.lit("only"))
        .when(form == 0, F.col("file_uid"))
        .when(form == 2, F.regexp_replace(F.col("local_name"), r"\.[^.]*$", ""))
        .otherwise(F.col("file_name"))
    )
    entry = F.when(form == 3, F.col("item")).otherwise(F.concat(_json_str(key), F.lit(": "), F.col("item")))
    texts = documents.select(F.col("doc_id").alias("id"), "text")
    rows = requests.join(texts, "id")
    rows = rows.withColumn("md", _json_str(reply_markdown(k, F.col("text")))).withColumn("images", _images_json(k))
    rows = rows.withColumn("item", item)
    rows = rows.select("batch_no", "batch_pos", "batch_size", entry.alias("entry"))
    per_batch = rows.groupBy("batch_no").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("batch_pos", "entry"))), lambda x: x["entry"]),
                     ", ").alias("entries")
    )
    f = F.col("batch_no") % 6
    body = (
        F.when(f == 3, F.concat(F.lit('{"results": [5, '), F.col("entries"), F.lit("]}")))
        .when(f == 4, F.concat(F.lit('{"results": {}, "result": {'), F.col("entries"), F.lit("}}")))
        .when(f == 5, F.lit("busy"))
        .otherwise(F.concat(F.lit('{"results": {'), F.col("entries"), F.lit("}}")))
    )
    status = F.when(F.col("batch_no") % 7 == 3, F.lit(503)).otherwise(F.lit(200))
    return per_batch.select("batch_no", status.alias("status_code"), body.alias("body"))


HEAVY_COPIES = 8


def heavy_replies(documents: DataFrame) -> DataFrame:
    """One reply per document ``(batch_no, status_code, body, file_name)`` that holds it many times: as Markdown beside
    an inline data URI of the text's bytes, as an image of ``HEAVY_COPIES`` times the text (with line ends every few
    characters when ``k % 2 = 1``), as an older Markdown and an older image that later keys replace, and under
    ``result`` beside a repeated, empty ``results``."""
    k = F.col("doc_id")
    name = F.concat(F.lit("doc"), _s(k), F.lit(".pdf"))
    image = F.concat(F.lit("p"), _s(k), F.lit(".png"))
    b64 = F.replace(F.base64(F.encode(F.col("text"), "UTF-8")), F.lit("\r\n"), F.lit(""))
    large = F.replace(F.base64(F.encode(F.repeat("text", F.lit(HEAVY_COPIES)), "UTF-8")), F.lit("\r\n"), F.lit(""))
    # as JSON: of what stands in base64 nothing is escaped, a line end is written as one
    broken = F.when(k % 2 == 1, F.regexp_replace(large, "(.{60})", "$1\\\\n ")).otherwise(large)
    uri = F.coalesce(F.concat(F.lit('"data:image/png;base64,'), broken, F.lit('"')), F.lit("null"))
    md = F.concat(F.col("text"), F.lit("\n![inline](data:image/png;base64,"), b64, F.lit(")\n![fig](a/"), image, F.lit(")"))
    item = F.concat(
        F.lit('{"md": "old", "images": {'), _json_str(image), F.lit(': "b2xk", '), _json_str(image), F.lit(": "),
        uri, F.lit('}, "md": '), _json_str(md), F.lit("}"))
    body = F.concat(F.lit('{"results": {"x": 1}, "result": {'), _json_str(name), F.lit(": "), item, F.lit('}, "results": {}}'))
    return documents.select(k.alias("batch_no"), F.lit(200).alias("status_code"), body.alias("body"), name.alias("file_name"))


BROKEN_BATCH = 4


def broken_replies(documents: DataFrame) -> DataFrame:
    """One reply per four documents ``(batch_no, status_code, body)``, keyed by file name; ``k % 6 = 1``: the Markdown ends
    with half a surrogate pair, ``k % 6 = 3``: it is blank; every 9th reply (from 4) is a 500."""
    k = F.col("doc_id")
    name = F.concat(F.lit("doc"), _s(k), F.lit(".pdf"))
    md = F.when(k % 6 == 3, F.lit('" \\n"')).when(
        k % 6 == 1, F.concat(F.regexp_replace(_json_str(F.col("text")), '"\\z', ""), F.lit('\\ud800"'))).otherwise(_json_str(F.col("text")))
    entry = F.concat(_json_str(name), F.lit(': {"md": '), md, F.lit("}"))
    rows = documents.select(F.floor(k / BROKEN_BATCH).cast("bigint").alias("batch_no"), k.alias("k"), entry.alias("entry"))
    bodies = rows.groupBy("batch_no").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "entry"))), lambda x: x["entry"]), ", ").alias("e"))
    return bodies.select("batch_no", F.when(F.col("batch_no") % 9 == 4, 500).otherwise(200).alias("status_code"),
                         F.concat(F.lit('{"results": {'), F.col("e"), F.lit("}}")).alias("body"))


def messy_names(registry_df: DataFrame) -> DataFrame:
    """Registry rows with file names that no local file may carry, by ``id % 5``: illegal characters, none, blanks and
    dots only, folders in front."""
    k = F.col("id")
    name = (F.when(k % 5 == 0, F.concat(F.lit(' a<b>:"c|?*'), _s(k), F.lit(" .pdf"))).when(k % 5 == 1, F.lit(None).cast("string"))
            .when(k % 5 == 2, F.lit(" . .docx")).when(k % 5 == 3, F.concat(F.lit("x/y/d"), _s(k), F.lit(".PDF"))).otherwise(F.col("file_name")))
    return registry_df.withColumn("file_name", name)


UPLOAD_REPLY_BODIES = ('{"status":"success"}', '{"status":"failure"}', '{"status":"partial_success"}',
                       '{"status":"duplicated"}', "ok")


def upload_replies(batches: DataFrame, key: str = "batch_no") -> DataFrame:
    """Retrieval-server replies ``(batch_no, status_code, body)``, by ``batch_no % 5``: success, failure,
    partial_success, duplicated, not JSON (the middle two are rejections)."""
    b = F.col(key)
    return batches.select(b.alias("batch_no")).distinct().select(
        "batch_no", F.lit(200).alias("status_code"), _pick(UPLOAD_REPLY_BODIES, F.col("batch_no") % 5).alias("body"))


def block_documents(documents: DataFrame) -> DataFrame:
    """Documents with blocks added by k, so that every cleaning rule has work ``(id, markdown, source)``: an old
    metadata header (k % 6 = 0), an HTML table with a ragged row and a pipe (k % 5 = 1), a Markdown and an HTML
    image (k % 4 = 2), a zero-width mark (k % 7 = 3), page-number lines (k % 3 = 1), a heading (k % 8 = 5),
    CRLF line ends and a run of blank lines (k % 9 = 4)."""
    k = F.col("doc_id")
    ks = _s(k)
    header = F.when(k % 6 == 0, F.lit('---\nfile_name: "old"\n---\n')).otherwise(F.lit(""))
    table = F.when(k % 5 == 1, F.concat(
        F.lit("\n<table><tr><th>h"), ks, F.lit("</th><th>v</th></tr><tr><td>a|"), ks,
        F.lit("<br>x</td></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>\n"))).otherwise(F.lit(""))
    images = F.when(k % 4 == 2, F.concat(
        F.lit("\n![pic](img/"), ks, F.lit("/fig%201.png?x=1)\n<img src=\"im/p"), ks, F.lit('.png">\n'))
    ).otherwise(F.lit(""))
    zw = F.when(k % 7 == 3, F.lit("\u200b")).otherwise(F.lit(""))
    pages = F.when(k % 3 == 1, F.concat(F.lit("\nPage "), _s(k % 9), F.lit(" of 9\n"), ks, F.lit("\n"))).otherwise(
        F.lit(""))
    heading = F.when(k % 8 == 5, F.concat(F.lit("\n##Heading "), ks, F.lit("\n"))).otherwise(F.lit(""))
    tail = F.when(k % 9 == 4, F.lit("\r\nend  \r\n\r\n\r\n\r\nx")).otherwise(F.lit(""))
    md = F.concat(header, zw, F.col("text"), table, images, pages, heading, tail)
    return documents.select(k.alias("id"), md.alias("markdown"), "source")


def rich_documents(documents: DataFrame) -> DataFrame:
    """``block_documents`` with what the remaining cleaning rules act on ``(id, markdown, original_path, source)``: a
    table-of-contents anchor (k % 10 = 3), an image whose name holds '%' under a numbered folder (k % 12 = 6), spans in
    '_' (k % 11 = 2) and '*' (k % 11 = 5) where the text has no such mark, a comment, tags, garbage and entities
    (k % 13 = 1 .. 4)."""
    k = F.col("doc_id")
    ks = _s(k)

    def block(test, *parts):
        return F.when(test, F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])).otherwise(F.lit(""))

    extra = F.concat(
        block(k % 10 == 3, '\n<a name="_Toc', ks, '"></a>anchor\n'),
        block(k % 12 == 6, "\n![x](img/77/100%25 50%.png#", ks, ")\n"),
        block((k % 11 == 2) & ~F.col("text").contains("_"), "\n_under ", ks, "_ end\n"),
        block((k % 11 == 5) & ~F.col("text").contains("*"), "\n*ital ", ks, "* end\n"),
        block(k % 13 == 1, "\nbefore<!-- note\n", ks, " -->after\n"),
        block(k % 13 == 2, "\n<div><span>x</span><p>", ks, "</p></div><h1>t</h1>\n"),
        block(k % 13 == 3, "\ntext_image\\_ ", ks, "\n"),
        block(k % 13 == 4, "\n&copy; &middot; &amp; ", ks, "\n"),
    )
    blocks = block_documents(documents.withColumn("text", F.concat("text", extra)))
    names = clean_inputs(documents).select("id", "original_path")
    return blocks.join(names, "id")
