"""Upload payloads, reply verdicts and outcomes (SNK4, SNK6, FLT7, FLT11, AGG7, T11, T12, SRC5).

A payload is ``{"texts": [...], "file_sources": [...]}`` for one upload batch; the lists are built per batch with a
sorted ``collect_list`` whose size is bounded by the batch size (a parameter), never by the data. Server replies come
back as a table ``(batch_no, status_code, body)``; one reply decides every document of its batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.paths import normalize_path, path_name
from quire.functions.text import has_text

# Fixed values that must equal the reference's.
FAILURE_STATUSES = ("failure", "partial_success")
MARKDOWN_SUFFIXES = (".md", ".markdown")


def read_markdown(content: Column) -> Column:
    """SRC5: bytes to text, invalid UTF-8 replaced by U+FFFD (Spark's strict decode would raise)."""
    return F.make_valid_utf8(content.cast("string"))


def strict_utf8(content: Column) -> Column:
    """The text when the bytes are valid UTF-8, else NULL (strict read)."""
    s = content.cast("string")
    return F.when(F.is_valid_utf8(s), s)


def payloads(docs: DataFrame, batch: str = "batch_no", order: str = "pos", text: str = "text",
             source: str = "file_source") -> DataFrame:
    """SNK4: one payload per batch ``(batch_no, n_texts, texts, file_sources, payload)``; lists in batch order."""
    grouped = docs.groupBy(batch).agg(
        F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"),
                                             F.coalesce(F.col(source), F.lit("")).alias("s")))).alias("e")
    )
    texts = F.transform("e", lambda x: x["t"])
    sources = F.transform("e", lambda x: x["s"])
    return grouped.select(
        batch, F.size("e").alias("n_texts"), texts.alias("texts"), sources.alias("file_sources"),
        F.to_json(F.struct(texts.alias("texts"), sources.alias("file_sources"))).alias("payload"),
    ).where(F.col("n_texts") > 0)


def reply_ok(status_code: Column, body: Column) -> Column:
    """FLT11: a reply fails when it is not 2xx, or when its JSON ``status`` is 'failure' or 'partial_success';
    anything else (other statuses, no status, not JSON) is success. Of repeated keys the last one counts, which a
    VARIANT leaves out (it is NULL then) and ``from_json`` tells."""
    parsed = F.try_parse_json(body)
    last = F.from_json(body, "status string").getField("status")
    status = F.when(parsed.isNotNull(), F.try_variant_get(parsed, "$.status", "string")).otherwise(last)
    http_ok = F.coalesce(status_code.between(200, 299), F.lit(True))
    return http_ok & ~F.coalesce(status.isin(*FAILURE_STATUSES), F.lit(False))


def batch_verdicts(members: DataFrame, replies: DataFrame, batch: str = "batch_no") -> DataFrame:
    """AGG7: every member of a batch (``members[batch]``) gets the verdict of the reply with that ``batch_no``
    (no reply -> failed)."""
    status = F.col("status_code") if "status_code" in replies.columns else F.lit(200)
    r = replies.select(F.col("batch_no").alias(batch), reply_ok(status, F.col("body")).alias("upload_ok"))
    return members.join(r, batch, "left").withColumn("upload_ok", F.coalesce(F.col("upload_ok"), F.lit(False)))


def resolve_markdown_path(parse_path: Column, root: str, cwd: str = "/") -> Column:
    """FLT7 path part: the parse path made absolute (relative paths against ``cwd``, then under ``root``) and
    normalised; the first form inside ``root`` wins, NULL when none is."""
    root = root.rstrip("/") or "/"
    p = F.coalesce(parse_path, F.lit(""))
    p = F.when(p == "", F.lit(".")).otherwise(p)
    absolute = p.startswith("/")
    first = normalize_path(F.when(absolute, p).otherwise(F.concat(F.lit(cwd.rstrip("/") + "/"), p)), strip=False)
    second = F.when(~absolute, normalize_path(F.concat(F.lit(root + "/"), p), strip=False))

    def inside(x):
        return (x == root) | x.startswith(root + "/")

    return F.when(inside(first), first).when(inside(second), second)


def raw_upload_verdicts(parsed: DataFrame, store: DataFrame, replies: DataFrame, root: str,
                        cwd: str = "/") -> DataFrame:
    """FLT7 + FLT11: per parsed row ``(id, markdown_path, verdict)``: outside the root -> skipped; missing ->
    failed; not .md/.markdown -> skipped; not valid UTF-8 -> failed; upload rejected -> failed; else uploaded.
    Each document is its own upload batch (``batch_no = id``)."""
    rows = parsed.withColumn("markdown_path", resolve_markdown_path(F.col("parse_path"), root, cwd))
    # the verdict needs to know whether a file is there and readable, not its text; rows outside the root join nothing
    files = store.select(F.col("path").alias("markdown_path"), F.lit(True).alias("exists"),
                         F.is_valid_utf8(F.col("content").cast("string")).alias("valid"))
    inside = rows.where(F.col("markdown_path").isNotNull()).join(files, "markdown_path", "left")
    rows = inside.unionByName(rows.where(F.col("markdown_path").isNull()), allowMissingColumns=True)
    rows = batch_verdicts(rows.withColumn("batch_no", F.col("id")), replies)
    suffix = F.lower(F.regexp_extract(path_name(F.col("markdown_path")), r"(?s)^.+(\.[^.]+)\z", 1))
    verdict = (
        F.when(F.col("markdown_path").isNull(), F.lit("skipped"))
        .when(F.col("exists").isNull(), F.lit("failed"))
        .when(~suffix.isin(*MARKDOWN_SUFFIXES), F.lit("skipped"))
        .when(~F.coalesce(F.col("valid"), F.lit(False)), F.lit("failed"))
        .when(~F.col("upload_ok"), F.lit("failed"))
        .otherwise(F.lit("uploaded"))
    )
    return rows.select("id", "markdown_path", verdict.alias("verdict"), "original_path")


def clean_outcomes(claimed: DataFrame, store: DataFrame, replies: DataFrame) -> DataFrame:
    """T11 inputs: a claimed row whose Markdown file is missing, or whose upload is rejected, fails; each
    document is uploaded alone (``batch_no = id``). Returns ``(id, has_markdown, upload_ok, ok)``."""
    files = store.select(F.col("path").alias("parse_path"), F.lit(True).alias("has_markdown"))
    rows = claimed.join(files, "parse_path", "left").withColumn(
        "has_markdown", F.coalesce(F.col("has_markdown"), F.lit(False)))
    rows = batch_verdicts(rows.withColumn("batch_no", F.col("id")), replies)
    return rows.withColumn("ok", F.col("has_markdown") & F.col("upload_ok"))


def one_step_outcomes(results: DataFrame, replies: DataFrame, batch: str = "claim_no") -> DataFrame:
    """T12 inputs: per parse result ``outcome``: 'parse_failed' (not success or blank Markdown), 'clean_failed' (its
    Markdown has an ``error``: it cannot be cleaned and written), else the cycle's single upload decides 'uploaded' /
    'upload_failed' for every prepared document of the cycle."""
    parsed = (F.col("parse_status") == "success") & has_text(F.col("markdown_content"))
    rows = results.withColumn("parsed", parsed).withColumn("prepared", parsed & F.col("error").isNull())
    with_reply = batch_verdicts(rows, replies, batch)
    outcome = (
        F.when(~F.col("parsed"), F.lit("parse_failed"))
        .when(~F.col("prepared"), F.lit("clean_failed"))
        .when(F.col("upload_ok"), F.lit("uploaded"))
        .otherwise(F.lit("upload_failed"))
    )
    return with_reply.withColumn("outcome", outcome)


def cleaned_store_rows(cleaned: DataFrame, save: bool = True, text: str = "cleaned") -> DataFrame | None:
    """SNK6: the one-step flow's optional cleaned-Markdown store, one row per document keyed by its id
    (``doc_key``); ``save=False`` stores nothing and the parse path stays ''."""
    if not save:
        return None
    return cleaned.select(F.col("id").cast("string").alias("doc_key"), "id", F.col(text).alias("markdown"))
