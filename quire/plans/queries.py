"""Registered queries over the driver tables: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads whole driver tables through the adapters and runs an engine operator over all of it. Column names
equal those of the matching DuckDB statement in ``quire.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import paths as P
from quire.operators import batching as B
from quire.operators import documents as D
from quire.operators import register as R
from quire.operators import replies as RP
from quire.operators import metrics as M
from quire.operators import state as S
from quire.operators import upload as U
from quire.operators.paging import read_page, write_pages
from quire.plans import adapters as A
from quire.session import checkpoint_dir, scratch_path
from quire.sources.files import listing_hasher, remove_files, store_files
from quire.sources.inventory import list_files
from quire.sources.sinks import read_registry, write_image_store, write_markdown_store, write_registry_snapshot

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return wrap


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.read_table(spark, sf_dir, "documents")


def _register_inputs(spark: SparkSession, sf_dir: str):
    docs = _docs(spark, sf_dir)
    inv = A.inventory(docs)
    return A.nas_files(docs), inv.select("path", "length"), A.registry(docs), R.table_hasher(inv)


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nas, listing, registry, hasher = _register_inputs(spark, sf_dir)
    return R.register_verdicts(nas, listing, registry, hasher)


# ---------------------------------------------------------------------------------------------- registration


@query("register_verdicts")
def register_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(spark, sf_dir)


@query("register_files")
def register_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2 with real files: the documents' files are written to the shared folder, listed by the inventory source, and
    hashed from storage; some hold no bytes, some are gone between listing and hashing."""
    docs = _docs(spark, sf_dir)
    root = scratch_path(spark, "mounted")
    stored = A.stored_inventory(docs)
    files = store_files(stored, root).join(stored.select("path", "vanishes"), "path")
    files.write.parquet(f"{root}-files")
    mount = root.removeprefix("file://")
    list_files(spark, root, mount).write.parquet(f"{root}-listing")
    listing = spark.read.parquet(f"{root}-listing")
    remove_files(spark.read.parquet(f"{root}-files").filter("vanishes")).write.format("noop").mode("overwrite").save()
    return R.register_verdicts(A.nas_files(docs), listing.select("path", "length"), A.registry(docs), listing_hasher(listing))


@query("register_counters")
def register_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.scan_counters(_verdicts(spark, sf_dir))


@query("registry_new_rows")
def registry_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    nas, listing, registry, hasher = _register_inputs(spark, sf_dir)
    verdicts = R.register_verdicts(nas, listing, registry, hasher)
    return R.new_registry_rows(verdicts, registry, A.NOW)


@query("catalogue_page")
def catalogue_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.catalogue_page(A.nas_files(_docs(spark, sf_dir)), last_id=100, size=50)


@query("path_candidates")
def path_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    messy = A.messy_paths(docs)
    return messy.select(
        "id", F.posexplode(P.path_candidates(F.col("raw_path"))).alias("pos", "candidate")
    ).select("id", (F.col("pos") + 1).alias("pos"), "candidate")


# ---------------------------------------------------------------------------------------------- cleaning


def _cleaned_summary(df: DataFrame, key: str) -> DataFrame:
    return df.select(
        F.col("id").alias(key), F.length("cleaned").cast("bigint").alias("cleaned_len"), F.md5("cleaned").alias("cleaned_md5")
    )


@query("clean_pages")
def clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = A.read_table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), F.col("html").alias("markdown"), F.col("url").alias("original_path")
    )
    return _cleaned_summary(D.clean_documents(pages, file_name=None, parse_path=None), "page_id")


def doc_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.clean_inputs(_docs(spark, sf_dir))


@query("clean_documents")
def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned_summary(D.clean_documents(doc_inputs(spark, sf_dir), file_name=None, parse_path=None), "doc_id")


# ---------------------------------------------------------------------------------------------- state, claims


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.registry(_docs(spark, sf_dir))


def _recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    reg = A.registry(docs)
    reg = S.recover_stale_clean(reg, A.NOW, S.STALE_SECONDS, flag="clean_recovered_processing")
    reg = S.recover_failed(reg, "clean_status", A.NOW, flag="clean_recovered_failed")
    return S.recover_parse(reg, A.source_listing(docs), A.NOW)


@query("state_recovery")
def state_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recovered(spark, sf_dir).select("id", "parse_status", "clean_status", "updated_at")


@query("state_counts")
def state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.transition_counts(
        _recovered(spark, sf_dir),
        ["clean_recovered_processing", "clean_recovered_failed", "recovered_processing", "recovered_failed",
         "kept_failed"],
    )


@query("status_update")
def status_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg = _registry(spark, sf_dir)
    reg = S.apply_parse_results(reg, A.parse_outcomes(reg), A.NOW)
    resets = reg.filter(F.col("id") % 10 == 1).select("id")
    reg = S.apply_status(reg, resets, "clean_status", S.PENDING, A.NOW + 1, flag="reset")
    return reg.select("id", "parse_status", "clean_status", "parse_path", "updated_at")


@query("claims_parse")
def claims_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.parse_claims(_registry(spark, sf_dir)).select("id", "claim_no", "claim_pos")


@query("claims_clean")
def claims_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.clean_claims(_registry(spark, sf_dir)).select("id", "claim_no", "claim_pos")


@query("routes")
def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg = _registry(spark, sf_dir)
    return reg.select(
        "id", B.route(F.col("file_ext")).alias("route"), B.route(F.col("file_ext"), "one_step").alias("one_step_route")
    )


@query("by_extension")
def by_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.by_extension(_registry(spark, sf_dir))


@query("passthrough_results")
def passthrough_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg = _registry(spark, sf_dir)
    return B.passthrough_results(reg.filter(B.route(F.col("file_ext")) == "passthrough"))


REQUEST_LARGE_LIMIT = 20000  # lowered large-file limit so the driver data has large files


def _parser_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    claimed = B.parse_claims(A.registry(docs))
    to_parser = claimed.filter(B.route(F.col("file_ext")) == "parser")
    found = R.resolve_paths(to_parser.select("original_path").distinct(), A.source_listing(docs))
    files = to_parser.join(found.select("original_path", "resolved_path"), "original_path")
    return B.request_rows(files)


@query("request_batches")
def request_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = B.request_batches(_parser_requests(spark, sf_dir), large_limit=REQUEST_LARGE_LIMIT)
    return batches.select("id", "claim_no", "batch_in_claim", "batch_pos", "large", "upload_name", "local_name")


# ---------------------------------------------------------------------------------------------- replies

PARSE_OUTPUT_DIR = "/md"


def _batched_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parser requests with their request batch: ``batch_no = claim_no * 10 + batch_in_claim`` (a claim holds at
    most five files, so at most five batches) and the batch size."""
    from pyspark.sql import Window

    batches = B.request_batches(_parser_requests(spark, sf_dir), large_limit=REQUEST_LARGE_LIMIT)
    batches = batches.withColumn("batch_no", (F.col("claim_no") * 10 + F.col("batch_in_claim")).cast("bigint"))
    batches = batches.withColumn("batch_size", F.count(F.lit(1)).over(Window.partitionBy("batch_no")))
    # The request table is what was sent; it feeds the replies and both sides of the match, so it is written once
    # (reliable checkpoint in the shared folder) instead of being recomputed per branch.
    checkpoint_dir(spark)
    return batches.checkpoint()


def _reply_inputs(spark: SparkSession, sf_dir: str):
    requests = _batched_requests(spark, sf_dir)
    replies = A.parser_replies(requests, _docs(spark, sf_dir))
    return requests, replies


def _matched(spark: SparkSession, sf_dir: str):
    """Requests and their matched files, without image contents; one reader or a written table, never parsed twice."""
    requests, replies = _reply_inputs(spark, sf_dir)
    return requests, RP.matched_files(requests, replies)


def _parse_results(spark: SparkSession, sf_dir: str):
    """Requests and their parse results. The results are written: what follows filters, joins and compares the Markdown,
    and the optimizer would copy the parsing of a reply into each of these uses."""
    requests, matched = _matched(spark, sf_dir)
    path = scratch_path(spark, "parse-results")
    RP.file_results(matched).write.parquet(path)
    return requests, spark.read.parquet(path)


@query("reply_audit")
def reply_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, replies = _reply_inputs(spark, sf_dir)
    return RP.reply_audit(replies)


@query("reply_match")
def reply_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, matched = _matched(spark, sf_dir)
    results = RP.file_results(matched)
    md = F.col("markdown_content")
    return results.select("id", "batch_no", "parse_status", F.length(md).cast("bigint").alias("md_len"), F.md5(md).alias("md_md5"))


@query("large_replies")
def large_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC4 and JS1-JS6 over replies that hold their documents several times: inline data URIs in the Markdown,
    repeated keys, blanks in the base64 and images of the documents' whole size. Whole texts and bytes are compared."""
    replies = A.heavy_replies(_docs(spark, sf_dir))
    requests = replies.select("batch_no", F.col("batch_no").alias("id"), F.lit("").alias("file_uid"), "file_name",
                              F.col("file_name").alias("local_name"), F.concat(F.lit("/t/"), "file_name").alias("absolute_path"))
    files = RP.matched_files(requests, replies)
    images = RP.stored_images(requests, replies).select(
        F.col("file_id").alias("id"), F.col("image_name").alias("name"), F.octet_length("bytes").cast("bigint").alias("size"), F.md5("bytes").alias("digest"))
    md = F.col("markdown")
    return files.select("id", F.lit("").alias("name"), F.length(md).cast("bigint").alias("size"), F.md5(md).alias("digest")).unionByName(images)


@query("parse_outcomes")
def parse_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests, results = _parse_results(spark, sf_dir)
    return RP.parse_verdicts(results, requests, PARSE_OUTPUT_DIR)


@query("images_decoded")
def images_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = RP.stored_images(*_reply_inputs(spark, sf_dir))
    return stored.select(
        "file_id", "image_name", "url", F.octet_length("bytes").cast("bigint").alias("n_bytes"), F.md5("bytes").alias("bytes_md5")
    )


@query("dangling_images")
def dangling_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, matched = _matched(spark, sf_dir)
    return RP.dangling_references(matched.where(F.col("raw_markdown").isNotNull()))


def _parse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    claimed = B.parse_claims(A.registry(docs)).withColumn("route", B.route(F.col("file_ext")))
    requests, results = _parse_results(spark, sf_dir)
    verdicts = RP.parse_verdicts(results, requests, PARSE_OUTPUT_DIR)
    passthrough = B.passthrough_results(claimed.filter(F.col("route") == "passthrough"))
    outcome = verdicts.select("id", "ok", F.lit(True).alias("downloaded")).unionByName(
        passthrough.select("id", "ok", F.lit(False).alias("downloaded"))
    )
    return claimed.join(outcome, "id", "left")


@query("parse_counters")
def parse_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.parse_counters(_parse_rows(spark, sf_dir))


@query("parse_cycle")
def parse_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1, J6, T3 chained: claims become running, every claimed file gets an outcome (also one that is not at its
    source, or of no known type), outcomes become states. The registry is written as a snapshot and read back."""
    reg = _registry(spark, sf_dir)
    claimed = B.parse_claims(reg).withColumn("route", B.route(F.col("file_ext")))
    running = B.mark_claimed(reg, claimed, "parse_status", A.NOW)
    _, results = _parse_results(spark, sf_dir)
    parsed = RP.parse_verdicts(results, claimed.filter(F.col("route") == "parser"), PARSE_OUTPUT_DIR)
    passthrough = B.passthrough_results(claimed.filter(F.col("route") == "passthrough"))
    unknown = claimed.filter(F.col("route") == "unsupported").select(
        "id", F.lit(False).alias("ok"), F.lit(None).cast("string").alias("parse_path"))
    outcomes = parsed.unionByName(passthrough).unionByName(unknown)
    base = scratch_path(spark, "registry")
    write_registry_snapshot(running.select(*reg.columns), base, 1)
    final = S.apply_parse_results(read_registry(spark, base), outcomes, A.NOW + 1)
    write_registry_snapshot(final.select(*reg.columns), base, 2)
    return read_registry(spark, base).select("id", "parse_status", "clean_status", "parse_path", "updated_at")


@query("clean_cycle")
def clean_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T10, T2, T11 and T4 chained: recovered rows, claims, uploads and the final clean states."""
    docs = _docs(spark, sf_dir)
    reg = S.recover_clean(A.registry(docs), A.NOW)
    claimed = B.clean_claims(reg)
    running = B.mark_claimed(reg, claimed, "clean_status", A.NOW)
    outcomes = U.clean_outcomes(claimed, A.markdown_store(docs), A.upload_replies(claimed, "id"))
    final = S.apply_clean_results(running, outcomes, A.NOW + 1)
    return final.select("id", "parse_status", "clean_status", "updated_at")


@query("stored_markdown")
def stored_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2: the Markdown store, written and read back."""
    requests, results = _parse_results(spark, sf_dir)
    path = scratch_path(spark, "markdown-store")
    write_markdown_store(RP.markdown_store_rows(results, requests), path)
    md = F.col("markdown")
    return spark.read.parquet(path).select("doc_key", F.length(md).cast("bigint").alias("md_len"), F.md5(md).alias("md_md5"))


@query("stored_image_files")
def stored_image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK3: the image store, written in buckets and read back."""
    path = scratch_path(spark, "image-store")
    write_image_store(RP.stored_images(*_reply_inputs(spark, sf_dir)), path)
    return spark.read.parquet(path).select(
        "file_id", "image_name", F.octet_length("bytes").cast("bigint").alias("n_bytes"), F.md5("bytes").alias("bytes_md5"))


# ---------------------------------------------------------------------------------------------- uploads


def _raw_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    parsed = S.parsed(A.registry(docs))
    replies = A.upload_replies(parsed, "id")
    verdicts = U.raw_upload_verdicts(parsed, A.markdown_store(docs), replies, A.MD_ROOT)
    pages = B.claims(parsed.select("id"), ["id"], RAW_UPLOAD_PAGE).withColumnRenamed("claim_no", "page_no")
    return verdicts.join(pages.select("id", "page_no"), "id")


RAW_UPLOAD_PAGE = 5


@query("raw_upload_page")
def raw_upload_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_upload(spark, sf_dir).select("id", "page_no", "verdict")


@query("raw_upload_counters")
def raw_upload_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.upload_counters(_raw_upload(spark, sf_dir))


@query("utf8_repair")
def utf8_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = A.markdown_store(_docs(spark, sf_dir))
    text = U.read_markdown(F.col("content"))
    return store.select(
        "path", F.length(text).cast("bigint").alias("n_chars"), F.md5(F.replace(text, F.lit("�"), F.lit(""))).alias("text_md5"),
        F.col("content").cast("string").isNotNull().alias("readable"),
        (U.strict_utf8(F.col("content")).isNull()).alias("repaired"),
    )


def _clean_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    reg = S.recover_clean(A.registry(docs), A.NOW)
    claimed = B.clean_claims(reg)
    store = A.markdown_store(docs)
    outcomes = U.clean_outcomes(claimed, store, A.upload_replies(claimed, "id"))
    texts = store.select(F.col("path").alias("parse_path"), U.read_markdown(F.col("content")).alias("markdown"))
    cleaned = D.clean_documents(outcomes.join(texts, "parse_path", "left"))
    return cleaned.withColumn("clean_status", F.when(F.col("ok"), F.lit(2)).otherwise(F.lit(-1)).cast("tinyint"))


@query("upload_outcomes")
def upload_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean_flow(spark, sf_dir).select(
        "id", "claim_no", "ok", "clean_status", F.md5("cleaned").alias("cleaned_md5"))


@query("clean_counters")
def clean_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.clean_counters(_clean_flow(spark, sf_dir))


def _one_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests, results = _parse_results(spark, sf_dir)
    results = results.join(requests.select("id", "claim_no", "claim_pos", "original_path"), "id")
    return U.one_step_outcomes(results, A.upload_replies(requests, "claim_no"), "claim_no")


@query("one_step_outcomes")
def one_step_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = _one_step(spark, sf_dir)
    reg = S.apply_one_step_results(_registry(spark, sf_dir), outcomes.withColumn("parse_path", F.lit("")), A.NOW)
    return outcomes.select("id", "outcome").join(reg.select("id", "parse_status", "clean_status"), "id")


@query("upload_batches")
def upload_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = _one_step(spark, sf_dir).filter("prepared").select(
        "id", "file_uid", "file_name", "file_type", "absolute_path", "markdown_content", "claim_no", "claim_pos",
        "original_path",
    )
    records = D.clean_record_from_parse(prepared).join(
        prepared.select("id", "claim_no", "claim_pos", F.col("original_path").alias("src")), "id")
    cleaned = D.clean_documents(records, parse_path=None)
    pay = U.payloads(cleaned, batch="claim_no", order="claim_pos", text="cleaned", source="src")
    return pay.select("claim_no", "n_texts", F.array_join("file_sources", "|").alias("file_sources"))


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean records of the prepared one-step results (PRJ4) with their place in the cycle and their cleaned text."""
    prepared = _one_step(spark, sf_dir).filter("prepared")
    records = D.clean_record_from_parse(prepared.withColumn("file_type", F.lower("file_type")))
    places = prepared.select("id", "claim_no", "claim_pos", F.col("original_path").alias("src"))
    return D.clean_documents(records, parse_path=None).join(places, "id")


@query("clean_records")
def clean_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ4: every column of the records that go to cleaning."""
    return _prepared(spark, sf_dir).select("id", "file_uid", "file_name", "file_ext", "original_path", F.md5("markdown").alias("markdown_md5"))


@query("upload_payloads")
def upload_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK4: the payloads as written JSON: what a server reads from them are the cleaned texts, in order."""
    pay = U.payloads(_prepared(spark, sf_dir), batch="claim_no", order="claim_pos", text="cleaned", source="src")
    path = scratch_path(spark, "payloads")
    pay.select("claim_no", "payload").write.parquet(path)
    sent = F.from_json("payload", "texts array<string>, file_sources array<string>")
    return spark.read.parquet(path).select("claim_no", sent.alias("p")).select(
        "claim_no", F.size("p.texts").alias("n_texts"), F.md5(F.array_join(F.transform("p.texts", F.md5), ",")).alias("texts_md5"),
        F.array_join("p.file_sources", "|").alias("file_sources"))


@query("stored_cleaned")
def stored_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK6: the optional store of cleaned Markdown, written and read back."""
    path = scratch_path(spark, "cleaned-store")
    write_markdown_store(U.cleaned_store_rows(_prepared(spark, sf_dir)), path)
    return spark.read.parquet(path).select("doc_key", F.md5("markdown").alias("cleaned_md5"))


@query("one_step_requests")
def one_step_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ2 and S6: request rows of both flows for files with unsafe, missing and nested names."""
    files = A.messy_names(_registry(spark, sf_dir)).select("id", "file_name", "original_path")
    cols = ("id", "local_name", "request_name", "upload_name", "absolute_path")
    return B.request_rows(files).select(F.lit("copies").alias("flow"), *cols).unionByName(
        B.request_rows(files, local_root=None).select(F.lit("one_step").alias("flow"), *cols))


@query("ordered_results")
def ordered_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TOP5: parse results in the order of their requests."""
    requests, results = _parse_results(spark, sf_dir)
    places = requests.select("id", "claim_no", "batch_in_claim", "batch_pos")
    return B.restore_order(results.select("id", "parse_status").join(places, "id")).select("position", "id", "parse_status")


@query("one_step_errors")
def one_step_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T12 with rows that cannot be cleaned and stored: each is an outcome of its own, not a failed task."""
    docs = _docs(spark, sf_dir)
    k = F.col("doc_id")
    name = F.concat(F.lit("doc"), k.cast("string"), F.lit(".pdf"))
    requests = docs.select(
        F.floor(k / A.BROKEN_BATCH).cast("bigint").alias("batch_no"), k.alias("id"), F.lit("u").alias("file_uid"), name.alias("file_name"),
        name.alias("local_name"), F.lit("/t").alias("absolute_path"), F.lit("pdf").alias("file_ext"))
    results = RP.parse_results(requests, A.broken_replies(docs))
    replies = A.upload_replies(requests.select("batch_no").distinct())
    outcomes = U.one_step_outcomes(results.withColumnRenamed("batch_no", "claim_no"), replies).withColumn("parse_path", F.lit(""))
    states = S.apply_one_step_results(_registry(spark, sf_dir), outcomes, A.NOW)
    return outcomes.select("id", "outcome").join(states.select("id", "parse_status", "clean_status"), "id")


@query("registry_views")
def registry_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3: the four views of the registry by state."""
    reg = _registry(spark, sf_dir)
    views = {"pending_parse": S.pending_parse, "failed_parse": S.failed_parse, "pending_clean": S.pending_clean, "parsed": S.parsed}
    path = F.coalesce(F.col("original_path"), F.lit(""))
    return reduce(DataFrame.unionByName, [view(reg).select(F.lit(name).alias("view"), "id", path.alias("original_path")) for name, view in views.items()])


@query("status_pairs")
def status_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.status_summary(_registry(spark, sf_dir))


PAGE_SIZE, PAGES = 50, (0, 1, 4)


@query("parsed_pages")
def parsed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TOP4: offset pages of the parsed rows through a page directory; a page opens the ranges it lies in."""
    path = scratch_path(spark, "pages")
    write_pages(S.parsed(_registry(spark, sf_dir)), ["id"], path, ranges=int(spark.conf.get("spark.sql.shuffle.partitions")))
    pages = [read_page(spark, path, ["id"], page, PAGE_SIZE).select(F.lit(page).alias("page"), "position", "id", "parse_path") for page in PAGES]
    return reduce(DataFrame.unionByName, pages)


@query("run_totals")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG2, AGG3 and AGG4 observed while the runs' rows are written, recovered rows included; one row per run."""
    docs = _docs(spark, sf_dir)
    base = scratch_path(spark, "totals")
    reg = S.recover_clean(A.registry(docs), A.NOW)
    claimed = B.clean_claims(reg)
    outcomes = U.clean_outcomes(claimed, A.markdown_store(docs), A.upload_replies(claimed, "id")).select("id", "ok", F.lit(True).alias("claimed"))
    rows = reg.join(outcomes, "id", "left").withColumn("claimed", F.coalesce("claimed", F.lit(False)))
    clean = M.written_with_totals(rows, f"{base}/clean", M.clean_totals())
    parse = M.written_with_totals(_parse_rows(spark, sf_dir), f"{base}/parse", M.parse_totals())
    raw = M.written_with_totals(_raw_upload(spark, sf_dir), f"{base}/raw", M.upload_totals())
    names = ("recovered_processing", "recovered_failed", "picked", "success", "failed", "uploaded", "skipped", "downloaded", "unsupported",
             "passthrough")
    return spark.createDataFrame([(run, *(t.get(n) for n in names)) for run, t in (("parse", parse), ("clean", clean), ("raw_upload", raw))],
                                 "run string, " + ", ".join(f"{n} bigint" for n in names))


# ---------------------------------------------------------------------------------------------- streaming

STREAM_PARTS = 3


@query("stream_register")
def stream_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1-ST3: the catalogue arrives in three id ranges, one after another; each arrival is registered by an
    ``availableNow`` run of the same stream (same checkpoint). The verdicts equal the one-shot registration."""
    from quire.streaming.register_stream import read_verdicts, start_register_stream

    docs = _docs(spark, sf_dir)
    inv = A.inventory(docs)
    catalogue = A.nas_files(docs)
    base = scratch_path(spark, "stream-register")
    inv.select("path", "length").write.parquet(f"{base}/listing")  # each batch reads the listing, not the contents
    listing = spark.read.parquet(f"{base}/listing")
    top = catalogue.agg(F.max("id")).first()[0] or 0
    part = F.floor(F.col("id") * STREAM_PARTS / (top + 1))
    for i in range(STREAM_PARTS):
        catalogue.filter(part == i).repartitionByRange("id").write.mode("append").parquet(f"{base}/source")
        q = start_register_stream(spark, f"{base}/source", f"{base}/out", f"{base}/checkpoint",
                                  listing, A.registry(docs), R.table_hasher(inv), A.NOW,
                                  files_per_batch=10_000)
        q.awaitTermination()
    # Verdicts equal the one-shot job; the file facts of a repeated path may differ (a path inserted by an earlier
    # batch is skipped before its file is read, as the reference does across its pages).
    return read_verdicts(spark, f"{base}/out").select("id", "original_path", "verdict")


@query("stream_cycle")
def stream_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1-ST4: the parser's replies arrive in three parts; each is matched, judged, cleaned, uploaded and committed by
    an ``availableNow`` run of the same stream, late clean claims are taken back, and the registry is compacted between."""
    from quire.sources.registry_log import RegistryLog
    from quire.streaming.cycle_stream import Cycle, start_cycle_stream, start_cycles

    docs, registry = _docs(spark, sf_dir), _registry(spark, sf_dir)
    requests, replies = _reply_inputs(spark, sf_dir)
    base = scratch_path(spark, "stream-cycle")
    log = RegistryLog(spark, f"{base}/state")
    claimed = B.parse_claims(registry).withColumn("route", B.route(F.col("file_ext")))
    start_cycles(log, registry, claimed, requests, A.NOW)
    cycle = Cycle(log, f"{base}/out", requests, A.markdown_store(docs), lambda rows: A.upload_replies(rows, "id"), A.NOW,
                  output_dir=PARSE_OUTPUT_DIR)
    for part in range(STREAM_PARTS):
        replies.where(F.pmod(F.hash("batch_no"), F.lit(STREAM_PARTS)) == part).write.mode("append").parquet(f"{base}/source")
        start_cycle_stream(spark, cycle, f"{base}/source", f"{base}/checkpoint").awaitTermination()
        if part == 0:
            log.compact()
    return log.rows().select("id", "parse_status", "clean_status", "parse_path", "updated_at")


# ---------------------------------------------------------------------------------------------- extraction


@query("doc_tables")
def doc_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.doc_tables(A.block_documents(_docs(spark, sf_dir)))


@query("doc_images")
def doc_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.doc_images(A.block_documents(_docs(spark, sf_dir)))


@query("removed_lines")
def removed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.removed_lines(A.block_documents(_docs(spark, sf_dir))).select("doc_id", "line")


@query("clean_audit")
def clean_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per stage and source: documents changed and characters removed, over the whole documents table."""
    return D.stage_audit(doc_inputs(spark, sf_dir), file_name=None, parse_path=None)


@query("clean_blocks")
def clean_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1-C20 over the documents with tables, images, anchors, headers, page lines and marks, whole cleaned texts."""
    return _cleaned_summary(D.clean_documents(A.rich_documents(_docs(spark, sf_dir)), file_name=None, parse_path=None), "doc_id")


@query("block_audit")
def block_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``clean_audit`` over the same documents: every stage has work."""
    return D.stage_audit(A.rich_documents(_docs(spark, sf_dir)), file_name=None, parse_path=None)


@query("image_refs")
def image_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK5: a reference row per stored image, inserted unless present (existing rows: every third file's)."""
    _, matched = _matched(spark, sf_dir)
    stored = matched.select("id", "file_uid", F.explode("names").alias("image_file"))
    candidates = stored.select("file_uid", "image_file")
    existing = stored.filter(F.col("id") % 3 == 0).select("file_uid", "image_file")
    return RP.insert_image_refs(existing, candidates.unionByName(candidates))
