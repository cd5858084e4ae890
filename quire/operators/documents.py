"""Document cleaning job and the extraction tables of the same text (C1-C21, AGG6, AGG9, PRJ4).

``clean_documents`` applies the stages of ``quire.functions.clean`` in the reference's order, one projection per
stage, so each stage reads the previous text once as a column. All stages are row-local: the job is a single
narrow map over the documents (no shuffle); only the optional audit aggregates, by ``source``, with partial
aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import clean as C

TEXT = "_text"


def _stage_columns(record_id: Column, markdown_path: Column, name: Column, heading_mode: str):
    return [
        ("C1", C.c1_line_endings),
        ("C2", C.c2_drop_header),
        ("C3", C.c3_entities),
        ("C4", C.c4_tables),
        ("C6", C.c6_comments),
        ("C7", C.c7_toc_anchors),
        ("C8", C.c8_html_images),
        ("C9", C.c9_line_breaks),
        ("C10", C.c10_noise_tags),
        ("C11", C.c11_paragraphs),
        ("C12", C.c12_all_tags),
        ("C13", C.c13_garbage),
        ("C14", C.c14_passes()),
        ("C15", lambda s: C.c15_image_refs(s, record_id, markdown_path)),
        ("C17", C.c17_steps(heading_mode)),
        ("C18", C.c18_page_lines),
        ("C19", C.c19_blank_runs),
        ("C20", lambda s: C.c20_finish(s, name)),
    ]


def clean_documents(docs: DataFrame, text: str = "markdown", id_col: str | None = "id",
                    file_name: str | None = "file_name", original_path: str | None = "original_path",
                    parse_path: str | None = "parse_path", heading_mode: str = "reference",
                    out: str = "cleaned", until: str | None = None, keep_stages: bool = False) -> DataFrame:
    """Clean ``text`` into ``out`` for every row.

    ``until`` stops before the named stage (used by the extraction of removed lines); ``keep_stages`` keeps the text
    after every stage as ``_after_<stage>`` (used by the audit).
    """

    def col(name):
        return F.col(name) if name and name in docs.columns else F.lit(None).cast("string")

    record_id = F.col(id_col) if id_col and id_col in docs.columns else F.lit(None).cast("bigint")
    name = C.metadata_name(col(file_name), col(original_path), col(parse_path))
    df = docs.withColumn(TEXT, F.col(text))
    for stage, fn in _stage_columns(record_id, col(parse_path), name, heading_mode):
        if until == stage:
            break
        for step in fn if isinstance(fn, list) else [fn]:
            df = df.withColumn(TEXT, step(F.col(TEXT)))
        if keep_stages:
            df = df.withColumn(f"_after_{stage}", F.col(TEXT))
    return df.withColumnRenamed(TEXT, out)


def stage_audit(docs: DataFrame, text: str = "markdown", group: str = "source", **kwargs) -> DataFrame:
    """Per stage and group: documents changed and characters removed by the stage (one aggregate pass)."""
    stages = [s for s, _ in _stage_columns(F.lit(None), F.lit(None), F.lit(""), "reference")]
    cleaned = clean_documents(docs, text=text, keep_stages=True, **kwargs)
    prev = [F.col(text)] + [F.col(f"_after_{s}") for s in stages[:-1]]
    rows = F.array(*[
        F.struct(F.lit(s).alias("stage"), (p != F.col(f"_after_{s}")).alias("changed"),
                 (F.length(p) - F.length(F.col(f"_after_{s}"))).alias("removed"))
        for s, p in zip(stages, prev)
    ])
    per_stage = cleaned.select(F.col(group), F.inline(rows))
    return per_stage.groupBy(group, "stage").agg(
        F.count_if(F.col("changed")).alias("docs_changed"), F.sum("removed").cast("bigint").alias("chars_removed")
    )


def doc_images(docs: DataFrame, id_col: str = "id", text: str = "markdown") -> DataFrame:
    """C21/AGG6: the images of the raw text, ``(doc, pos, name, path, syntax)``, distinct by name."""
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(C.image_entries(F.col(text))).alias("pos", "e")).select(
        "doc_id", "pos", "e.name", "e.path", "e.syntax")


def doc_tables(docs: DataFrame, id_col: str = "id", text: str = "markdown") -> DataFrame:
    """Cells of every HTML table, as the table rule sees them (after C1-C3), ``(doc, table, row, col, cell)``.

    Ragged rows are padded with '' to the table width (AGG9: the longest row), as in the pipe table.
    """
    staged = clean_documents(docs, text=text, id_col=id_col, until="C4", out="_staged")
    tables = staged.select(
        F.col(id_col).alias("doc_id"),
        F.posexplode(F.regexp_extract_all(F.col("_staged"), F.lit(C.TABLE), 0)).alias("table_no", "table"),
    )
    rows = tables.select("doc_id", "table_no", C.table_rows(F.col("table")).alias("rows"))
    rows = rows.withColumn("width", F.array_max(F.transform("rows", lambda r: F.size(r))))
    cells = rows.select("doc_id", "table_no", "width", F.posexplode("rows").alias("row_no", "cells"))
    padded = F.concat(F.col("cells"), F.array_repeat(F.lit(""), F.col("width") - F.size("cells")))
    return cells.select("doc_id", "table_no", "row_no", F.posexplode(padded).alias("col_no", "cell"))


def removed_lines(docs: DataFrame, id_col: str = "id", text: str = "markdown", **kwargs) -> DataFrame:
    """The lines C18 drops, ``(doc, line_no, line)``, numbered within the text C18 receives."""
    staged = clean_documents(docs, text=text, id_col=id_col, until="C18", out="_staged", **kwargs)
    lines = staged.select(
        F.col(id_col).alias("doc_id"), F.posexplode(F.split(F.col("_staged"), "\n", -1)).alias("line_no", "line")
    )
    return lines.filter(F.col("line").rlike(C.page_line_matcher()))


def clean_record_from_parse(parse_results: DataFrame) -> DataFrame:
    """PRJ4: clean-input rows from parse results (``file_type`` -> ``file_ext``, ``absolute_path`` ->
    ``original_path``)."""
    return parse_results.select(
        "id", "file_uid", "file_name", F.col("file_type").alias("file_ext"),
        F.col("absolute_path").alias("original_path"), F.col("markdown_content").alias("markdown"),
    )
