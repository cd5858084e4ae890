"""Document cleaning stages C1-C20 and the extraction helpers of C21/AGG6, as column expressions.

Each stage is a ``Column -> Column`` function that restates one text rule of the reference with Java regular
expressions written against Python's character classes (see ``quire.functions.text``). Stages whose replacement
depends on the match (HTML tables, image references) take all matches with ``regexp_extract_all``, the pieces
between them with ``split`` (same Java matcher, so they line up), rewrite the matches with ``transform`` and
interleave with ``zip_with``. Only C3 (the full HTML5 entity table) runs in Python, as an Arrow-batched pandas UDF
that receives only the values containing '&'.

Stages must run in order (entity decoding before tag removal, emphasis before image rewriting); apply them one
projection at a time (``quire.operators.documents``) so every stage reads its input as a column, once.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from quire.functions.paths import path_name
from quire.functions.text import DIGIT, NOT_WS, WORD, WS, let, py_rstrip, py_strip

# White space other than LF (for rules that work line by line inside one string).
HWS = r"[\p{IsWhite_Space}\x1c-\x1f&&[^\n]]"
NOT_WS_GT = r"[^\"'\p{IsWhite_Space}\x1c-\x1f>]"

# Fixed patterns of the reference's cleaning rules (Python syntax restated for Java; \s -> WS, \w -> WORD).
MD_IMAGE = r"!\[([^\]]*)]\(([^)]+)\)"
HTML_IMAGE = r"(?i)<img\b[^>]*\bsrc" + WS + r"*=" + WS + r"*(?:\"([^\"]*)\"|'([^']*)'|(" + NOT_WS_GT + r"+))[^>]*>"
TOC_ANCHOR = r"(?i)<a" + WS + r"+[^>]*(?:id|name)=[\"']?_Toc[^>]*>" + WS + r"*</a>"
HTML_COMMENT = r"(?s)<!--.*?-->"
NOISE_TAG = r"(?i)</?(?:a|span|div|u|font|strong|b|em|i|section|article|header|footer|center)\b[^>]*>"
PARAGRAPH_TAG = r"(?i)</?p\b[^>]*>"
CELL_OPEN_P = r"(?i)(<t[dh]\b[^>]*>)" + WS + r"*<p\b[^>]*>"
P_CLOSE_CELL = r"(?i)</p>" + WS + r"*(</t[dh]>)"
ANY_TAG = r"</?([a-zA-Z][a-zA-Z0-9]*)\b[^>]*>"
TABLE = r"(?is)<table\b[^>]*>.*?</table>"
TABLE_ROW = r"(?is)<tr\b[^>]*>.*?</tr>"
TABLE_CELL = r"(?is)<(td|th)\b[^>]*>(.*?)</\1>"
LINE_BREAK_TAG = r"(?i)<br\b[^>]*>|</p>|</div>|</section>|</article>"
ZERO_WIDTH_AND_GARBAGE = "\u200b\u200c\u200d\ufeff\x00\ufffd"
PAGE_LINE_BODY = (
    r"page" + HWS + r"+" + DIGIT + r"+(?:" + HWS + r"+of" + HWS + r"+" + DIGIT + r"+)?"
    r"|" + DIGIT + r"+" + HWS + r"*/" + HWS + r"*" + DIGIT + r"+"
    r"|-+" + HWS + r"*" + DIGIT + r"+" + HWS + r"*-+"
    r"|" + DIGIT + r"+"
)
PAGE_LINE = r"(?iu)" + HWS + r"*(?:" + PAGE_LINE_BODY + r")" + HWS + r"*"
HEADER_MARKERS = ("source_file_id:", "file_name:")
IMAGE_URL_ROOT = "/images/"


# ------------------------------------------------------------------------------------------------ helpers


def rewrite_matches(s: Column, pattern: str, fn, guard: str | None = None, prefilter: str | None = None) -> Column:
    """Replace every match of ``pattern`` in ``s`` by ``fn(match)`` (a Column function of the matched text)."""

    def body(v):
        matches = F.regexp_extract_all(v, F.lit(pattern), 0)
        pieces = F.split(v, pattern, -1)
        tail = F.zip_with(F.transform(matches, fn), F.slice(pieces, 2, F.size(pieces)), lambda r, p: F.concat(r, p))
        return F.concat(F.element_at(pieces, 1), F.array_join(tail, ""))

    rewritten = let(s, body)
    cond = s.rlike(guard if guard else pattern)
    if prefilter is not None:
        cond = s.contains(prefilter) & cond
    return F.when(cond, rewritten).otherwise(s)


def percent_decode(c: Column) -> Column:
    """``urllib.parse.unquote``: '+' and a '%' that no two hex digits follow stay as they are."""
    escaped = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(escaped), c)


def clean_image_path(c: Column) -> Column:
    """Strip, backslashes to slashes, blanks to %20."""
    return F.replace(F.replace(py_strip(c), F.lit("\\"), F.lit("/")), F.lit(" "), F.lit("%20"))


def image_name(path: Column) -> Column:
    """Percent-decoded base name of the part before the first '?' or '#'."""
    return percent_decode(py_strip(path_name(F.regexp_extract(path, r"^([^#?]*)", 1))))


def html_image_path(match: Column) -> Column:
    """First non-empty quoted or bare ``src`` value of an ``<img>`` match."""
    groups = [F.regexp_extract(match, HTML_IMAGE, i) for i in (1, 2, 3)]
    return F.coalesce(*[F.nullif(g, F.lit("")) for g in groups], F.lit(""))


def html_image_to_markdown(match: Column) -> Column:
    """C8 on one match: ``![name](path)``, or '' when the path is empty."""

    def build(path):
        return F.when(path != "", F.concat(F.lit("!["), image_name(path), F.lit("]("), path, F.lit(")"))).otherwise(
            F.lit("")
        )

    return let(clean_image_path(html_image_path(match)), build)


# ------------------------------------------------------------------------------------------------ stages


def _guard(s: Column, test: Column, value: Column) -> Column:
    """``value`` where ``test`` holds, else ``s`` unchanged (CASE WHEN evaluates only the chosen branch)."""
    return F.when(test, value).otherwise(s)


def c1_line_endings(s: Column) -> Column:
    return _guard(s, s.contains("\r"), F.replace(F.replace(s, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")))


def c2_drop_header(s: Column) -> Column:
    """Drop a leading ``---`` block that already carries our metadata keys (cleaning is re-runnable)."""
    end = F.locate("\n---\n", s, 5)
    header = F.substring(s, F.lit(1), end + 4)
    marked = header.contains(HEADER_MARKERS[0]) | header.contains(HEADER_MARKERS[1])
    return F.when(s.startswith("---\n") & (end > 0) & marked, F.substring(s, end + 5, F.length(s))).otherwise(s)


@pandas_udf(StringType())
def _unescape(values: pd.Series) -> pd.Series:
    return values.map(html.unescape, na_action="ignore")


# The optimizer merges projections that a Python UDF reads from, copying the text rules before it into every mention:
# two cleanings in one plan never end planning. It merges nothing across a UDF that is declared nondeterministic.
_unescape = _unescape.asNondeterministic()


def c3_entities(s: Column) -> Column:
    """HTML entities decoded once (full HTML5 table), then NBSP to blank. Only values with '&' go to Python."""
    decoded = F.coalesce(_unescape(F.when(s.contains("&"), s)), s)
    return F.replace(decoded, F.lit("\xa0"), F.lit(" "))


def clean_table_cell(cell: Column) -> Column:
    """Images to Markdown, breaks to blanks, tags removed, white space collapsed and stripped, pipes escaped."""
    c = rewrite_matches(cell, HTML_IMAGE, html_image_to_markdown, guard=r"(?i)<img")
    c = F.regexp_replace(c, LINE_BREAK_TAG, " ")
    c = F.regexp_replace(c, ANY_TAG, "")
    c = py_strip(F.regexp_replace(c, WS + "+", " "))
    return F.replace(c, F.lit("|"), F.lit("\\|"))


def table_rows(table: Column) -> Column:
    """Rows of cleaned cells of one HTML table; rows without cells are dropped."""
    rows = F.transform(
        F.regexp_extract_all(table, F.lit(TABLE_ROW), 0),
        lambda r: F.transform(F.regexp_extract_all(r, F.lit(TABLE_CELL), 2), clean_table_cell),
    )
    return F.filter(rows, lambda r: F.size(r) > 0)


def _pipe_row(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))


def table_to_markdown(table: Column) -> Column:
    """C4 on one table: header row, '---' row, data rows, ragged rows padded; LF around; no rows -> ''."""

    def build(rows):
        width = F.array_max(F.transform(rows, lambda r: F.size(r)))
        padded = F.transform(rows, lambda r: F.concat(r, F.array_repeat(F.lit(""), width - F.size(r))))
        lines = F.concat(
            F.array(_pipe_row(F.element_at(padded, 1)), _pipe_row(F.array_repeat(F.lit("---"), width))),
            F.transform(F.slice(padded, 2, F.greatest(F.size(padded), F.lit(1))), _pipe_row),
        )
        return F.when(F.size(rows) == 0, F.lit("")).otherwise(
            F.concat(F.lit("\n"), F.array_join(lines, "\n"), F.lit("\n"))
        )

    return let(table_rows(table), build)


def c4_tables(s: Column) -> Column:
    return rewrite_matches(s, TABLE, table_to_markdown, guard=r"(?i)<table", prefilter="<")


def c6_comments(s: Column) -> Column:
    return _guard(s, s.contains("<!--"), F.regexp_replace(s, HTML_COMMENT, ""))


def c7_toc_anchors(s: Column) -> Column:
    return _guard(s, s.contains("_Toc"), F.regexp_replace(s, TOC_ANCHOR, ""))


def c8_html_images(s: Column) -> Column:
    return rewrite_matches(s, HTML_IMAGE, html_image_to_markdown, guard=r"(?i)<img", prefilter="<")


def c9_line_breaks(s: Column) -> Column:
    return _guard(s, s.contains("<"), F.regexp_replace(s, LINE_BREAK_TAG, "\n"))


def c10_noise_tags(s: Column) -> Column:
    return _guard(s, s.contains("<"), F.regexp_replace(s, NOISE_TAG, ""))


def c11_paragraphs(s: Column) -> Column:
    out = F.regexp_replace(s, CELL_OPEN_P, "$1")
    out = F.regexp_replace(out, P_CLOSE_CELL, "$1")
    return _guard(s, s.contains("<"), F.regexp_replace(out, PARAGRAPH_TAG, "\n"))


def c12_all_tags(s: Column) -> Column:
    return _guard(s, s.contains("<"), F.regexp_replace(s, ANY_TAG, ""))


def c13_garbage(s: Column) -> Column:
    """Zero-width marks, NUL and U+FFFD removed, NBSP to blank; then literal '\\_', then 'text_image', removed."""
    marks = "\xa0" + ZERO_WIDTH_AND_GARBAGE
    present = s.contains(marks[0])
    for ch in marks[1:]:
        present = present | s.contains(ch)
    out = _guard(s, present, F.translate(s, marks, " "))
    out = F.replace(out, F.lit("\\_"), F.lit(""))
    return F.replace(out, F.lit("text_image"), F.lit(""))


def c14_passes():
    """C14 as five passes (each a projection of its own): bold-italic, bold, italic '*', italic '_', strike.
    Spans may cross lines; code is not exempt. Each pass only runs on texts holding its marker."""
    star = r"(?s)(?<!\*)\*(?!" + WS + r")(.+?)(?<!" + WS + r")\*(?!\*)"
    under = r"(?s)(?<!" + WORD + r")_(?!" + WS + r")(.+?)(?<!" + WS + r")_(?!" + WORD + r")"
    return [
        lambda s: _guard(s, s.contains("***") | s.contains("___"), F.regexp_replace(s, r"(?s)(\*\*\*|___)(.+?)\1", "$2")),
        lambda s: _guard(s, s.contains("**") | s.contains("__"), F.regexp_replace(s, r"(?s)(\*\*|__)(.+?)\1", "$2")),
        lambda s: _guard(s, s.contains("*"), F.regexp_replace(s, star, "$1")),
        lambda s: _guard(s, s.contains("_"), F.regexp_replace(s, under, "$1")),
        lambda s: _guard(s, s.contains("~~"), F.regexp_replace(s, r"(?s)~~(.+?)~~", "$1")),
    ]


def c14_emphasis(s: Column) -> Column:
    """Bold/italic/strike markers removed (all passes in one expression; see ``c14_passes``)."""
    for step in c14_passes():
        s = step(s)
    return s


def _is_digits(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^" + DIGIT + r"+\z"), F.lit(False))


def image_file_id(path_part: Column, record_id: Column, markdown_path: Column) -> Column:
    """Parent folder if all digits; else the record id; else the Markdown stem if all digits; else ''."""
    comps = F.filter(F.split(path_part, "/"), lambda x: (x != "") & (x != "."))
    parent = F.when(F.size(comps) >= 2, percent_decode(F.element_at(comps, -2)))
    rid = py_strip(F.when(record_id.isNotNull() & (record_id.cast("string") != "0"), record_id.cast("string")))
    md_name = path_name(markdown_path)
    md_stem = py_strip(F.regexp_replace(md_name, r"(?s)^(.+)\.[^.]+\z", "$1"))
    return (
        F.when(_is_digits(parent), parent)
        .when(F.coalesce(rid, F.lit("")) != "", rid)
        .when(_is_digits(md_stem), md_stem)
        .otherwise(F.lit(""))
    )


def markdown_image_ref(match: Column, record_id: Column, markdown_path: Column) -> Column:
    """C15 on one match: ``![](/images/<fid>/<name><suffix>)``; no base name -> path kept; empty path -> ''."""

    def build(path):
        part = F.regexp_extract(path, r"^([^?#]*)", 1)
        suffix = F.substring(path, F.length(part) + 1, F.length(path))
        name = image_name(part)
        fid = image_file_id(part, record_id, markdown_path)
        target = (
            F.when(name == "", path)
            .when(fid != "", F.concat(F.lit(IMAGE_URL_ROOT), fid, F.lit("/"), name, suffix))
            .otherwise(F.concat(F.lit(IMAGE_URL_ROOT), name, suffix))
        )
        return F.when(target != "", F.concat(F.lit("![]("), target, F.lit(")"))).otherwise(F.lit(""))

    return let(clean_image_path(F.regexp_extract(match, MD_IMAGE, 2)), build)


def c15_image_refs(s: Column, record_id: Column, markdown_path: Column) -> Column:
    return rewrite_matches(s, MD_IMAGE, lambda m: markdown_image_ref(m, record_id, markdown_path), guard=r"!\[", prefilter="![")


def c17_steps(mode: str = "reference"):
    """C17 as three projections: right-strip every line; strip heading lines on the left; put a blank after the
    leading '#' run. ``mode='reference'`` keeps the reference's backtracking rule (``## T`` -> ``# # T``);
    ``'fixed'`` only splits a '#' run from a following non-'#' character."""
    if mode == "fixed":
        heading = r"(?md)^(#{1,6})([^#\p{IsWhite_Space}\x1c-\x1f])"
    else:
        heading = r"(?md)^(#{1,6})(" + NOT_WS + ")"
    return [
        lambda s: _guard(s, s.rlike(HWS + r"(?:\n|\z)"), F.regexp_replace(s, HWS + r"+(?=\n|\z)", "")),
        lambda s: _guard(s, s.contains("#"), F.regexp_replace(s, r"(?md)^" + HWS + r"+(?=#)", "")),
        lambda s: _guard(s, s.contains("#"), F.regexp_replace(s, heading, "$1 $2")),
    ]


def c17_headings(s: Column, mode: str = "reference") -> Column:
    """Right-strip every line; heading lines are stripped on both sides and get a blank after the '#' run."""
    for step in c17_steps(mode):
        s = step(s)
    return s


def c18_page_lines(s: Column) -> Column:
    """Drop lines that are only a page marker or only digits; a line goes with its LF."""
    s = F.regexp_replace(s, r"(?md)^" + PAGE_LINE + r"\n", "")
    return F.regexp_replace(s, r"(?:\A|\n)" + PAGE_LINE + r"\z", "")


def c19_blank_runs(s: Column) -> Column:
    out = _guard(s, s.contains(" \n") | s.contains("\t\n"), F.regexp_replace(s, r"[ \t]+\n", "\n"))
    return _guard(out, out.contains("\n\n\n"), F.regexp_replace(out, r"\n{3,}", "\n\n"))


def metadata_name(file_name: Column, original_path: Column, parse_path: Column) -> Column:
    """file_name, else base name of original_path, else of parse_path (each stripped); '' when none."""
    fn = py_strip(F.coalesce(file_name, F.lit("")))
    op = py_strip(F.coalesce(original_path, F.lit("")))
    pp = py_strip(F.coalesce(parse_path, F.lit("")))
    return (
        F.when(fn != "", fn).when(op != "", path_name(op)).when(pp != "", path_name(pp)).otherwise(F.lit(""))
    )


def c20_finish(s: Column, name: Column) -> Column:
    """Final strip, metadata header with the escaped name (none when there is no name), trailing LF."""
    body = py_strip(s)
    escaped = F.replace(F.replace(name, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    header = F.concat(F.lit('---\nfile_name: "'), escaped, F.lit('"\n---\n'))
    return F.when(name != "", F.concat(header, body, F.lit("\n"))).otherwise(F.concat(body, F.lit("\n")))


# ------------------------------------------------------------------------------------------------ extraction


def image_entries(raw: Column) -> Column:
    """AGG6: ``array<struct<name, path, syntax>>`` of the raw text's images, Markdown references first, then HTML ones;
    of entries with one name the first stays."""

    def entry(path, syntax):
        return F.struct(image_name(path).alias("name"), path.alias("path"), F.lit(syntax).alias("syntax"))

    md = F.transform(F.regexp_extract_all(raw, F.lit(MD_IMAGE), 2), lambda p: entry(p, "markdown"))
    tags = F.transform(F.regexp_extract_all(raw, F.lit(HTML_IMAGE), 0), lambda m: entry(html_image_path(m), "html"))
    named = F.filter(F.concat(md, tags), lambda e: e["name"] != "")
    return let(named, lambda all_: F.filter(all_, lambda e, i: F.array_position(F.transform(all_, lambda x: x["name"]), e["name"]) == i + 1))


def image_names(raw: Column) -> Column:
    """AGG6: the ordered distinct image names of the raw text."""
    return F.transform(image_entries(raw), lambda e: e["name"])


def page_line_matcher() -> str:
    """Pattern for one whole line removed by C18 (for ``rlike`` over single lines)."""
    return r"^" + PAGE_LINE + r"\z"


STAGES = (
    "c1_line_endings", "c2_drop_header", "c3_entities", "c4_tables", "c6_comments", "c7_toc_anchors",
    "c8_html_images", "c9_line_breaks", "c10_noise_tags", "c11_paragraphs", "c12_all_tags", "c13_garbage",
    "c14_emphasis", "c15_image_refs", "c17_headings", "c18_page_lines", "c19_blank_runs", "c20_finish",
)

__all__ = ["STAGES", "rewrite_matches", "image_names", "table_rows", "metadata_name", "py_rstrip"]
