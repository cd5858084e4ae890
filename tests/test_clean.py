"""Cleaning stages C1-C20 on the hand-written rows of FIXTURES.md section 6."""

import pytest
from pyspark.sql import functions as F

from quire.functions import clean as C
from quire.operators.documents import clean_documents, doc_images, doc_tables, removed_lines


def run(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(fn(F.col("s"))).collect()]


CASES = [
    (C.c1_line_endings, "a\r\nb\rc", "a\nb\nc"),
    (C.c2_drop_header, '---\nfile_name: "x"\n---\nb', "b"),
    (C.c2_drop_header, "---\ntitle: x\n---\nb", "---\ntitle: x\n---\nb"),
    (C.c3_entities, "&amp;lt; &copy; a&nbsp;b", "&lt; © a b"),
    (C.c6_comments, "x<!-- a\nb -->y", "xy"),
    (C.c7_toc_anchors, 'y<a id="_Toc1"></a>z', "yz"),
    (C.c8_html_images, "<img src='p/a b.png'>", "![a b.png](p/a%20b.png)"),
    (C.c8_html_images, '<img src="">', ""),
    (C.c13_garbage, "a​b� te\\_xt_image c", "ab  c"),
    (C.c14_emphasis, "***a*** **b\nc** *d* x_y_z _e_ ~~f~~ 2*3*4 * g", "a b\nc d x_y_z e f 234 * g"),
    (C.c19_blank_runs, "a  \n\n\n\nb", "a\n\nb"),
    (C.c18_page_lines, "Page 3 of 9\n3 / 9\n- 4 -\n12\n12 a", "12 a"),
    (C.c18_page_lines, "a\n12", "a"),
    (C.c18_page_lines, "12\n\n", "\n"),
    (lambda s: C.c17_headings(s), "#T", "# T"),
    (lambda s: C.c17_headings(s), "## T", "# # T"),
    (lambda s: C.c17_headings(s, "fixed"), "## T", "## T"),
    (lambda s: C.c17_headings(s), "  # U  ", "# U"),
    (lambda s: C.c17_headings(s), "x  \n  y  ", "x\n  y"),
]


@pytest.mark.parametrize("fn,value,expected", CASES)
def test_stage(spark, fn, value, expected):
    assert run(spark, fn, [value]) == [expected]


def test_tags_chain(spark):
    s = "<div>a</div><!DOCTYPE html><x-y>b</x-y>1 < 2"
    fn = lambda c: C.c12_all_tags(C.c11_paragraphs(C.c10_noise_tags(C.c9_line_breaks(c))))
    assert run(spark, fn, [s]) == ["a\n<!DOCTYPE html>b1 < 2"]


def test_table(spark):
    s = "<table><tr><th>h</th><th>i</th></tr><tr><td>a|b<br>c</td></tr></table>"
    assert run(spark, C.c4_tables, [s]) == ["\n| h | i |\n| --- | --- |\n| a\\|b c |  |\n"]
    assert run(spark, C.c4_tables, ["x<table><tr></tr></table>y"]) == ["xy"]


def test_image_refs(spark):
    df = spark.createDataFrame(
        [(1, "![alt](p/12/a%20b.png?x#y)", None), (7, "![](q.png)", None), (0, "![](q.png)", "/md/55.md")],
        "id bigint, s string, pp string",
    )
    out = [r[0] for r in df.select(C.c15_image_refs(F.col("s"), F.col("id"), F.col("pp"))).orderBy(F.col("id")).collect()]
    assert sorted(out) == sorted(["![](/images/12/a b.png?x#y)", "![](/images/7/q.png)", "![](/images/55/q.png)"])


def test_finish_header(spark):
    df = spark.createDataFrame([('q"\\.md', "b"), (None, "b")], "n string, s string")
    name = C.metadata_name(F.col("n"), F.lit(None).cast("string"), F.lit(None).cast("string"))
    out = [r[0] for r in df.select(C.c20_finish(F.col("s"), name)).collect()]
    assert out == ['---\nfile_name: "q\\"\\\\.md"\n---\nb\n', "b\n"]


def test_clean_documents_whole_chain(spark):
    md = "---\nfile_name: \"old\"\n---\r\n# Title\r\n\r\n**Bold** text&amp;more\n\n\n\nPage 2 of 3\n![x](img/5/a.png)\n"
    df = spark.createDataFrame([(9, "doc.pdf", "/share/doc.pdf", None, md)],
                               "id bigint, file_name string, original_path string, parse_path string, markdown string")
    out = clean_documents(df).select("cleaned").first()[0]
    assert out == '---\nfile_name: "doc.pdf"\n---\n# Title\n\nBold text&more\n\n![](/images/5/a.png)\n'


def test_extraction_tables(spark):
    md = ("![a](x/p1.png) <img src=\"y/p2.png\"> ![b](p1.png)\n"
          "<table><tr><td>h</td></tr><tr><td>a</td><td>b</td></tr></table>\n7\nkeep")
    df = spark.createDataFrame([(3, md)], "id bigint, markdown string")
    assert [(r.pos, r.name) for r in doc_images(df).collect()] == [(0, "p1.png"), (1, "p2.png")]
    cells = [(r.row_no, r.col_no, r.cell) for r in doc_tables(df).orderBy("row_no", "col_no").collect()]
    assert cells == [(0, 0, "h"), (0, 1, ""), (1, 0, "a"), (1, 1, "b")]
    assert [r.line for r in removed_lines(df).collect()] == ["7"]


def test_percent_decoding_equals_python(spark):
    from urllib.parse import unquote

    from quire.functions.clean import percent_decode

    values = ["100%25 50%.png", "a%20b%.png", "%zz%20.png", "a+b%2Bc", "%C3%A9%2", "plain", "%%41%", "%E4%B8%AD"]
    got = spark.createDataFrame([(v,) for v in values], "v string").select("v", percent_decode(F.col("v")).alias("d")).collect()
    assert {r.v: r.d for r in got} == {v: unquote(v) for v in values}


def test_two_cleanings_in_one_plan(spark):
    """A cleaned text can be cleaned again without a checkpoint between: planned at once, and idempotent."""
    import time

    df = spark.createDataFrame([(1, "a <b>x</b> &amp;amp; y\n\n\n\nPage 3\nz", "/a/b.txt")], "id long, markdown string, original_path string")
    one = clean_documents(df, file_name=None, parse_path=None).select("id", F.col("cleaned").alias("markdown"), "original_path")
    began = time.time()
    two = clean_documents(one, file_name=None, parse_path=None)
    two._jdf.queryExecution().executedPlan()
    assert time.time() - began < 10
    assert two.first().cleaned.startswith('---\nfile_name: "b.txt"\n---\n')
