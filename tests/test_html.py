import time

import pytest

from corpusloom.functions import html as hx
from corpusloom.operators import html
from pyspark.sql import functions as F
from tests.conftest import rows

LONG = " ".join(f"word{i}" for i in range(25))


def pages(spark, *htmls):
    return spark.createDataFrame(list(enumerate(htmls)), "page_id int, html string")


def test_filter(spark):
    df = spark.createDataFrame([
        (1, "<!DOCTYPE html><p>", "unknown"), (2, "<!doctype html>", None), (3, "<p>", "text/html; charset=x"),
        (4, "<p>", "text/plain"), (5, "", "text/html"), (6, "\nx", "text/html"), (7, None, "text/html"),
    ], "id int, payload string, content_type string")
    assert [r[0] for r in rows(html.filter_html(df), "id")] == [1, 3, 6]
    assert [r[0] for r in rows(html.filter_html(df, content_type=None), "id")] == [1]


def test_title(spark):
    df = pages(
        spark, "<p>none", "<head lang=x><title>no</title></head>", "<HEAD><Title>A \"b\"\nc &amp;</title></head>",
        "<head><title></title></head>", "<head><title>a</title>", None,
    )
    assert [r[0] for r in sorted(html.extract_title(df).select("title", "page_id").collect(), key=lambda r: r[1])] == [
        "Unknown", "Unknown", "A 'b'c &amp;", "", "Unknown", "Unknown",
    ]


def texts(spark, page):
    return [r[1] for r in rows(html.html_blocks(pages(spark, page)), "pos", "txt")]


def test_blocks_drop_silent_elements_and_tags(spark):
    page = (
        "<html><head><title>t</title></head><script>if (a<b) x('</p>')</script><style>p{}</style><!-- no -->"
        "<p>one <b>bold</b> text<br>two<div>three<p>un<i>closed"
    )
    assert texts(spark, page) == ["one bold text", "two", "three", "unclosed"]


def test_unclosed_silent_elements_run_to_the_end(spark):
    assert texts(spark, "<p>a<script>b <p>c") == ["a"]
    assert texts(spark, "<p>a<!-- b <p>c") == ["a"]
    assert texts(spark, "<html><head><title>t</title><body><p>a") == ["a"]
    assert texts(spark, "<p>a<svg><p>b") == texts(spark, "<p>a<noscript><p>b") == texts(spark, "<p>a<head><p>b") == ["a"]


@pytest.mark.parametrize("unit", ["<svg>", "<noscript>", "<template>", "<head>", "<a ", "<b ", "<p ", "<script ", "<!--", "</a", "&amp"])
def test_linear_in_broken_pages(spark, unit):
    page = pages(spark, "<p>a</p>" + unit * (1_000_000 // len(unit)))
    both = html.extract_title(page).join(html.html_blocks(page), "page_id", "left")
    start = time.monotonic()
    assert both.select("title").first().title == "Unknown"
    assert html.html_blocks(page).select("txt").first().txt == "a"
    assert time.monotonic() - start < 6  # two runs on a busy machine; it took minutes


def test_title_is_linear_and_only_the_first_head_counts(spark):
    page = pages(spark, "<head>" * 100_000, "<head>" * 1000 + "<title>x</title>" + "<head>" * 100_000 + "</head>")
    start = time.monotonic()
    assert [r.title for r in html.extract_title(page).orderBy("page_id").collect()] == ["Unknown", "x"]
    assert time.monotonic() - start < 4


def test_entities(spark):
    page = "a &lt;b&gt; &amp;lt; &#233;&#xE9; &nbsp;x &bogus; & &#0; &#99999999; &AMP &aacute;&Oslash; &rarr; &frac12; &#0000000039;"
    assert texts(spark, page) == ["a <b> &lt; éé x &bogus; & &#0; &#99999999; &AMP áØ → ½ '"]


def test_newlines_are_blanks(spark):
    assert texts(spark, "<p>a\nb\r\n c</p>") == ["a b c"]


def test_link_density(spark):
    page = "<p>x <a href=q>one two</a> y<p><a>all</a><p>z <a>to <div>the</div> end</a> out<p><a>open<p>after"
    got = [(r[1], r[2], r[3]) for r in rows(html.html_blocks(pages(spark, page)), "pos", "txt", "nw", "ld")]
    assert got == [
        ("x one two y", 4, 0.5), ("all", 1, 1.0), ("z to", 2, 0.5), ("the", 1, 1.0), ("end out", 2, 0.5),
        ("open", 1, 1.0), ("after", 1, 0.0),
    ]


def test_rule_values(spark):
    cases = [
        (17, 0.0, 0, 0.0, 0, True), (16, 0.0, 0, 0.0, 0, False), (1, 0.0, 5, 0.0, 0, True),
        (1, 0.0, 0, 0.0, 16, True), (50, 0.34, 0, 0.0, 0, False), (30, 1 / 3, 9, 0.6, 0, False),
        (41, 0.0, 9, 0.6, 0, True), (1, 0.0, 9, 0.6, 18, True),
    ]
    df = spark.createDataFrame(cases, "nw int, ld double, pnw int, pld double, nnw int, want boolean")
    got = df.withColumn("got", hx.is_content(*[F.col(c) for c in ("nw", "ld", "pnw", "pld", "nnw")]))
    assert got.where("got <> want").count() == 0


def test_article_equals_classified_blocks(spark):
    menu = "<ul>" + "".join(f"<li><a>item {i}</a></li>" for i in range(5)) + "</ul>"
    df = pages(spark, f"{menu}<p>{LONG}</p><p>short one</p>{menu}", menu, "", f"<p>{LONG}<p>{LONG}")
    flat = html.block_classify(html.html_blocks(df)).where("content")
    joined = {}
    for page, pos, txt in rows(flat, "page_id", "pos", "txt"):
        joined.setdefault(page, []).append(txt)
    assert dict(rows(html.article_text(df))) == {p: "\n".join(t) for p, t in joined.items()}
    assert set(joined) == {0, 3}


def test_article_shuffles_nothing(spark):
    plan = html.article_text(pages(spark, "a"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
