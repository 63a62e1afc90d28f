import re
import time
from html import unescape

import numpy as np
import pytest

import __spark_entry__ as registry
from urlaudit.llm import html


@pytest.fixture(scope="module")
def field(spark):
    return html.fit(html.training_pages(html.sampled(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))))


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a < b) document.write("<p>no</p>")</script></head><body>
<header class="site"><nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav></header>
<div class="cookie-banner">We use cookies to make this better. <button>OK</button></div>
<main><h1>The   title &amp; more</h1><p>First paragraph of the story, with <b>bold</b> words,
and a second line.<p>Second paragraph, it has&nbsp;an <a href=x>inline link</a> too.</p>
<aside class="related"><p>Read this other story as well.</p></aside>
<div class="advert">Buy this now, it is cheap!</div><p title="a > b">Third paragraph, the last one of the story.</p>
<section id="comments"><h2>Comments</h2><p>I liked this story very much, thank you.</p></section></main>
<form><label>Mail</label><input name=m></form><footer>&copy; 2020 Somebody</footer><!-- end"""
TEXT = "The title & more\nFirst paragraph of the story, with bold words, and a second line.\nSecond paragraph, it has an inline link too.\nThird paragraph, the last one of the story."


def test_a_page_with_furniture(field):
    assert html.main_text(PAGE, field) == TEXT


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<!-- x", "</p></div>", "<script>var a = 1;", "<nav><a href=/>Home</a></nav>", "&amp", '<a title="x'])
def test_no_article(field, page):
    assert "\n" not in html.main_text(page, field)


def test_broken_markup_keeps_the_article(field):
    assert html.main_text("<html><body><article><h1>Some title of it<p>One paragraph of text, not closed.<div><p>Another one, in a box.</article><footer>x", field) == (
        "Some title of it\nOne paragraph of text, not closed.\nAnother one, in a box."
    )


def test_viterbi_is_the_best_of_all_labellings(field):
    blocks = html.leaf_blocks(PAGE)[:10]
    own = [sum(field.weights[f] for f in (*html.path_features(b.path), *html.text_features(b))) for b in blocks]

    def value(labels):
        total = field.first[labels[0]] + own[0] * labels[0]
        for k in range(1, len(labels)):
            total += field.turns[labels[k - 1]][labels[k]] + own[k] * labels[k]
        return total

    best = max((tuple((n >> k) & 1 for k in range(len(blocks))) for n in range(1 << len(blocks))), key=value)
    assert tuple(map(int, field.labels(blocks))) == best


def test_training_raises_the_likelihood_of_labels(field, spark):
    pages = html.training_pages(html.sampled(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")))
    wrong = sum(a != b for blocks, labels in pages for a, b in zip(field.labels(blocks), labels, strict=True))
    assert wrong < 0.01 * sum(len(blocks) for blocks, _ in pages)
    assert not np.any(html.fit([]).weights)


def article(page):
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = (" ".join(unescape(re.sub("<[^>]*>", " ", part)).split()) for part in re.split(r"</?(?:p|h1)>", inside))
    return "\n".join(part for part in parts if part)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    wanted = {row["page_id"]: article(row["html"]) for row in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = registry.queries()["op6_html_extraction"](spark, folder).collect()
    assert {row["page_id"]: row["text"] for row in rows} == wanted
    assert all(row["n_chars"] == len(row["text"]) for row in rows)


def test_odd_rows(spark, field):
    rows = [(1, PAGE, "a"), (1, PAGE, "b"), (2, None, None), (None, "", "c"), (3, "<article><p>" + "A long sentence of words. " * 20_000, "d")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = sorted((row["page_id"] or 0, row["text"]) for row in html.extract(df, field).collect())
    assert out == [(0, ""), (1, TEXT), (1, TEXT), (2, ""), (3, ("A long sentence of words. " * 20_000).strip())]
    assert html.extract(df.where("false"), field).count() == 0


@pytest.mark.parametrize("page", ["<div>" * 60_000 + "text", "<div>x " * 60_000, "<b> " * 60_000 + "<div>y", "<div>" * 30_000 + "</b></p></section>" * 30_000, "<b>" + "<div>" * 30_000 + "</b>z" * 30_000, "<div><section>x" * 40_000])
def test_a_megabyte_of_open_tags_takes_seconds(field, page):
    started = time.process_time()
    html.main_text(page, field)
    assert time.process_time() - started < 8


def test_paths_keep_what_their_features_say():
    blocks = html.leaf_blocks('<div class="nav"><article><div class="nav">a</div><p>b</p></article><div><div><div>c</div></div></div></div>')
    assert [b.path for b in blocks] == [("div nav", "article", "div nav"), ("div nav", "article", "p"), ("div nav", "div")]
    assert html.labelled(blocks) == [False, True, False]


def test_pages_without_article_elements_have_a_text():
    body = "This is paragraph {} of the story, it has quite some words, and it ends as sentences do."
    pages = [
        f'<html><body><div class="menu"><ul><li><a href=/>Home</a><li><a href=/x>More</a></ul></div><div id="content"><h1>Title {k}</h1>'
        + "".join(f"<p>{body.format(j)}</p>" for j in range(6)) + f'</div><div class="footer">© {k} Somebody</div></body></html>'
        for k in range(50)
    ]
    field = html.fit(html.training_pages(pages))
    found = [html.main_text(page, field) for page in pages]
    wanted = "\n".join(body.format(j) for j in range(6))
    assert all(wanted in text and "Home" not in text and "©" not in text for text in found)


def test_a_field_is_learned_from_any_table(field):
    for pages in ([], ["", "<p>"], ["<nav>a</nav>"]):
        own = html.fit(html.training_pages(pages))
        assert html.main_text("<html><body><article><h1>A title</h1><p>" + "Some words of a story, and more of them. " * 5 + "</p></article><footer>x</footer></body></html>", own)
