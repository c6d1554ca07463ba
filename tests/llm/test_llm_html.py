"""HTML extraction: composite text density, pruning, odd pages."""

import re
import html as H
import time

import pytest
from conftest import SF_SMALL

from hazardlake.llm.html_extract import extract_main_text, main_text, parse

LONG = "This is a long sentence of the article with many words in it and no link at all. " * 4


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("   ", ""), ("plain text only", "plain text only"),
    ("<p>a&amp;b &lt;x&gt; caf&eacute; &#233;&#x41;</p>", "a&b <x> café éA"),
    ("<div><p>one<b>two</b></p><p>three<br>four</p></div>", "onetwo three four"),
    ("<script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes</p>", "yes"),
    ("<p title='a > b'>text</p>", "text"), ("<p>unclosed <b>bold<p>next", "unclosed bold next"),
    ("<nav>menu</nav><p>yes</p><footer>end</footer><form>name</form><aside>side</aside>", "yes"),
    ("<div class='cookie-notice'>We use</div><div class=\"sidebar\">x</div><div role=navigation>y</div><p>yes</p>", "yes"),
    ("<div class='no-sidebar'><h1>T</h1><p>yes</p></div>", "T yes"),
    ("</p></div><p>stray</p></b>", "stray"), ("<p>a < b and c > d</p>", "a < b and c > d"),
])
def test_small_pages(page, want):
    assert main_text(page) == want


def test_article_with_noise_inside():
    page = (f"<html><head><title>t</title></head><body><header><h2>Site</h2></header><div class='wrap'><article>"
            f"<header><h1>Head</h1></header><p>{LONG}</p><div class='share'>Share <a href=x>now</a></div><p>{LONG}</p>"
            f"<section id='comments'><h2>Comments</h2><p>{LONG}</p></section></article></div></body></html>")
    assert main_text(page) == " ".join(("Head " + LONG + LONG).split())


def test_short_article_beside_unnamed_noise():
    page = "<body><div class='x'>Some odd line of text</div><article><p>Short body of the article here.</p></article></body>"
    assert main_text(page) == "Short body of the article here."
    assert main_text("<body><div class='page-header'>Site</div><article><div class='article-header'><h1>T</h1></div><p>x y</p></article>") == "T x y"


def test_density_picks_the_text_block_without_an_article_element():
    links = "".join(f"<li><a href='/{i}'>some link text number {i}</a></li>" for i in range(40))
    body = "".join(f"<p>{LONG}</p>" for _ in range(6))
    assert main_text(f"<body><div><ul>{links}</ul></div><div>{body}</div></body>") == " ".join((LONG * 6).split())


CARDS = "".join(f"<article><h3><a href='/{i}'>Teaser title number {i}</a></h3><p>Few words.</p></article>"
                for i in range(12))


@pytest.mark.parametrize("outer", ["main", "div"])
def test_text_spread_over_several_articles_without_teaser_cards(outer):
    parts = [f"<article><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></article>",
             f"<article><p>{LONG[:180]}</p><p>{LONG[:160]}</p></article>"]
    page = f"<body><{outer}>{''.join(parts)}<div class='grid'>{CARDS}</div></{outer}></body>"
    assert main_text(page) == " ".join((LONG * 3 + LONG[:180] + " " + LONG[:160]).split())


def test_an_article_elsewhere_does_not_replace_the_densest_block():
    body = "".join(f"<p>{LONG}</p>" for _ in range(6))
    page = f"<body><div><div>{body}</div></div><div><article><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></article></div></body>"
    assert " ".join((LONG * 6).split()) in main_text(page)


def test_main_bounds_but_does_not_decide():
    body = "".join(f"<p>{LONG}</p>" for _ in range(6))
    cards = CARDS.replace("article>", "div>")
    page = f"<body><main><h1>Title</h1><div>{body}</div><div>{cards}</div></main></body>"
    assert main_text(page) == " ".join(("Title " + LONG * 6).split())


def test_pages_without_their_article_tags(spark):
    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect():
        if r.html:
            plain = re.sub(r"(</?)article\b", r"\1div", r.html)
            assert main_text(plain) == main_text(r.html)


@pytest.mark.parametrize("attr", [
    "class='content no-sidebar'", "class='article-body ad-free'", "class='has-sidebar'", "class='social-sciences'",
    "id='search-engines'", "id='header-files'", "class='widget'"])
def test_class_names_prune_as_a_whole(attr):
    assert main_text(f"<h1>T</h1><div {attr}><p>{LONG}</p><p>{LONG}</p></div>").endswith("at all.") == (
        attr != "class='widget'")
    assert main_text(f"<div {attr}><p>{LONG}</p><p>{LONG}</p></div><div class='ad'>{LONG}</div>") == " ".join(
        (LONG * 2).split())


@pytest.mark.parametrize("noise", ["cookie-banner", "sidebar-left", "site-footer", "related posts", "x share-buttons"])
def test_compound_names_of_noise_still_prune(noise):
    assert main_text(f"<div><p>{LONG}</p></div><div class='{noise}'><p>Noise of the page</p></div>") == LONG.strip()


@pytest.mark.parametrize("page,want", [
    ("<p>a <math><mi>x</mi></math> b</p>", "a x b"), ("<p>a <object>text</object> b</p>", "a text b"),
    ("<p>one <svg> path<p>two</p>", "one two"), ("<title>t<body><p>yes</p>", "yes"),
    ("<noscript>no<div>yes</div>", "yes"), ("<p>yes</p><script>var a = '<p>no</p>'", "yes"),
])
def test_skipped_and_unclosed_elements(page, want):
    assert main_text(page) == want


def test_deep_and_long_pages():
    assert main_text("<div>" * 50_000 + "deep") == "deep"
    assert len(main_text("<p>" + "word " * 400_000 + "</p>")) == 400_000 * 5 - 1


def test_all_pages(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r.page_id: r for r in extract_main_text(pages.withColumn("text", pages.url)).collect()}
    for r in pages.collect():
        a = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S).group(1)
        a = re.sub(r"<[^>]*>", "", re.sub(r"<(/?)(p|h1|br)\b[^>]*>", " ", a))
        want = " ".join(H.unescape(a).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


def test_null_rows(spark):
    df = spark.createDataFrame([(None, None, None), (1, "u", "<p>x</p>")], "page_id long, url string, html string")
    assert sorted((r.text, r.n_chars) for r in extract_main_text(df).collect()) == [("", 0), ("x", 1)]
    assert extract_main_text(df.where("false")).count() == 0


@pytest.mark.parametrize("page", [
    "<b>" * 80_000 + "</i>" * 150_000, '<a "' * 250_000, '<a " > "' * 120_000, "<b>" * 100_000 + "<h2>" * 100_000,
    "<p><li>" * 80_000 + "<h2>" * 80_000, "</" * 400_000, "<a " + "x" * 1_000_000 + ">", "<svg>" * 200_000,
    "<script></script" * 60_000 + ">", "<!-" * 300_000 + "<!--"])
def test_megabytes_of_broken_markup_are_parsed_in_linear_time(page):
    start = time.perf_counter()
    parse(page)
    assert time.perf_counter() - start < 15   # minutes to hours where each tag looks at all others


def test_tags_behind_an_unclosed_quote():
    assert main_text('<p>One two three <a title="x>four</a> five.</p><p>Six <b id=\'y>seven</b> eight nine.</p>') == (
        "One two three four five. Six seven eight nine.")
    assert main_text("<p>One two</b> three</i> four <x 'y") == "One two three four <x 'y"
    assert main_text('<!DOCTYPE html PUBLIC "a>b"><p>One two</p></a "><p>three four</p>') == "b\"> One two three four"
