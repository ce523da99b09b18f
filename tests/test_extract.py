"""Page classification and the extraction rule sets on hand-written HTML fixtures."""
import json

from pyspark.sql import functions as F

from quire.operators.extract import article_rows
from quire.operators.html_nodes import parse_nodes
from quire.plans.articles import classify_pages, route_pages
from quire.sources.registry import default_registry

BODY = " ".join(["This is a sentence of real article text that keeps going."] * 12)  # > 500 chars


def page_df(spark, pages):
    rows = [(i, u, h, None, None, None, None) for i, (u, h) in enumerate(pages)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, content_type string, "
                                       "feed_author string, feed_summary string, fetched_at timestamp")


def classify(spark, pages, registry=None):
    return classify_pages(route_pages(page_df(spark, pages), registry or default_registry()))


def articles(spark, pages):
    c = classify(spark, pages)
    return {r.url: r for r in article_rows(c.where(F.col("is_article_page")), "2026-01-01T00:00:00Z").collect()}


def ld(obj):
    return f'<script type="application/ld+json">{json.dumps(obj)}</script>'


def test_node_tree_rules():
    nodes, err = parse_nodes("<article><p><b>bold<br><p>direct <a href='/x'>l</a> tail</p></article><script>var a='</p>'</script>")
    assert err is None
    p_texts = [n["text"] for n in nodes if n["t"] and n["tag"] == "p"]
    assert p_texts == ["direct ", " tail"]  # text inside <b> and <a> is not a direct text node of p
    assert not any(n["t"] and n["tag"] == "script" for n in nodes)


#: One page for each branch of the page tests: (URL, head and body, is it an article page).
BRANCHES = [
    # generic: the URL must be an article's, and the page or the path must say so
    ("https://gazette.example/harbour/ferry-to-the-islands-runs-again", ('<meta property="og:type" content="article">', "<p>Ferry</p>"), True),
    ("https://gazette.example/harbour/lighthouse-keeper-for-one-summer", ('<meta property="og:type" content="website">', "<p>Keeper</p>"), False),
    ("https://gazette.example/harbour/the-last-salt-boat-of-the-coast", ("", "<article>Salt</article>"), True),
    ("https://gazette.example/harbour/nets-drying-in-the-morning-sun", ("", '<div class="x article-body">Nets</div>'), True),
    ("https://gazette.example/harbour/nets-drying-in-the-evening-sun", ("", '<span class="article-body">Nets</span>'), False),
    ("https://gazette.example/harbour/a-chart-of-every-known-reef", ("", '<section itemtype="https://schema.org/NewsArticle">Reefs</section>'), True),
    ("https://gazette.example/harbour/two-pilots-and-one-tide", (ld([{"@type": "Person"}, {"@type": "Article"}]), ""), True),
    ("https://gazette.example/harbour/two-pilots-and-no-tide-at-all", (ld({"@type": "Event"}), ""), False),
    ("https://gazette.example/articles/mooring", ("", "<p>Mooring</p>"), True),
    ("https://gazette.example/2025/07/14/regatta", ("", "<p>Regatta</p>"), True),
    ("https://gazette.example/tag/regatta", ('<meta property="og:type" content="article">', "<article>All of them</article>"), False),
    # outlets: their own mark is enough, whatever the URL
    ("https://apnews.com/hub/harbours", ('<meta property="og:type" content="article">', ""), True),
    ("https://apnews.com/article/harbours-0a1b2c", ("", ""), True),
    ("https://apnews.com/hub/islands", ("", "<article>Islands</article>"), False),
    ("https://www.bbc.com/harbours", ("", "<article>Harbours</article>"), True),
    ("https://www.bbc.com/islands", ("", "<section>Islands</section>"), False),
    ("https://www.cnn.com/harbours", ("", None, 'data-page-type="article_leaf"'), True),
    ("https://www.cnn.com/islands", ('<meta property="og:type" content="article">', None, 'data-page-type="section"'), False),
    ("https://www.foxnews.com/harbours", ("", None, 'class="fn article-single wide"'), True),
    ("https://www.foxnews.com/islands", ("", None, 'class="fn category"'), False),
]


def test_page_tests(spark):
    pages = []
    for url, (head, body, *attrs), _ in BRANCHES:
        pages.append((url, f"<html><head>{head}</head><body {attrs[0] if attrs else ''}>{body or 'Some text'}</body></html>"))
    got = {r.url: r.is_article_page for r in classify(spark, pages).collect()}
    assert got == {url: want for url, _, want in BRANCHES}


def test_content_type_reject_and_confidence_check(spark, monkeypatch):
    url, (head, _), _ = BRANCHES[0]
    html = f"<html><head>{head}</head></html>"
    df = route_pages(page_df(spark, [(url, html)]).withColumn("content_type", F.lit("application/xhtml+xml")),
                     default_registry())
    assert classify_pages(df).first().is_article_page is False
    from dataclasses import replace
    import pytest
    from quire.operators.rule_sets import RULE_SETS, register
    with pytest.raises(ValueError, match="between 0.0 and 1.0"):
        register(replace(RULE_SETS["cnn"], ladder=([(("body",), None, 1.5)], 0.6, None)))
    assert RULE_SETS["cnn"].ladder[1] == 0.6


def test_site_extractions(spark):
    ap = ("https://apnews.com/article/harbour-masters-meet-77aa",
          "<html><head>" + ld([{"@type": "NewsArticle", "headline": " AP  Head ", "author": [{"name": "A One"}, "B Two"],
                                "datePublished": "2026-01-29T12:00:00-05:00", "keywords": "x, y,,z"}]) +
          f'</head><body><div class="RichTextStoryBody"><p>{BODY}</p><p>  </p></div></body></html>')
    bbc = ("https://www.bbc.com/news/world-70010203",
           f'<html><body><h1>BBC title</h1><time datetime="2026-01-02">x</time><div class="byline-x">By Z</div>'
           f'<article><p>{BODY}</p></article></body></html>')
    cbs = ("https://www.cbsnews.com/news/harbour-masters-meet/",
           "<html><head>" + ld({"@type": "Article", "headline": "CBS", "articleBody": "  full   body text  "}) + "</head></html>")
    cnn = ("https://www.cnn.com/2025/07/14/harbour-masters-meet/index.html",
           f'<html><body><h1>CNN</h1><span data-testid="byline">Reporter</span><p>{BODY}</p></body></html>')
    fox = ("https://www.foxnews.com/politics/harbour-masters-meet-again",
           f'<html><body class="fn article-single"><h1>Fox</h1><div class="article-body"><p>WATCH: promo</p>'
           f'<p>SHORT</p><p>{BODY}</p></div></body></html>')
    guardian = ("https://www.theguardian.com/world/2025/jul/14/harbour-masters-meet",
                f'<html><head><meta property="og:type" content="article"></head><body><h1>G</h1>'
                f'<a rel="author">Writer</a><div itemprop="articleBody"><p>{BODY}</p></div></body></html>')
    nbc = ("https://www.nbcnews.com/news/harbour-masters-meet-rcna70010",
           '<html><body><article><h1>NBC</h1><p>Sign up for the newsletter please now</p><p>tiny</p></article></body></html>')
    out = articles(spark, [ap, bbc, cbs, cnn, fox, guardian, nbc])
    a = out[ap[0]]
    assert (a.title, a.author, a.extraction_method, a.published_at) == ("AP Head", "A One, B Two", "hybrid", "2026-01-29T17:00:00Z")
    assert a.parse_ok and a.parse_error is None and a.author_source == "hybrid"
    b = out[bbc[0]]
    assert (b.title, b.author, b.published_at, b.extraction_method) == ("BBC title", "By Z", "2026-01-02T00:00:00Z", "dom")
    c = out[cbs[0]]
    assert (c.text, c.extraction_method, c.parse_ok) == ("full body text", "jsonld_full", False)
    assert c.parse_error == "Text too short or missing: 14 < 250"
    n = out[cnn[0]]
    assert (n.author, n.extraction_method, n.parse_ok) == ("Reporter", "dom", True)
    assert n.parse_error == "JSON-LD not found, using DOM extraction only"
    f = out[fox[0]]
    assert f.text == BODY and f.parse_ok
    g = out[guardian[0]]
    assert (g.author, g.extraction_method) == ("Writer", "dom")
    nb = out[nbc[0]]
    # every paragraph is filtered out, so the unfiltered list is used
    assert nb.text == "Sign up for the newsletter please now tiny" and not nb.parse_ok


def test_failure_row_for_non_string_date(spark):
    cnn = ("https://www.cnn.com/2025/07/14/tide/index.html",
           "<html><body data-page-type='article'>" + ld({"@type": "NewsArticle", "headline": "H", "datePublished": 20260101})
           + f"<p>{BODY}</p></body></html>")
    r = articles(spark, [cnn])[cnn[0]]
    assert not r.parse_ok and r.parse_error == "Extractor failed: 'int' object has no attribute 'strip'"
    assert r.title is None and r.extraction_method == "extractor" and r.author_source == "missing"


def test_generic_path(spark):
    url = "https://example.com/articles/some-story"
    html = (f'<html><head><meta name="byl" content="By Jane Doe"></head><body><article><h1>Gen</h1><p>{BODY}</p>'
            f'</article></body></html>')
    short = "https://example.com/articles/short"
    r = articles(spark, [(url, html), (short, "<html><body><article><h1>T</h1><p>tiny</p></article></body></html>")])
    assert (r[url].author, r[url].author_source, r[url].extraction_method, r[url].parse_ok) == ("Jane Doe", "meta", "newspaper3k", True)
    assert r[short].parse_error == "Content validation failed (too short or invalid)" and r[short].text is None


def test_jsonld_blocks(spark):
    from quire.functions import jsonld as J
    from quire.functions import selectors as S
    from quire.operators.html_nodes import add_nodes
    html = ("<html><head>"
            '<script type="application/ld+json">[{"@type": "Article", "headline": "A"}, 5, "x", {"@type": "Person"}]</script>'
            '<script type="application/ld+json">{broken</script>'
            '<script type="application/ld+json">{"@graph": [{"@type": "NewsArticle"}]}</script>'
            '<script type="application/ld+json">{"@type": ["NewsArticle"], "headline": "L"}</script>'
            '<script type="text/javascript">{"@type": "NewsArticle"}</script>'
            "</head></html>")
    df = add_nodes(page_df(spark, [("https://x.com/a", html)]).select("page_id", "url", "html"))
    bs = J.blocks(S.ld_scripts().column())
    r = df.select(F.size(S.ld_scripts().column()).alias("scripts"), F.size(bs).alias("blocks"),
                  F.size(J.article_blocks(bs)).alias("articles")).first()
    # 4 ld+json scripts; blocks: 2 objects of the array + the @graph object + the list-typed one
    assert (r.scripts, r.blocks, r.articles) == (4, 4, 1)
