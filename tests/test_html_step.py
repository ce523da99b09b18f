"""The node step on broken markup, and what must not be lost: failure rows, JSON-LD, given summaries."""
import json

from pyspark.sql import functions as F

from quire.operators.extract import article_rows
from quire.operators.html_nodes import parse_nodes, plain_json
from quire.plans.articles import classify_pages, route_pages
from quire.sources.registry import Source, default_registry

LINE = "This is a sentence of real article text that keeps going. " * 12


def texts(html, tag):
    return [n["text"] for n in parse_nodes(html)[0] if n["t"] and n["tag"] == tag]


def rows(spark, pages, registry=None):
    df = spark.createDataFrame([(i, u, h, None, None, s, None) for i, (u, h, s) in enumerate(pages)],
                               "page_id long, url string, html string, content_type string, feed_author string, "
                               "feed_summary string, fetched_at timestamp")
    c = classify_pages(route_pages(df, registry or default_registry()))
    return {r.url: r for r in article_rows(c.where(F.col("is_article_page")), "2026-01-01T00:00:00Z").collect()}


def test_text_runs_are_one_node():
    assert texts("<p>AT&T paid 5 < 6 dollars & a <3 b</p>", "p") == ["AT&T paid 5 < 6 dollars & a <3 b"]
    assert texts("<p>a<!-- c -->b</p>", "p") == ["a", "b"]


def test_table_rows_are_siblings():
    nodes = parse_nodes("<table><tr><td>a<tr><td>b<table><tr><td>c</table><td>d</table>")[0]
    trs = [n for n in nodes if n["tag"] == "tr" and not n["t"]]
    assert trs[0]["parent"] == trs[1]["parent"] == 1 and trs[2]["parent"] != 1
    assert texts("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>", "li") == ["a", "b", "c", "d"]


def test_nodes_stay_linear():
    nodes = parse_nodes("<font>x" * 4000)[0]
    assert len(nodes) == 8000 and all(isinstance(n["parent"], int) for n in nodes)


def test_marked_sections_are_comments():
    nodes, error = parse_nodes("<p>a</p><![foo bar]><p>b</p>")
    assert error is None and texts("<p>a</p><![foo bar]><p>b</p>", "p") == ["a", "b"]


def test_unparsable_page_keeps_its_failure_row(spark):
    from quire.operators.extract import add_page_flag
    df = spark.createDataFrame([(1, "https://www.bbc.com/news/articles/c123456789o", None, None, None, None, None),
                                (2, "https://www.bbc.com/news", None, None, None, None, None)],
                               "page_id long, url string, html string, content_type string, feed_author string, "
                               "feed_summary string, fetched_at timestamp")
    c = classify_pages(route_pages(df, default_registry())).drop("is_article_page")
    c = c.withColumn("parse_error", F.lit("broken markup"))
    failed = article_rows(add_page_flag(c).where("is_article_page"), "2026-01-01T00:00:00Z").collect()
    assert [(x.page_id, x.parse_ok, x.text, x.parse_error.endswith("broken markup")) for x in failed] == [(1, False, None, True)]


def test_json_ld_repeated_keys_and_nan(spark):
    assert json.loads(plain_json('{"a": 1, "a": NaN, "b": {"c": 1, "c": 2}}')) == {"a": "nan", "b": {"c": 2}}
    assert plain_json('{"a": 1.50}') == '{"a": 1.50}' and plain_json("{not json") == "{not json"
    url = "https://apnews.com/article/some-story-0123456789abcdef"
    html = ('<html><head><script type="application/ld+json">{"@type": "NewsArticle", "headline": "first", "headline": "last", "x": NaN}'
            f'</script></head><body><div class="RichTextStoryBody"><p>{LINE}</p></div></body></html>')
    r = rows(spark, [(url, html, None)])[url]
    assert (r.title, r.extraction_method, r.parse_ok) == ("last", "hybrid", True)


def test_given_summary(spark):
    page = f"<html><body><article><h1>T</h1><p>{LINE}</p></article></body></html>"
    given = "A summary that came with the page and is long enough to count."
    urls = [f"https://unknown.example/articles/some-story-number-{k}" for k in range(4)]
    r = rows(spark, [(urls[0], page, given), (urls[1], page, "too short"), (urls[2], page, None), (urls[3], page, "word " * 200)])
    assert r[urls[0]].summary == given and not r[urls[0]].summary_truncated
    assert r[urls[1]].summary == r[urls[2]].summary != given
    assert r[urls[3]].summary_truncated and r[urls[3]].summary.endswith("word...") and len(r[urls[3]].summary) <= 515


def test_large_registries_are_joined(spark):
    many = [Source(f"s{k}", f"site{k}.example", (f"site{k}.example",), (), "bbc") for k in range(1500)]
    many.append(Source("deep", "news.site7.example", ("news.site7.example",), (), "ap"))
    df = spark.createDataFrame([(1, "https://www.site7.example/a"), (2, "https://a.news.site7.example/b"), (3, "https://other.example/"), (4, None)],
                               "page_id long, url string")
    got = {r.page_id: (r.source_name, r.rule_set) for r in route_pages(df, many).collect()}
    assert got[1] == ("s7", "bbc") and got[2] == ("deep", "ap") and got[3] == ("other.example", "generic") and got[4][1] == "generic"
