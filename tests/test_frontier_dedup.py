"""Links, the 100-link cap, frontier, crawl walk, dedup and insert-if-absent."""
from pyspark.sql import functions as F

from quire.operators import dedup
from quire.operators import frontier as FR
from quire.plans.articles import classify_pages, route_pages
from quire.sources.registry import Source

from test_extract import page_df

REG = [Source("ex", "example.com", ("example.com",), (), "generic")]


def test_follow_two_links(spark):
    html = ('<html><body><a href="https://example.com/news/2026/01/29/article-one">1</a>'
            '<a href="https://example.com/news/2026/01/29/article-two">2</a><a href="https://other.com/2026/01/01/x">o</a></body></html>')
    c = classify_pages(route_pages(page_df(spark, [("https://example.com/section/page", html)]), REG))
    fl = FR.followed_links(FR.resolve_links(FR.page_hrefs(c)))
    assert [r.link_url for r in fl.orderBy("pos").collect()] == [
        "https://example.com/news/2026/01/29/article-one", "https://example.com/news/2026/01/29/article-two"]


def test_cap_counts_duplicates(spark):
    links = "".join(f'<a href="/news/2026/01/29/story-{i % 60}">x</a><a href="/tag/skip">s</a>' for i in range(150))
    c = classify_pages(route_pages(page_df(spark, [("https://example.com/section/page", f"<html><body>{links}</body></html>")]), REG))
    fl = FR.followed_links(FR.resolve_links(FR.page_hrefs(c)))
    assert fl.count() == 100
    visited = spark.createDataFrame([("x",)], "url_hash string")
    fr = FR.frontier(fl, visited)
    assert fr.count() == 60 and fr.agg(F.sum("n_links")).first()[0] == 100


def test_crawl_walk(spark):
    idx = spark.createDataFrame([
        ("a", 1, False, ["b", "c"]), ("b", 2, False, ["d"]), ("c", 3, True, ["e"]), ("d", 4, False, ["a"]), ("e", 5, False, []),
    ], "url_hash string, page_id long, is_article_page boolean, links array<string>")
    seeds = spark.createDataFrame([("a",)], "url_hash string")
    got = {r.url_hash: r.depth for r in FR.crawl_walk(idx, seeds, 50).collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 2}  # article page c is not expanded
    got1 = {r.url_hash for r in FR.crawl_walk(idx, seeds, 1).collect()}
    assert got1 == {"a", "b", "c"}


def test_keep_first_and_insert_if_absent(spark):
    batch = spark.createDataFrame([("u1", "2026-01-02", "late"), ("u1", "2026-01-01", "early"), ("u2", "2026-01-01", "x")],
                                  "url string, scraped_at string, title string")
    kf = {r.url: r.title for r in dedup.keep_first(batch, "url", ["scraped_at"]).collect()}
    assert kf == {"u1": "early", "u2": "x"}
    target = spark.createDataFrame([("u2", "t", "old")], "url string, scraped_at string, title string")
    once = dedup.insert_if_absent(target, batch, "url", ["scraped_at"])
    assert [(r.url, r.title) for r in once.collect()] == [("u1", "early")]
    twice = dedup.insert_if_absent(target.unionByName(once), batch, "url", ["scraped_at"])
    assert twice.count() == 0


def test_duplicate_groups(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("j", "c")], "key string, url string")
    assert [(r.key, r.n_rows, r.first_url) for r in dedup.duplicate_groups(df, "key", "url").collect()] == [("k", 2, "a")]


def test_frontier_skips_stored_pages(spark):
    from quire.functions.urls import add_url_hash
    html = ('<html><body><a href="/news/2026/01/29/stored-story?utm_source=x">1</a>'
            '<a href="/news/2026/01/29/new-story">2</a></body></html>')
    c = classify_pages(route_pages(page_df(spark, [("https://example.com/section/page", html)]), REG))
    fl = FR.followed_links(FR.resolve_links(FR.page_hrefs(c)))
    stored = add_url_hash(spark.createDataFrame([("https://example.com/news/2026/01/29/stored-story",)], "url string"),
                          "url", "url_hash")
    assert [r.url for r in FR.frontier(fl, stored).collect()] == ["https://example.com/news/2026/01/29/new-story"]
