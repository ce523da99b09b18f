"""A site made from every row of ``events``: linked pages, through the whole page path.

130 events in a row are a page. Each puts a link on it, every tenth one to a section page, which the
URL rules reject, the others to page 3 p + (event_id mod 4), so a page has more accepted links
than are followed. By page number modulo 10 a page is an article with text (3), an article
without text (8), a section page with broken markup, which is read all the same (1), or a
plain discovery page.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.urls import add_url_hash
from quire.operators import frontier as FR, reports
from quire.operators.extract import article_rows
from quire.plans.articles import classify_pages, route_pages
from quire.session import scratch_path
from quire.sources import tables
from quire.sources.registry import Source, seeds_df

# FIXED VALUES of the test input
PAGE_EVENTS = 130
SITE = "https://walk.example.org"
REGISTRY = [Source("walk", "walk.example.org", ("walk.example.org",), (SITE + "/news/page-number-0",), "generic")]


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PAGES of the site. A page is made of at most PAGE_EVENTS different events."""
    e = tables.events(spark, sf_dir).select(F.floor(F.col("event_id") / PAGE_EVENTS).alias("page_id"), "event_id", "event_type")
    p = e.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("event_id", "event_type"))).alias("ev"))
    number, kind = F.col("page_id").cast("string"), F.col("page_id") % 10
    target = lambda x: (F.col("page_id") * 3 + x["event_id"] % 4).cast("string")
    link = lambda x: F.concat(F.lit('<a href="'), F.when(x["event_id"] % 10 == 0, F.concat(F.lit("/tag/"), x["event_type"]))
                              .otherwise(F.concat(F.lit("/news/page-number-"), target(x))), F.lit('">more</a> '))
    para = lambda x: F.concat(F.lit("<p>Event "), x["event_id"].cast("string"), F.lit(" of the type "), x["event_type"],
                              F.lit(" was seen.</p>"))
    body = (F.when(kind == 3, F.concat(F.lit("<article>"), F.array_join(F.transform("ev", para), ""), F.lit("</article>")))
            .when(kind == 8, F.lit("<article></article>")).when(kind == 1, F.lit("<![foo bar]>")).otherwise(F.lit("")))
    html = F.concat(F.lit("<!DOCTYPE html><html><body><h1>Page number "), number, F.lit("</h1>"), body,
                    F.array_join(F.transform("ev", link), ""), F.lit("</body></html>"))
    path = F.when(kind == 1, F.lit("/tag/page-")).otherwise(F.lit("/news/page-number-"))
    none = F.lit(None).cast("string")
    return p.select("page_id", F.concat(F.lit(SITE), path, number).alias("url"), html.alias("html"), none.alias("content_type"),
                    none.alias("feed_author"), none.alias("feed_summary"), F.lit(None).cast("timestamp").alias("fetched_at"))


def _classified(spark, sf_dir) -> DataFrame:
    return classify_pages(route_pages(site_pages(spark, sf_dir), REGISTRY), ("generic",))


def _followed(classified: DataFrame) -> DataFrame:
    return FR.followed_links(FR.resolve_links(FR.page_hrefs(classified)))


def _seeds(spark) -> DataFrame:
    return add_url_hash(seeds_df(spark, REGISTRY).select("url"), "url", "url_hash")


def site_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 where pages have more accepted links than are followed."""
    return _followed(_classified(spark, sf_dir)).select("page_id", "pos", "link_url", "follow_rank")


def site_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 with links that repeat on a page, and stored pages among the targets."""
    classified = _classified(spark, sf_dir)
    return FR.frontier(_followed(classified), route_pages(site_pages(spark, sf_dir), REGISTRY).select("url_hash"))


def site_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 and L5 from the registry's seeds: each stored page that is reached, with its depth."""
    classified = _classified(spark, sf_dir)
    links = _followed(classified).where("first_on_page").groupBy("page_id").agg(F.collect_list("url_hash").alias("links"))
    pages = classified.select("url_hash", "page_id", "is_article_page").join(links, "page_id", "left")
    return FR.crawl_walk(pages, _seeds(spark)).select("page_id", "depth")


def site_frontier_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 against a stored index of the visited pages."""
    visited = FR.visited_index(spark, scratch_path(spark, f"visited-{uuid.uuid4().hex}"))
    visited.insert(route_pages(site_pages(spark, sf_dir), REGISTRY).select("url_hash"))
    return FR.frontier(_followed(_classified(spark, sf_dir)), visited)


def site_run_observed(spark: SparkSession, sf_dir: str, run_ts: str) -> DataFrame:
    """A3/A4 of one run over the site, collected by its writes."""
    classified = _classified(spark, sf_dir)
    requests = _seeds(spark).select("url_hash").unionByName(_followed(classified).select("url_hash"))
    found = reports.observed_run(requests, classified, lambda pages: article_rows(pages.where("is_article_page"), run_ts, rule_sets=("generic",)),
                                 scratch_path(spark, f"run-{uuid.uuid4().hex}"))
    counters = ("requests", "responses", "items", "items_failed", "errors")
    return spark.createDataFrame([tuple(found[c] for c in (*counters, "first_scraped_at", "last_scraped_at"))],
                                 ", ".join(f"{c} long" for c in counters) + ", first_scraped_at string, last_scraped_at string")


def site_run(spark: SparkSession, sf_dir: str, run_ts: str) -> DataFrame:
    """A3/A4 of one run over the site."""
    classified = _classified(spark, sf_dir)
    requests = _seeds(spark).select("url_hash").unionByName(_followed(classified).select("url_hash"))
    items = article_rows(classified.where("is_article_page"), run_ts, rule_sets=("generic",))
    return reports.run_counters(requests, classified, items)
