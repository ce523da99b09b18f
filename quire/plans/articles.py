"""End-to-end plans over stored pages: route → key → parse → classify → extract / follow.

One lazy plan per output; the only Python step is the HTML node step, and the HTML column
is dropped there, so it never reaches a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.urls import add_url_hash, add_url_parts, host_of
from quire.operators.extract import add_page_flag, add_slots, add_url_flag, article_rows
from quire.sources import tables
from quire.sources.registry import EMBED_DOMAINS, Source, default_registry, route, route_by_join

def route_pages(pages: DataFrame, registry: list[Source]) -> DataFrame:
    """X10 + J1/J2 + X2: host, source, rule set and URL key of each page (narrow)."""
    df = add_url_parts(pages, "url", "_p_")
    df = df.select("*", host_of(F.col("_p_netloc")).alias("host"), F.lower(F.col("_p_path")).alias("url_path"))
    df = df.drop(*[f"_p_{p}" for p in ("scheme", "netloc", "path", "params", "query", "fragment")])
    if sum(len(s.allowed_domains) for s in registry) <= EMBED_DOMAINS:
        df = df.withColumn("_src", route(F.col("host"), registry))
    else:
        df = route_by_join(df, registry)
    df = df.select(
        "*",
        F.coalesce(F.col("_src.source_name"), F.col("host")).alias("source_name"),
        F.coalesce(F.col("_src.source"), F.col("host")).alias("source"),
        F.coalesce(F.col("_src.rule_set"), F.lit("generic")).alias("rule_set"),
        F.coalesce(F.col("_src.allowed_domains"), F.array(F.col("host"))).alias("allowed_domains"),
    ).drop("_src")
    return add_url_hash(df, "url", "url_hash")


def rule_sets_of(registry: list[Source]) -> tuple[str, ...]:
    """Rule sets a plan must carry: the registry's, plus generic for unregistered hosts."""
    return tuple(sorted({s.rule_set for s in registry} | {"generic"}))


def classify_pages(routed: DataFrame, rule_sets=None) -> DataFrame:
    """P3 + F11-F20: the page's slots, read in one pass, and the article-page verdict."""
    df = add_url_flag(add_slots(routed, rule_sets), rule_sets=rule_sets)
    return add_page_flag(df, rule_sets=rule_sets)


def classified_pages(spark: SparkSession, sf_dir: str, registry: list[Source] | None = None) -> DataFrame:
    reg = registry if registry is not None else default_registry()
    return classify_pages(route_pages(tables.pages(spark, sf_dir), reg), rule_sets_of(reg))


def articles(spark: SparkSession, sf_dir: str, run_ts: str, registry: list[Source] | None = None) -> DataFrame:
    """The ARTICLES table: one row per article page (failures kept with parse_ok=false).
    ``run_ts`` is the time of this run (scraped_at)."""
    reg = registry if registry is not None else default_registry()
    df = classified_pages(spark, sf_dir, reg)
    return article_rows(df.where(F.col("is_article_page")), run_ts, rule_sets=rule_sets_of(reg))
