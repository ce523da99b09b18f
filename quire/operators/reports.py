"""Reports over the article table: A1 quality, A2 methods, A3/A4 run counters, A5 failure
rate by source, L1 sample.

All are aggregates with map-side partial aggregation (a hot source or method collapses to
one row per map task before the shuffle); percentages use a window over the already-tiny
aggregate, never over rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from quire import constants as C


def _has(c: str):
    return F.coalesce(F.length(F.col(c)) > 0, F.lit(False))


def _pct(num, den):
    return F.round(F.when(den > 0, num * 100.0 / den).otherwise(F.lit(0.0)), 1)


def quality(articles: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A1: n, parse ok/fail, rows with title/author/text/date (empty = missing), average
    text length (missing = 0), each with its percentage of n."""
    return _quality(articles.groupBy(*(by or [])))


def quality_rollup(articles: DataFrame, by: list[str]) -> DataFrame:
    """A1 with subtotals, in one pass: a row for each group of ``by``, of its beginnings, and for all rows.
    ``level`` is the grouping_id: bits of the columns that a row sums over (a NULL there is no value)."""
    return _quality(articles.rollup(*by), F.grouping_id().cast("long").alias("level"))


def _quality(grouped, *more) -> DataFrame:
    agg = grouped.agg(
        *more,
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("parse_ok")).alias("parse_ok"),
        F.count_if(~F.col("parse_ok")).alias("parse_fail"),
        F.count_if(_has("title")).alias("has_title"),
        F.count_if(_has("author")).alias("has_author"),
        F.count_if(_has("text")).alias("has_text"),
        F.count_if(_has("published_at")).alias("has_date"),
        F.round(F.avg(F.coalesce(F.length("text"), F.lit(0))), 1).alias("avg_text_chars"),
    )
    for c in ("parse_ok", "parse_fail", "has_title", "has_author", "has_text", "has_date"):
        agg = agg.withColumn("pct_" + c, _pct(F.col(c), F.col("n")))
    return agg


def methods(articles: DataFrame) -> DataFrame:
    """A2: rows per extraction method (NULL or "" → "unknown") with percentages, by name."""
    m = F.coalesce(F.nullif(F.col("extraction_method"), F.lit("")), F.lit("unknown"))
    agg = articles.groupBy(m.alias("extraction_method")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return agg.withColumn("pct", _pct(F.col("n"), total)).orderBy("extraction_method")


def failure_by_source(articles: DataFrame) -> DataFrame:
    """A5: failure rate per source, and the most frequent failure message."""
    per = articles.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col("parse_ok")).alias("n_failed"),
        F.round(F.avg((~F.col("parse_ok")).cast("double")), 4).alias("failure_rate"),
        F.count_if(F.col("parse_error").isNotNull()).alias("n_with_error"),
    )
    return per.orderBy("source")


def error_counts(articles: DataFrame) -> DataFrame:
    """A5 detail: rows per (source, parse_error) among rows with an error text."""
    return (articles.where(F.col("parse_error").isNotNull())
            .groupBy("source", "parse_error").agg(F.count(F.lit(1)).alias("n")))


def run_counters(requests: DataFrame, classified: DataFrame, articles: DataFrame) -> DataFrame:
    """A3/A4 of one run, as one row. ``requests`` (url_hash): seeds and followed URLs, a URL counts once;
    responses: the stored pages; items: article rows, among them items_failed, whose failure was
    handled (parse_ok false); errors: pages that could not be parsed and gave no item; the span of
    scraped_at. A tagged union of the three inputs and one aggregate."""
    none_b, none_s = F.lit(None).cast("boolean"), F.lit(None).cast("string")
    lost = F.col("parse_error").isNotNull() & ~F.col("is_article_page")
    tagged = (requests.select("url_hash").distinct().select(F.lit("req").alias("kind"), none_b.alias("bad"), none_s.alias("ts"))
              .unionByName(classified.select(F.lit("resp").alias("kind"), lost.alias("bad"), none_s.alias("ts")))
              .unionByName(articles.select(F.lit("item").alias("kind"), (~F.col("parse_ok")).alias("bad"),
                                           F.col("scraped_at").alias("ts"))))
    of = lambda kind, cond=F.lit(True): F.count_if((F.col("kind") == kind) & cond)
    return tagged.agg(
        of("req").alias("requests"), of("resp").alias("responses"), of("item").alias("items"),
        of("item", F.col("bad")).alias("items_failed"), of("resp", F.col("bad")).alias("errors"),
        F.min("ts").alias("first_scraped_at"), F.max("ts").alias("last_scraped_at"))


def observed_run(requests: DataFrame, classified: DataFrame, items_of, path: str) -> dict:
    """A3/A4 by the writes themselves: what ``run_counters`` says, from metrics that are collected while the
    requests and the items (``items_of(classified)``) are written below ``path``. Nothing is read again."""
    asked, seen, kept = (Observation(f"{n}-{uuid.uuid4().hex}") for n in ("requests", "responses", "items"))
    requests.select("url_hash").distinct().observe(asked, F.count(F.lit(1)).alias("requests")).write.mode("overwrite").parquet(f"{path}/requests")
    lost = F.col("parse_error").isNotNull() & ~F.col("is_article_page")
    pages = classified.observe(seen, F.count(F.lit(1)).alias("responses"), F.count_if(lost).alias("errors"))
    items = items_of(pages).observe(kept, F.count(F.lit(1)).alias("items"), F.count_if(~F.col("parse_ok")).alias("items_failed"),
                                    F.min("scraped_at").alias("first_scraped_at"), F.max("scraped_at").alias("last_scraped_at"))
    items.write.mode("overwrite").parquet(f"{path}/items")
    return {**asked.get, **seen.get, **kept.get}


def sample(articles: DataFrame, n: int = C.QUALITY_SAMPLE) -> DataFrame:
    """L1: the first ``n`` items in arrival order (scraped_at, then url) — a top-k."""
    return articles.orderBy("scraped_at", "url").limit(n)
