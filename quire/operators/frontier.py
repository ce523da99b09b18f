"""Links and the crawl frontier: P1, P2, F1, F2, F3-F10, W1, J3, J5.

Discovery pages (not article pages) contribute their ``a/@href`` values in document order.
Each href is resolved against the page (or its ``<base href>``), then must be a valid http(s)
non-feed URL, on one of the page source's allowed domains, and article-like by the source's
URL rule; the first 100 accepted per page are followed (duplicates count). The frontier is the
set of followed URLs, keyed by ``url_hash``, minus pages already stored.

Shuffles: none up to W1. A page's links are one array in the page's row; they are resolved, tested
and cut to the first 100 accepted ones there, and only those become rows. The frontier
aggregates by ``url_hash`` with a map-side partial aggregate, so a URL linked from every page
collapses before the one shuffle; the anti join then meets unique keys on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire import constants as C
from quire.functions.text import bind
from quire.functions.urls import Elements, add_resolved_url, add_url_parts, is_valid_url, host_of
from quire.operators.dedup import anti_join
from quire.operators.extract import follow_limit, url_flag
from quire.session import ensure_checkpoint_dir
from quire.sources.keyed import KeyedTable
from quire.sources.registry import same_domain


def page_hrefs(classified: DataFrame) -> DataFrame:
    """One row per discovery page with ``hrefs`` (array, document order) and what link tests need."""
    df = classified.where(~F.col("is_article_page") & F.col("parse_error").isNull()).select(
        "page_id", "url", "source_name", "source", "rule_set", "allowed_domains",
        "base_href", "hrefs")
    # the page's <base href> (itself resolved against the page URL) replaces the page URL
    df = add_resolved_url(df, "url", "base_href", "base_url")
    return df.withColumn("base_url", F.when(F.col("base_href").isNull(), F.col("url")).otherwise(F.col("base_url")))


def resolve_links(hrefs: DataFrame) -> DataFrame:
    """P2 + F1 + F2 + F3-F10: ``links``, an array of (pos, link_url, valid, same_domain, accepted)."""
    df = add_url_parts(hrefs, "base_url", "b_")
    df = df.withColumn("links", F.transform("hrefs", lambda h, i: F.struct(i.alias("pos"), h.alias("href"))))
    e = Elements(df, "links", ["pos", "href"]).add_resolved_url("base_url", "b_", "href", "link_url").keep("pos", "link_url")
    e = e.add_url_parts("link_url", "l_").add(lambda x: {"host": host_of(x["l_netloc"]), "path": F.lower(x["l_path"])})
    # the page's URL rule set decides whether a link looks like an article
    e = e.add(lambda x: {"valid": is_valid_url(x["link_url"]), "same_domain": same_domain(x["host"], F.col("allowed_domains")),
                         "article": url_flag(x["link_url"], x["path"])})
    e = e.add(lambda x: {"accepted": x["valid"] & x["same_domain"] & x["article"]}).keep(
        "pos", "link_url", "valid", "same_domain", "accepted")
    return e.df.select("page_id", "url", "source_name", "rule_set", "links")


def followed_links(links: DataFrame, limit: int | None = None) -> DataFrame:
    """The first ``limit`` accepted links (by default, the limit of the page's rule set) per page in document order: page_id, pos, link_url,
    source_name, follow_rank, url_hash, first_on_page (no earlier link of the page has the key).

    Cut within the page's array, so there is no shuffle. The outer explode keeps the optimizer from
    pushing a test of the array's size down through every staged URL projection."""
    kept = F.slice(F.filter("links", lambda x: F.coalesce(x["accepted"], F.lit(False))), 1, follow_limit() if limit is None else limit)
    df = links.select("page_id", "source_name", kept.alias("kept"))
    df = Elements(df, "kept", ["pos", "link_url"]).add_url_hash("link_url", "url_hash").keep("pos", "link_url", "url_hash").df
    marked = bind(F.transform("kept", lambda x: x["url_hash"]), lambda keys: F.transform("kept", lambda x, i: F.struct(
        x["pos"].alias("pos"), x["link_url"].alias("link_url"), x["url_hash"].alias("url_hash"),
        (F.array_position(keys, x["url_hash"]) == i + 1).alias("first_on_page"))))
    rows = df.select("page_id", "source_name", F.posexplode_outer(marked).alias("at", "x")).where(F.col("x").isNotNull())
    return rows.select("page_id", "x.pos", "x.link_url", "source_name", (F.col("at") + 1).cast("long").alias("follow_rank"),
                       "x.url_hash", "x.first_on_page")


def visited_index(spark, path: str) -> KeyedTable:
    """The url_hash of every page ever stored, with a membership index. ``insert`` adds those of new pages, so
    a page's hash is computed once."""
    return KeyedTable(spark, path, "url_hash")


def frontier(followed: DataFrame, visited: DataFrame | KeyedTable) -> DataFrame:
    """Distinct followed URLs (by url_hash) not among the visited pages' url_hash.

    ``visited`` is a table with a ``url_hash`` column, or a ``visited_index``: then the followed URLs are
    stored once, and only those that the index cannot rule out meet stored hashes. The kept URL of a key is the first one seen
    (lowest page_id, then position)."""
    order = F.struct("page_id", "pos")
    dedup = followed.groupBy("url_hash").agg(
        F.min_by("link_url", order).alias("url"),
        F.min_by("source_name", order).alias("source_name"),
        F.count(F.lit(1)).alias("n_links"),
        F.count_if("first_on_page").alias("n_pages"))
    if isinstance(visited, KeyedTable):
        ensure_checkpoint_dir(followed.sparkSession)
        return visited.absent(dedup.checkpoint())
    return anti_join(dedup, visited, "url_hash")


def crawl_walk(page_index: DataFrame, seeds: DataFrame, max_depth: int = C.DEPTH_LIMIT) -> DataFrame:
    """Walk stored pages from the seeds, one hop per iteration, up to ``max_depth``.

    ``page_index``: url_hash, page_id, is_article_page, links (array of followed link
    url_hash, already capped per page). ``seeds``: url_hash. Returns (url_hash, page_id,
    depth) of every reached stored page. The slim index is written once, then each hop writes
    its own level only (``checkpoint()``, to the shared folder in ``spark.checkpoint.dir``), so a
    lost executor recomputes one hop. A hop is an anti join against the levels so far, then an
    equi join to the index; the result is the union of the levels.
    """
    ensure_checkpoint_dir(page_index.sparkSession)
    idx = page_index.select("url_hash", "page_id", F.when(~F.col("is_article_page"), F.col("links")).alias("links")).checkpoint()
    levels = [seeds.select("url_hash").distinct().join(idx, "url_hash").withColumn("depth", F.lit(0)).checkpoint()]
    for depth in range(1, max_depth + 1):
        reached = _union(levels, "url_hash")
        nxt = (levels[-1].select(F.explode("links").alias("url_hash")).distinct()
               .join(reached, "url_hash", "left_anti").join(idx, "url_hash").withColumn("depth", F.lit(depth)).checkpoint())
        if nxt.isEmpty():
            break
        levels.append(nxt)
    return _union(levels, "url_hash", "page_id", "depth")


def _union(levels: list[DataFrame], *columns: str) -> DataFrame:
    out = levels[0].select(*columns)
    for level in levels[1:]:
        out = out.unionByName(level.select(*columns))
    return out
