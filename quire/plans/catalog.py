"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the given tables (pages, documents, events, labels) whole; nothing is
sampled or capped except where the cap is the feature (the 100-link follow limit, the
50-item quality sample).
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import dates as Dt
from quire.functions import jsonld as J
from quire.functions import selectors as S
from quire.functions.text import (content_gate, content_length, fingerprint, fox_promo_keep, nav_junk,
                                  nbc_promo_keep, normalize_paragraphs, normalize_ws, py_strip, add_summary)
from quire.functions.urls import (add_article_url_flag, add_canonical_url, add_host, add_resolved_url,
                                  add_url_hash, is_valid_url)
from quire.operators import dedup, frontier as FR, reports
from quire.operators.extract import SITE_SETS
from quire.operators.html_nodes import add_nodes
from quire.plans import articles as A
from quire.plans import documents as D
from quire.plans import event_site as ES
from quire.plans import page_sites as PS
from quire.session import scratch_path
from quire.sources import tables
from quire.sources.keyed import KeyedTable
from quire.sources.registry import test_registry
from quire.sources.sinks import kafka_messages

RUN_TS = D.RUN_TS  # fixed run time of the registered queries (scraped_at)
Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------------ pages: keys and rules


def page_scan(spark, sf):
    """S1."""
    return tables.pages(spark, sf).select("page_id", "url", F.length("html").alias("html_chars"))


def url_keys(spark, sf):
    """X1, X2, X10."""
    df = tables.pages(spark, sf, with_html=False).select("page_id", "url")
    df = add_url_hash(df, "url", "url_hash", keep_canonical="canonical_url")
    return add_host(df, "url", "host").select("page_id", "canonical_url", "url_hash", "host")


def url_flags(spark, sf):
    """F1, F3."""
    df = tables.pages(spark, sf, with_html=False).select("page_id", "url")
    df = add_article_url_flag(df, "url", "article_url", "generic")
    return df.select("page_id", is_valid_url(F.col("url")).alias("valid_url"), "article_url")


def host_routing(spark, sf):
    """J1/J2 with the test registry."""
    df = A.route_pages(tables.pages(spark, sf, with_html=False), test_registry())
    return df.select("page_id", "host", "source_name", "rule_set")


def page_links(spark, sf):
    """P1 + P2: every a/@href of every page, in document order, resolved against the page."""
    df = add_nodes(tables.pages(spark, sf).select("page_id", "url", "html"))
    df = df.select("page_id", "url", F.posexplode(S.hrefs().column()).alias("pos", "href"))
    return add_resolved_url(df, "url", "href", "link_url").select("page_id", "pos", "href", "link_url")


def page_classification(spark, sf):
    """F11-F20 (F3 + site page tests) with the test registry."""
    return A.classified_pages(spark, sf, test_registry()).select("page_id", "rule_set", "is_article_page")


def followed_links(spark, sf):
    """W1 after F1, F2, F3: links followed from discovery pages."""
    links = FR.resolve_links(FR.page_hrefs(A.classified_pages(spark, sf, test_registry())))
    return FR.followed_links(links).select("page_id", "pos", "link_url", "follow_rank")


def frontier(spark, sf):
    """Followed URLs not yet stored, one row per url_hash."""
    links = FR.resolve_links(FR.page_hrefs(A.classified_pages(spark, sf, test_registry())))
    visited = add_url_hash(tables.pages(spark, sf, with_html=False).select("url"), "url", "url_hash")
    return FR.frontier(FR.followed_links(links), visited)


def _pages_with_copies(spark, sf) -> DataFrame:
    """Pages plus a re-tracked copy of each (a tracking parameter added): canonical twins."""
    p = tables.pages(spark, sf, with_html=False).select("page_id", "url")
    sep = F.when(F.col("url").contains("?"), F.lit("&")).otherwise(F.lit("?"))
    copy = p.select("page_id", F.concat(F.col("url"), sep, F.lit("utm_source=copy")).alias("url"),
                    F.lit(1).alias("copy"))
    both = p.withColumn("copy", F.lit(0)).unionByName(copy)
    return add_url_hash(both, "url", "url_hash")


def url_dedup(spark, sf):
    """One row per canonical URL; the original beats its re-tracked copy."""
    return dedup.keep_first(_pages_with_copies(spark, sf), "url_hash", ["copy", "page_id"]) \
        .select("url_hash", "page_id", "url", "copy")


def url_dup_groups(spark, sf):
    """A7 on url_hash."""
    return dedup.duplicate_groups(_pages_with_copies(spark, sf), "url_hash", "url") \
        .select("url_hash", "n_rows", F.col("first_url"))


# ------------------------------------------------------------------ documents: text columns


def _docs(spark, sf):
    return tables.documents(spark, sf).select("doc_id", "source", "text")


def doc_normalize(spark, sf):
    """X4, X8."""
    d = _docs(spark, sf).select("doc_id", normalize_ws(F.col("text")).alias("norm_text"))
    return d.select("doc_id", "norm_text", content_length(F.col("norm_text")).alias("content_length_chars"))


def doc_summary(spark, sf):
    """X6 / P23."""
    return add_summary(_docs(spark, sf), "text", "summary", "summary_truncated") \
        .select("doc_id", "summary", "summary_truncated")


def doc_fingerprint(spark, sf):
    """X3 (title = first line)."""
    d = _docs(spark, sf).select("doc_id", "source", normalize_ws(F.substring_index("text", "\n", 1)).alias("title"),
                                normalize_ws(F.col("text")).alias("norm"))
    return d.select("doc_id", "title", fingerprint(F.col("title"), F.col("norm"), F.lit(None), F.col("source"))
                    .alias("fingerprint"))


def doc_gate(spark, sf):
    """F21 + A6."""
    d = _docs(spark, sf).select("doc_id", "text", F.substring_index("text", "\n", 1).alias("title"),
                                py_strip(F.col("text")).alias("stripped"))
    lines = F.split(F.col("stripped"), "\n")
    return d.select("doc_id", F.size(lines).alias("n_lines"),
                    F.size(F.filter(lines, lambda ln: F.length(py_strip(ln)) < 30)).alias("n_short_lines"),
                    nav_junk(F.col("stripped")).alias("nav_junk"),
                    content_gate(F.col("title"), F.col("text")).alias("passes_gate"))


def doc_paragraphs(spark, sf):
    """P15 / F25 over the document's lines."""
    lines = F.split(F.col("text"), "\n")
    return _docs(spark, sf).select("doc_id", F.size(F.filter(F.transform(lines, py_strip), lambda p: p != ""))
                                   .alias("n_paragraphs"), normalize_paragraphs(lines).alias("body"))


def _promo(keep):
    def q(spark, sf):
        kept = keep(F.split(F.col("text"), "\n"))
        return _docs(spark, sf).select("doc_id", F.size(kept).alias("n_kept"), F.array_join(kept, "\n\n").alias("body"))
    return q


def doc_articles(spark, sf):
    """P21-P24 generic mapping on documents."""
    return D.generic_articles(spark, sf)


def _site(rs):
    return lambda spark, sf: D.site_articles(spark, sf, rs)


def content_dedup(spark, sf):
    """One row per content fingerprint."""
    return dedup.dedup_by_content(D.generic_articles(spark, sf), columns=["fingerprint", "url", "doc_id"])


def dup_groups(spark, sf):
    """A7 on fingerprint."""
    return dedup.duplicate_groups(D.generic_articles(spark, sf), "fingerprint", "url") \
        .select("fingerprint", "n_rows", "first_url")


def quality_report(spark, sf):
    """A1."""
    return reports.quality(D.generic_articles(spark, sf))


def quality_by_source(spark, sf):
    """A1 per source."""
    return reports.quality(D.generic_articles(spark, sf), ["source"])


def quality_rollup(spark, sf):
    """A1 with subtotals by source and method, over the generic and the NBC mapping of the documents."""
    g = D.generic_articles(spark, sf)
    return reports.quality_rollup(g.unionByName(D.site_articles(spark, sf, "nbc").select(*g.columns)), ["source", "extraction_method"])


def method_report(spark, sf):
    """A2 over generic, NBC and Fox mappings of the documents."""
    cols = ["extraction_method"]
    u = D.generic_articles(spark, sf).select(*cols).unionByName(D.site_articles(spark, sf, "nbc").select(*cols)) \
        .unionByName(D.site_articles(spark, sf, "fox").select(*cols))
    return reports.methods(u)


def failure_by_source(spark, sf):
    """A5."""
    return reports.failure_by_source(D.generic_articles(spark, sf))


def error_counts(spark, sf):
    """A5 detail."""
    return reports.error_counts(D.site_articles(spark, sf, "cnn"))


def run_counters(spark, sf):
    """A3/A4: one run over the site made from the events."""
    return ES.site_run(spark, sf, RUN_TS)


def quality_sample(spark, sf):
    """L1: the first 50 items in arrival order (the limit is the feature)."""
    return reports.sample(D.generic_articles(spark, sf)).select("url", "title", "parse_ok", "content_length_chars")


def gate_vs_labels(spark, sf):
    """Content gate against the quality labels."""
    a = D.generic_articles(spark, sf).select("doc_id", "parse_ok")
    lab = tables.labels(spark, sf).select("doc_id", "quality")
    return a.join(lab, "doc_id").groupBy("quality", "parse_ok").agg(F.count(F.lit(1)).alias("n"))


def insert_if_absent(spark, sf):
    """target = good generic rows; batch = generic + NBC rows for the same URLs."""
    g = D.generic_articles(spark, sf)
    n = D.site_articles(spark, sf, "nbc").drop("confidence")
    target = g.where(F.col("parse_ok"))
    cols = ["url", "extraction_method", "parse_ok", "fingerprint"]
    return dedup.insert_if_absent(target, g.select(*cols).unionByName(n.select(*cols)), "url", ["extraction_method", "fingerprint"])


def insert_keyed(spark, sf):
    """K3/J4 as insert_if_absent, with a keyed table as the target."""
    cols = ["url", "extraction_method", "parse_ok", "fingerprint"]
    g = D.generic_articles(spark, sf).select(*cols)
    target = KeyedTable(spark, scratch_path(spark, f"keyed-{uuid.uuid4().hex}"), "url")
    target.insert(g.where(F.col("parse_ok")), ["fingerprint"])
    return target.insert(g.unionByName(D.site_articles(spark, sf, "nbc").select(*cols)), ["extraction_method", "fingerprint"])


def frontier_indexed(spark, sf):
    """J3 with a stored index of the visited pages."""
    visited = FR.visited_index(spark, scratch_path(spark, f"visited-{uuid.uuid4().hex}"))
    visited.insert(add_url_hash(tables.pages(spark, sf, with_html=False).select("url"), "url", "url_hash").select("url_hash"))
    return FR.frontier(FR.followed_links(FR.resolve_links(FR.page_hrefs(A.classified_pages(spark, sf, test_registry())))), visited)


def kafka_payload(spark, sf):
    """K2: one JSON message per article (nulls kept), keyed by nothing."""
    return kafka_messages(D.generic_articles(spark, sf).drop("doc_id")).select("value")


# ------------------------------------------------------------------ events: synthesized inputs

# URL shapes for the site rules, filled from each event (FIXED VALUES of the test input)
URL_SHAPES = [
    "https://apnews.com/article/{t}-{id}", "https://apnews.com/hub/{t}", "https://apnews.com/politics",
    "https://www.bbc.com/news/{t}-{id}00000", "https://www.bbc.com/news/av/{t}-{id}00000",
    "https://www.bbc.com/sport/articles/c{id}x", "https://www.cbsnews.com/news/{t}-story-{id}/",
    "https://www.cbsnews.com/video/{t}-{id}/", "https://www.cnn.com/2026/01/{dd}/{t}/index.html",
    "https://www.cnn.com/videos/2026/01/{dd}/{t}", "https://www.foxnews.com/politics/{t}-headline-number-{id}",
    "https://www.foxnews.com/politics", "https://www.theguardian.com/world/2026/jan/{dd}/{t}-{id}",
    "https://www.theguardian.com/world/live/2026/jan/{dd}/{t}", "https://www.nbcnews.com/news/{t}-rcna{id}",
    "https://www.nbcnews.com/news/{t}-n{id}00", "https://example.com/news/{t}/{id}",
    "https://example.com/{t}-a-long-slug-for-the-story-{id}", "https://example.com/tag/{t}",
    "https://example.com/articles/{t}?utm_source=feed",
]


def _event_urls(spark, sf) -> DataFrame:
    e = tables.events(spark, sf).select("event_id", "event_type")
    n = len(URL_SHAPES)
    shape = F.element_at(F.array(*[F.lit(s) for s in URL_SHAPES]), (F.col("event_id") % n + 1).cast("int"))
    url = F.replace(F.replace(F.replace(shape, F.lit("{t}"), F.col("event_type")),
                              F.lit("{id}"), F.col("event_id").cast("string")),
                    F.lit("{dd}"), F.lpad((F.col("event_id") % 28 + 1).cast("string"), 2, "0"))
    return e.select("event_id", url.alias("url"))


def site_url_rules(spark, sf):
    """F3-F10 on URLs synthesized from every event."""
    df = _event_urls(spark, sf)
    for rs in SITE_SETS + ["generic"]:
        df = add_article_url_flag(df, "url", rs, rs)
    return df


# date shapes filled from each event's timestamp (FIXED VALUES of the test input)
DATE_SHAPES = ["yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss+05:30", "yyyy-MM-dd'T'HH:mm:ss-0800",
               "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "dd MMM yyyy",
               "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm", "yyyy", "yyyy-MM", "HH:mm", "yyyyMMdd"]


def _event_dates(spark, sf) -> DataFrame:
    e = tables.events(spark, sf).select("event_id", "ts")
    n = len(DATE_SHAPES)
    k = (F.col("event_id") % n).cast("int")
    raw = F.coalesce(*[F.when(k == i, F.date_format("ts", f)) for i, f in enumerate(DATE_SHAPES)])
    return e.select("event_id", raw.alias("raw"))


def parse_dates(spark, sf):
    """X5 on date strings synthesized from every event."""
    return Dt.add_iso_utc(_event_dates(spark, sf), "raw", "iso_utc")


def meta_dates(spark, sf):
    """X7 on the same strings."""
    d = _event_dates(spark, sf)
    return d.select("event_id", "raw", Dt.utc_string(Dt.meta_datetime(F.col("raw"))).alias("iso_utc"))


# ------------------------------------------------------------------ HTML jobs (rows-only)


def page_articles(spark, sf):
    """The article table of the stored pages (test registry)."""
    return A.articles(spark, sf, RUN_TS, test_registry())


def page_quality(spark, sf):
    """A1 per source over the page article table."""
    return reports.quality(A.articles(spark, sf, RUN_TS, test_registry()), ["source"])


def html_nodes(spark, sf):
    """Node counts per page."""
    df = add_nodes(tables.pages(spark, sf).select("page_id", "url", "html"))
    n = F.col("nodes")
    return df.select("page_id", F.size(n).alias("n_nodes"),
                     F.size(F.filter(n, lambda x: x["t"])).alias("n_text"),
                     F.size(F.filter(n, lambda x: ~x["t"])).alias("n_elements"), "parse_error")


def _jsonld(pages):
    df = add_nodes(pages.select("page_id", "url", "html"))
    return df.select("page_id", F.size(S.ld_scripts().column()).alias("n_scripts"),
                     F.size(J.blocks(S.ld_scripts().column())).alias("n_blocks"))


def jsonld_blocks(spark, sf):
    """JSON-LD scripts and blocks per page."""
    return _jsonld(tables.pages(spark, sf))


def page_jsonld(spark, sf):
    """P4 on pages made from documents, of which every sixth has an array of two objects."""
    return _jsonld(PS.dated_pages(spark, sf, "ap"))


def _page_site(rs):
    """P3-P20 and the page tests of a site rule set, on pages made from every document."""
    return lambda spark, sf: PS.site_page_articles(spark, sf, rs, RUN_TS)


def page_generic(spark, sf):
    """F11, F12, P21-P24 on pages made from every document."""
    return PS.generic_page_articles(spark, sf, RUN_TS)


def page_extracted(spark, sf):
    """EXTRACTED table: all fields of a rule set, section, tags, confidence and errors included."""
    return PS.site_page_extracted(spark, sf, "ap")


QUERIES: dict[str, Query] = {
    "page_scan": page_scan,
    "url_keys": url_keys,
    "url_flags": url_flags,
    "host_routing": host_routing,
    "page_links": page_links,
    "page_classification": page_classification,
    "followed_links": followed_links,
    "frontier": frontier,
    "url_dedup": url_dedup,
    "url_dup_groups": url_dup_groups,
    "doc_normalize": doc_normalize,
    "doc_summary": doc_summary,
    "doc_fingerprint": doc_fingerprint,
    "doc_gate": doc_gate,
    "doc_paragraphs": doc_paragraphs,
    "doc_promo_fox": _promo(fox_promo_keep),
    "doc_promo_nbc": _promo(nbc_promo_keep),
    "doc_articles": doc_articles,
    **{f"doc_site_{rs}": _site(rs) for rs in SITE_SETS},
    "content_dedup": content_dedup,
    "dup_groups": dup_groups,
    "quality_report": quality_report,
    "quality_by_source": quality_by_source,
    "quality_rollup": quality_rollup,
    "method_report": method_report,
    "failure_by_source": failure_by_source,
    "error_counts": error_counts,
    "run_counters": run_counters,
    "site_links": ES.site_links,
    "site_frontier": ES.site_frontier,
    "site_walk": ES.site_walk,
    "quality_sample": quality_sample,
    "gate_vs_labels": gate_vs_labels,
    "insert_if_absent": insert_if_absent,
    "insert_keyed": insert_keyed,
    "frontier_indexed": frontier_indexed,
    "site_frontier_indexed": ES.site_frontier_indexed,
    "run_observed": lambda spark, sf: ES.site_run_observed(spark, sf, RUN_TS),
    "kafka_payload": kafka_payload,
    "site_url_rules": site_url_rules,
    "parse_dates": parse_dates,
    "meta_dates": meta_dates,
    "page_articles": page_articles,
    "page_quality": page_quality,
    "html_nodes": html_nodes,
    "jsonld_blocks": jsonld_blocks,
    "page_extracted": page_extracted,
    "page_generic": page_generic,
    "page_jsonld": page_jsonld,
    **{f"page_site_{rs}": _page_site(rs) for rs in SITE_SETS},
    **{f"page_dates_{rs}": (lambda spark, sf, rs=rs: PS.page_dates(spark, sf, rs)) for rs in SITE_SETS},
}
