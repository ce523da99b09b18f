"""Article rows from the ``documents`` table (plain text, no HTML).

A document is read as an already-extracted page: its first line is the title and the
remaining lines are its paragraphs. Two mappings exist, exactly as for pages:

* ``generic_articles`` — the generic path (F21 gate, F24, P23/P24 summary, X3 fingerprint);
* ``site_articles(rule_set)`` — a site rule set's body assembly (P15, F22/F23 promo filters),
  confidence ladder (P16), error list (P17), mapping (P18) and verdict (P19), through the
  same stages the HTML extraction uses.

The synthetic URL ``https://<source>.example/doc/<doc_id>`` stands in for the page URL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import constants as C
from quire.operators.rule_sets import named
from quire.functions.text import (add_summary, bind, content_gate, content_length, fingerprint, fox_promo_keep,
                                  low_quality_to_null, nbc_promo_keep, normalize_paragraphs, normalize_ws,
                                  py_strip)
from quire.functions.urls import add_url_hash
from quire.operators import extract as E
from quire.sources import tables

RUN_TS = "2026-01-01T00:00:00Z"


def doc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = tables.documents(spark, sf_dir)
    df = d.select("doc_id", "source", "text",
                  F.concat(F.lit("https://"), F.col("source"), F.lit(".example/doc/"), F.col("doc_id").cast("string")).alias("url"))
    return add_url_hash(df, "url", "url_hash")


def generic_articles(spark: SparkSession, sf_dir: str, run_ts: str = RUN_TS) -> DataFrame:
    """P21-P24 on documents (no author, no date: the document carries none)."""
    df = doc_pages(spark, sf_dir)
    df = df.select("*", F.substring_index(F.col("text"), "\n", 1).alias("title_raw"))
    df = df.select("*", content_gate(F.col("title_raw"), F.col("text")).alias("gate"),
                   normalize_ws(F.col("title_raw")).alias("n_title"),
                   low_quality_to_null(normalize_ws(F.col("text"))).alias("n_text"),
                   py_strip(F.col("text")).alias("sum_src"))
    df = add_summary(df, "sum_src", "n_summary", "n_trunc")
    gate = F.col("gate")
    null_s = F.lit(None).cast("string")
    return df.select(
        F.col("n_title").alias("title"),
        null_s.alias("author"),
        F.when(gate, F.col("n_text")).alias("text"),
        F.when(gate, F.col("n_summary")).alias("summary"),
        "url", "source", null_s.alias("published_at"), F.lit(run_ts).alias("scraped_at"), "url_hash",
        F.when(gate, fingerprint(F.col("n_title"), F.col("n_text"), null_s, F.col("source")))
        .otherwise(fingerprint(F.col("n_title"), null_s, null_s, F.col("source"))).alias("fingerprint"),
        F.lit(C.AUTHOR_MISSING).alias("author_source"),
        F.lit(C.SUMMARY_MAX_CHARS).alias("summary_max_chars"),
        F.when(gate, F.col("n_trunc")).otherwise(F.lit(False)).alias("summary_truncated"),
        gate.alias("parse_ok"),
        F.when(~gate, F.lit(C.GENERIC_GATE_FAILED)).alias("parse_error"),
        F.lit(C.METHOD_GENERIC).alias("extraction_method"),
        F.when(gate, content_length(F.col("n_text"))).otherwise(F.lit(0)).alias("content_length_chars"),
        "doc_id",
    )


def site_articles(spark: SparkSession, sf_dir: str, rule_set: str, run_ts: str = RUN_TS) -> DataFrame:
    """P15-P19 of a site rule set on documents (first line = title, other lines = paragraphs)."""
    df = doc_pages(spark, sf_dir)
    lines = F.split(F.col("text"), "\n")
    df = df.select("*", F.element_at(lines, 1).alias("title_raw"),
                   F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))).alias("paras"))
    paras = F.col("paras")
    nonempty = F.size(paras) > 0
    if rule_set in ("fox", "nbc"):
        kept = fox_promo_keep(paras) if rule_set == "fox" else nbc_promo_keep(paras)
        body = bind(kept, lambda k: F.when(F.size(k) > 0, normalize_paragraphs(k))
                    .when(nonempty, normalize_paragraphs(paras)))
    else:
        body = F.when(nonempty, normalize_paragraphs(paras))
    null_s, null_ts = F.lit(None).cast("string"), F.lit(None).cast("timestamp")
    df = df.select(
        "*", F.lit(rule_set).alias("rule_set"), null_s.alias("parse_error"),
        normalize_ws(F.col("title_raw")).alias("x_title"), body.alias("x_body"), null_s.alias("x_author"),
        null_ts.alias("x_published"), null_ts.alias("x_modified"), null_s.alias("x_section"),
        F.array().cast("array<string>").alias("x_tags"), (~nonempty).alias("x_no_paras"),
        F.lit(False).alias("x_ld_any"), F.lit(False).alias("x_ld_body"),
        null_s.alias("x_pub_err"), null_s.alias("x_mod_err"))
    rules = named((rule_set,))
    df = E._site_prepare(E.add_site_score(df, (rule_set,)), rules)
    cols = E._site_columns(rules)
    fixed = {"url": F.col("url"), "source": F.col("source"), "scraped_at": F.lit(run_ts),
             "url_hash": F.col("url_hash"), "summary_max_chars": F.lit(C.SUMMARY_MAX_CHARS)}
    out = [(fixed[n] if n in fixed else cols[n]).alias(n) for n in E.ARTICLE_COLUMNS]
    return df.select(*out, "doc_id", F.col("x.confidence").alias("confidence"))
