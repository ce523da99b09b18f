"""Counters that the writes collect, and the report with subtotals."""
from pyspark.sql import functions as F

from quire.operators import reports


def classified(spark):
    rows = [(1, "a", True, None), (2, "b", False, None), (3, "c", False, "broken markup"), (4, "d", True, "broken markup"), (5, "e", False, "broken too")]
    return spark.createDataFrame(rows, "page_id long, url_hash string, is_article_page boolean, parse_error string").repartition(3)


def items_of(pages):
    return pages.where("is_article_page").select("page_id", F.col("parse_error").isNull().alias("parse_ok"), F.lit("2026-01-01T00:00:00Z").alias("scraped_at"))


def test_observed_metrics_equal_the_counters(spark, tmp_path):
    pages = classified(spark)
    requests = spark.createDataFrame([("a",), ("b",), ("a",), ("z",)], "url_hash string")
    found = reports.observed_run(requests, pages, items_of, str(tmp_path))
    want = reports.run_counters(requests, pages, items_of(pages)).first().asDict()
    assert found == want
    assert (found["requests"], found["responses"], found["items"], found["items_failed"], found["errors"]) == (3, 5, 2, 1, 2)
    assert spark.read.parquet(str(tmp_path / "items")).count() == 2 and spark.read.parquet(str(tmp_path / "requests")).count() == 3


def test_subtotals(spark):
    rows = [("x", "dom", True, "t"), ("x", "dom", False, None), ("x", "ld", True, "t"), (None, "dom", True, "")]
    df = spark.createDataFrame(rows, "source string, m string, parse_ok boolean, title string")
    df = df.select("*", *[F.lit(None).cast("string").alias(c) for c in ("author", "text", "published_at")])
    found = {(r.source, r.m, r.level): (r.n, r.parse_ok, r.has_title) for r in reports.quality_rollup(df, ["source", "m"]).collect()}
    assert found == {("x", "dom", 0): (2, 1, 1), ("x", "ld", 0): (1, 1, 1), (None, "dom", 0): (1, 1, 0), ("x", None, 1): (3, 2, 2),
                     (None, None, 1): (1, 1, 0), (None, None, 3): (4, 3, 2)}
