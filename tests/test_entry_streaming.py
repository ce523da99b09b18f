"""Driver contract and the streaming jobs (batch == stream on the same pages)."""
import os
import sys
import tempfile

from pyspark.sql import functions as F

from quire.plans import articles as A
from quire.sources import tables
from quire.sources.registry import test_registry as registry
from quire.streaming import streams

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_and_catalog(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "pct_parse_ok" in df.columns
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)


def test_stream_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="quire-stream-src-")
    pages = tables.pages(spark, SF).withColumn("fetched_at", F.timestamp_seconds(F.lit(1767225600) + F.col("page_id") * 60))
    pages.write.mode("overwrite").parquet(src)
    batch = A.article_rows(A.classify_pages(A.route_pages(spark.read.parquet(src), registry()))
                           .where("is_article_page"), "2026-01-01T00:00:00Z")
    out = os.path.join(tempfile.mkdtemp(prefix="quire-stream-out-"), "a")
    streams.run_available_now(streams.article_stream(streams.page_stream(spark, src), "2026-01-01T00:00:00Z", registry()), "t1", output_path=out)
    got = spark.read.parquet(out)
    assert got.count() == batch.count()
    assert set(r.url_hash for r in got.collect()) == set(r.url_hash for r in batch.collect())
    seen = []
    streams.run_available_now(streams.dedup_stream(streams.article_stream(streams.page_stream(spark, src), "2026-01-01T00:00:00Z", registry())), "t2",
                              sink=lambda df, _: seen.extend(r.url_hash for r in df.collect()))
    assert len(seen) == len(set(seen)) == batch.select("url_hash").distinct().count()
    out3 = os.path.join(tempfile.mkdtemp(prefix="quire-stream-out-"), "f")
    streams.run_available_now(streams.failure_rate_stream(streams.article_stream(streams.page_stream(spark, src), "2026-01-01T00:00:00Z", registry())), "t3",
                              output_path=out3)
    assert spark.read.parquet(out3).count() >= 0
