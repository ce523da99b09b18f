"""Sinks (K1-K8) and the registry."""
import json
import os
import tempfile

import pytest

from quire.sources import sinks
from quire.sources.registry import default_registry, seeds_df, select_sources


def _rows(spark):
    return spark.createDataFrame([("Café ☕ 東京", None, "https://a.com/1", "a.com", "a"),
                                  ("Second", "Au", "https://a.com/2", "a.com", "a"),
                                  ("Third", None, "https://b.com/3", "b.com", "b")],
                                 "title string, author string, url string, source string, source_name string")


def test_jsonl_per_source_keeps_unicode_and_nulls(spark):
    out = tempfile.mkdtemp(prefix="quire-sink-")
    sinks.write_jsonl_per_source(_rows(spark), out)
    files = [os.path.join(r, f) for r, _, fs in os.walk(os.path.join(out, "source_name=a")) for f in fs if f.endswith(".json")]
    recs = [json.loads(line) for f in files for line in open(f, encoding="utf-8")]
    assert sorted(r["title"] for r in recs) == ["Café ☕ 東京", "Second"]
    assert all("author" in r for r in recs)
    # a second run for source b only leaves a's files in place
    sinks.write_jsonl_per_source(_rows(spark).where("source_name = 'b'"), out)
    assert os.path.isdir(os.path.join(out, "source_name=a"))


def test_kafka_messages_projection(spark):
    msgs = [json.loads(r.value) for r in sinks.kafka_messages(_rows(spark)).collect()]
    assert msgs[0]["author"] is None and msgs[0]["title"] == "Café ☕ 東京"


def test_write_articles_dispatch(spark):
    base = tempfile.mkdtemp(prefix="quire-sink-")
    sinks.write_articles(_rows(spark), os.path.join(base, "out.csv"))
    sinks.write_articles(_rows(spark), os.path.join(base, "out.xml"))
    sinks.write_articles(_rows(spark), "jsonl", path=os.path.join(base, "j"))
    assert spark.read.option("header", True).csv(os.path.join(base, "out.csv")).count() == 3
    assert spark.read.format("xml").option("rowTag", "item").load(os.path.join(base, "out.xml")).count() == 3
    with pytest.raises(ValueError, match="Unknown sink"):
        sinks.write_articles(_rows(spark), "nosuch")


def test_insert_if_absent_writer_is_idempotent(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="quire-sink-"), "t")
    first = sinks.write_insert_if_absent(_rows(spark), path)
    again = sinks.write_insert_if_absent(_rows(spark), path)
    assert first.count() == 3 and again.count() == 0 and spark.read.parquet(path).count() == 3


def test_registry_consistency_and_selection(spark):
    reg = default_registry()
    names = [s.source_name for s in reg]
    assert len(set(names)) == len(names) == 7
    assert all(s.start_urls for s in reg) and len({s.domain for s in reg}) == 7
    assert [s.source_name for s in select_sources(reg, None)] == sorted(names)
    with pytest.raises(ValueError, match="Known sources: apnews, bbc"):
        select_sources(reg, "nytimes")
    seeds = seeds_df(spark, select_sources(reg, "bbc"), override=" https://x.com/a , ,https://x.com/b ")
    assert [r.url for r in seeds.orderBy("seed_pos").collect()] == ["https://x.com/a", "https://x.com/b"]
    blank = seeds_df(spark, select_sources(reg, "bbc"), override=" , ")
    assert blank.count() == 5


def test_routing_longest_suffix_and_generic(spark):
    from pyspark.sql import functions as F

    from quire.sources.registry import Source, route
    reg = [Source("broad", "example.com", ("example.com",), (), "guardian"),
           Source("narrow", "news.example.com", ("news.example.com",), (), "bbc")]
    df = spark.createDataFrame([("news.example.com",), ("a.news.example.com",), ("example.com",), ("xexample.com",),
                                ("other.org",)], "host string")
    got = {r.host: (r.s.source_name if r.s else None) for r in df.select("host", route(F.col("host"), reg).alias("s")).collect()}
    assert got == {"news.example.com": "narrow", "a.news.example.com": "narrow", "example.com": "broad",
                   "xexample.com": None, "other.org": None}


def test_insert_if_absent_fails_on_a_broken_table(spark, tmp_path):
    path = tmp_path / "t"
    path.mkdir()
    (path / "part-0.parquet").write_bytes(b"not parquet")
    rows = spark.createDataFrame([("u", 1)], "url string, n int")
    with pytest.raises(Exception):
        sinks.write_insert_if_absent(rows, str(path))
    assert [f.name for f in path.iterdir()] == ["part-0.parquet"]
