"""K1-K8: writers for the article table, chosen by name.

Every writer is a distributed DataFrame write (task-parallel files, commit protocol); a
failing write fails the job instead of being logged and skipped.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.dedup import insert_if_absent
from quire.session import ensure_checkpoint_dir
from quire.sources.custom import SINKS, write_sink
from quire.sources.keyed import KeyedTable


def kafka_messages(articles: DataFrame) -> DataFrame:
    """K2 projection: one JSON message per row, nulls kept, no key."""
    return articles.select(F.lit(None).cast("binary").alias("key"),
                           F.to_json(F.struct(*articles.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_jsonl_per_source(articles: DataFrame, path: str, by: str = "source_name") -> None:
    """K1: JSON lines, one directory per source, overwriting only the sources written
    (dynamic partition overwrite), UTF-8 unescaped, nulls kept. Rows are regrouped by source
    first, so a small source is one file and a large one is split by size."""
    (articles.hint("rebalance", F.col(by)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("ignoreNullFields", "false").partitionBy(by).json(path))


def write_kafka(articles: DataFrame, bootstrap_servers: str, topic: str = "raw_news") -> None:
    """K2: one message per article to a topic (needs the Kafka connector on the classpath)."""
    (kafka_messages(articles).write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save())


def write_insert_if_absent(articles: DataFrame, path: str, key: str = "url", order: list[str] | None = None) -> DataFrame:
    """Append rows whose key is not yet in the Parquet table at ``path`` (first write
    wins); returns what was appended. A missing table is created; any other trouble with the
    table fails the write. Writers of the same table must take turns."""
    spark = articles.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        target = spark.read.parquet(path)
    else:
        target = articles.limit(0)
    ensure_checkpoint_dir(spark)
    new = insert_if_absent(target, articles, key, order).checkpoint()
    new.write.mode("append").parquet(path)
    return new


def write_keyed(articles: DataFrame, path: str, key: str = "url", order: list[str] | None = None) -> DataFrame:
    """K3/J4 into a ``KeyedTable``: only buckets that may hold a key are read, and any number of writers
    keep keys unique."""
    return KeyedTable(articles.sparkSession, path, key).insert(articles, order)


def write_jsonl(articles: DataFrame, path: str) -> None:
    """K4 (and K5, re-aimed: a JSON array file cannot be written in parallel)."""
    articles.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(articles: DataFrame, path: str) -> None:
    """K6."""
    articles.write.mode("overwrite").option("header", True).csv(path)


def write_xml(articles: DataFrame, path: str) -> None:
    """K7: one ``<item>`` element per article."""
    articles.write.mode("overwrite").format("xml").option("rowTag", "item").option("rootTag", "items").save(path)


WRITERS: dict[str, Callable[..., object]] = {
    "jsonl_per_source": write_jsonl_per_source,
    "kafka": write_kafka,
    "insert_if_absent": write_insert_if_absent,
    "keyed": write_keyed,
    "jsonl": write_jsonl,
    "json": write_jsonl,
    "csv": write_csv,
    "xml": write_xml,
}
BY_SUFFIX = {".jsonl": "jsonl", ".json": "json", ".csv": "csv", ".xml": "xml"}


def write_articles(articles: DataFrame, sink: str, **options) -> object:
    """K8: dispatch by sink name (built in, or registered with ``quire.sources.custom.register_sink``), or by the
    output path's suffix when ``sink`` is a path."""
    name = sink
    if sink in SINKS:
        return write_sink(articles, sink, **options)
    if sink not in WRITERS:
        for suffix, n in BY_SUFFIX.items():
            if sink.endswith(suffix):
                return WRITERS[n](articles, sink, **options)
        known = ", ".join(sorted(WRITERS))
        raise ValueError(f"Unknown sink '{sink}'. Known sinks: {known}; or a path ending in "
                         f"{', '.join(BY_SUFFIX)}")
    return WRITERS[name](articles, **options)
