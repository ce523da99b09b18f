"""Structured Streaming jobs (T1-T3) over a stream of stored pages.

The page jobs are map-only (route, parse, classify, extract), so the same plan runs on a
stream. Output goes through ``foreachBatch`` to the batch writers (K1/K3): the insert-if-absent
writer is idempotent per key, so a replayed micro-batch after a failure writes nothing twice.
Dedup, first write wins (arbitrary state with timers) and per-hour failure rates are stateful and bounded by a watermark on ``fetched_at``.
Checkpoints live under the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quire.operators.extract import article_rows
from quire.plans.articles import classify_pages, route_pages
from quire.session import scratch_path
from quire.sources.registry import Source, default_registry

PAGES_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("feed_author", T.StringType()),
    T.StructField("feed_summary", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
])


def page_stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """T1 source: Parquet page files arriving in ``path``."""
    return spark.readStream.schema(PAGES_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(path)


def article_stream(pages: DataFrame, run_ts: str, registry: list[Source] | None = None) -> DataFrame:
    """Articles of a page stream (same map-only plan as the batch job), with fetched_at."""
    reg = registry if registry is not None else default_registry()
    classified = classify_pages(route_pages(pages, reg))
    return article_rows(classified.where(F.col("is_article_page")), run_ts, extra=("source_name", "page_id", "fetched_at"))


def dedup_stream(articles: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop repeats of a url_hash seen within the watermark delay (state is bounded by
    the watermark; a re-crawl later than that reappears — the insert-if-absent sink is the
    exact guard)."""
    return articles.withWatermark("fetched_at", delay).dropDuplicatesWithinWatermark(["url_hash"])


class FirstWrite(StatefulProcessor):
    """Of the rows of a key, the first by (time, the other columns of ``order``): kept in state until the watermark
    has passed the first row's time by ``wait_ms``, then given out. Afterwards only a mark is left, by
    which replays and later rows are known."""

    def __init__(self, schema: T.StructType, order: list[str], wait_ms: int, time: str):
        self.schema, self.order, self.wait_ms, self.time = schema, order, wait_ms, time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", self.schema)
        self.given = handle.getValueState("given", "at long")

    def handleInputRows(self, key, rows, timerValues):
        if self.given.exists():
            return iter(())
        held = self.best.exists()
        best = Row(**dict(zip(self.schema.names, self.best.get()))) if held else None
        rank = lambda r: tuple((r[c] is not None, r[c]) for c in (self.time, *self.order))
        first = min(rows if best is None else [best, *rows], key=rank)
        self.best.update(tuple(first[c] for c in self.schema.names))
        if not held:
            self.handle.registerTimer(first[self.time] + self.wait_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        best = Row(**dict(zip(self.schema.names, self.best.get())))
        self.best.clear()
        self.given.update((expiredTimerInfo.getExpiryTimeInMs(),))
        yield best

    def close(self) -> None:
        pass


#: State stores that arbitrary state needs.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_write_stream(articles: DataFrame, delay: str = "1 hour", wait_ms: int = 3_600_000, order: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """T2 with K3: exactly one article for each url_hash, the first by fetched_at and ``order``, also where rows come
    late (within ``delay`` of the newest) or a stream is replayed: as the batch job's keep-first. Rows without
    fetched_at are never given out. Needs the state store ROCKSDB (``spark.sql.streaming.stateStore.providerClass``)."""
    ms = "__fetched_ms"
    rows = articles.withColumn(ms, F.unix_millis("fetched_at")).where(F.col(ms).isNotNull()).withWatermark("fetched_at", delay)
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    kept = rows.groupBy("url_hash").transformWithState(FirstWrite(plain, list(order), wait_ms, ms), plain, "Append", "EventTime")
    return kept.drop(ms)


def failure_rate_stream(articles: DataFrame, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Failure rate per source and hourly window of fetch time (append mode: a window is
    emitted once the watermark passes its end)."""
    return (articles.withWatermark("fetched_at", delay)
            .groupBy(F.window("fetched_at", window).alias("w"), "source")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("parse_ok")).alias("n_failed"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "source", "n",
                    "n_failed", F.round(F.col("n_failed") / F.col("n"), 4).alias("failure_rate")))


def run_available_now(df: DataFrame, name: str, sink: Callable[[DataFrame, int], None] | None = None,
                      output_path: str | None = None, mode: str = "append") -> None:
    """Run a streaming DataFrame over everything available now, then stop.

    Either ``sink`` (called per micro-batch through ``foreachBatch``) or ``output_path``
    (Parquet files) receives the rows; the checkpoint goes to the shared checkpoint folder."""
    spark = df.sparkSession
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", scratch_path(spark, f"stream-{name}"))
    if sink is not None:
        writer = writer.foreachBatch(sink)
    else:
        writer = writer.format("parquet").option("path", output_path)
    writer.trigger(availableNow=True).start().awaitTermination()
