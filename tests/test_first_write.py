"""First write wins over a replayed stream with late rows, against the batch job."""
import random

from pyspark.sql import functions as F

from quire.operators.dedup import keep_first
from quire.streaming import streams

SCHEMA = "url_hash string, page_id long, minute long, text string"


def test_first_write_equals_batch(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", streams.ROCKSDB)
    try:
        rng = random.Random(5)
        rows = [(f"k{rng.randrange(25)}", k, rng.randrange(0, 50), f"text {k}") for k in range(200)]
        rows += [("tie", 900 + k, 7, f"tie {k}") for k in range(3)] + [(None, 950, 3, "no key")]
        end = [("end", 9999, 600, "moves the watermark")]
        src = str(tmp_path / "src")
        # files arrive out of order, one of them twice; the last one moves the watermark past all timers
        for n, part in enumerate([rows[100:], rows[:100], rows[100:150], end, [("end2", 10_000, 2000, "and on")], rows[:50]]):
            df = spark.createDataFrame(part, SCHEMA).withColumn("fetched_at", F.timestamp_seconds(F.lit(1767225600) + F.col("minute") * 60)).drop("minute")
            df.coalesce(1).write.mode("append").parquet(f"{src}/{n}")
        schema = "url_hash string, page_id long, text string, fetched_at timestamp"
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
        out = str(tmp_path / "out")
        streams.run_available_now(streams.first_write_stream(stream, delay="3 hours"), "first-write", output_path=out)
        got = spark.read.parquet(out).where("url_hash is null or url_hash not like 'end%'")
        whole = spark.createDataFrame(rows, SCHEMA).withColumn("fetched_at", F.timestamp_seconds(F.lit(1767225600) + F.col("minute") * 60))
        want = keep_first(whole, "url_hash", ["fetched_at", "page_id"], ["url_hash", "page_id", "text"])
        assert sorted(map(str, got.select("url_hash", "page_id", "text").collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
