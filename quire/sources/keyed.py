"""A table of unique keys with a membership index.

Layout of a ``KeyedTable`` at a path: ``data/batch=<id>/bucket=<n>`` holds the rows, dealt to buckets by a
hash of the key; ``bloom/batch=<id>`` a Bloom filter for each bucket, as bitmaps; ``versions/<n>`` names the
batch that made version n. A batch is written first and becomes part of the table when its
version file is created, which only one writer can do (create without overwrite is atomic on HDFS
and on local disks). A writer that finds its version taken tests its rows against the batches that came
between, and tries the next version. So a failed or beaten writer leaves files that nobody reads, and keys
stay unique with any number of writers.

``absent`` asks the filters of the buckets that the rows' keys fall in. Keys that a filter does not know
are new for certain; only buckets that may hold a key are read, and of those only the key
column. Filters of all batches of a bucket are merged by OR. Membership is exact: a false
positive costs a read, not a row.

Rows move once, slim: keys, order columns and a hash find the winners; the payload is joined to the rows to be
inserted, and written. Defined results: the first write of a key wins, within a batch the smallest
``order``; a NULL key is in no table, and of the rows without a key a batch inserts the first one; an empty
batch makes no version."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import ensure_checkpoint_dir

#: Buckets of a new table; slices of 32,768 bits that a bucket's filter has; bits set for a key.
BUCKETS, SLICES, BITS = 64, 32, 4
#: Bits of a slice, fixed by Spark's bitmap functions.
SLICE_BITS = 32768


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS, slices: int = SLICES):
        self.spark, self.path, self.key, self.buckets, self.slices = spark, path.rstrip("/"), key, buckets, slices

    # ---- versions

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def batches(self) -> list[str]:
        """The ids of the committed batches, in order."""
        fs, folder = self._fs(f"{self.path}/versions")
        if not fs.exists(folder):
            return []
        names = sorted((s.getPath().getName() for s in fs.listStatus(folder)), key=int)
        return [self._batch(n) for n in names]

    def _batch(self, version: str) -> str:
        fs, p = self._fs(f"{self.path}/versions/{version}")
        for _ in range(50):
            stream = fs.open(p)
            try:
                said = bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
            if len(said) == 32:
                return said
            time.sleep(0.1)  # its writer is between create and close
        raise RuntimeError(f"version {version} of {self.path} names no batch; its writer died while it wrote the file")

    def _commit(self, version: int, batch: str) -> bool:
        """Make ``batch`` the given version; False if there is one."""
        fs, p = self._fs(f"{self.path}/versions/{version}")
        try:
            stream = fs.create(p, False)
        except Exception as e:  # py4j wraps the file system's exception
            if fs.exists(p):
                return False
            raise e
        try:
            stream.write(bytearray(batch.encode()))
        finally:
            stream.close()
        return True

    # ---- reading

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(7), key), F.lit(self.buckets)).cast("int")

    def _read(self, kind: str, batches: list[str], buckets: list[int] | None) -> DataFrame:
        df = self.spark.read.option("basePath", f"{self.path}/{kind}").parquet(*[f"{self.path}/{kind}/batch={b}" for b in batches])
        return df if buckets is None else df.where(F.col("bucket").isin(buckets))

    def rows(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The table, or some of its buckets; None before the first version."""
        batches = self.batches()
        return self._read("data", batches, buckets).drop("batch", "bucket") if batches else None

    # ---- the index

    def _places(self, key: Column) -> Column:
        """The key's bits in its bucket's filter, 1 .. slices * SLICE_BITS (as the bitmap functions count)."""
        n = self.slices * SLICE_BITS
        return F.array(*[F.pmod(F.xxhash64(F.lit(k), key), F.lit(n)) + 1 for k in range(BITS)])

    def filters(self, rows: DataFrame) -> DataFrame:
        """(bucket, slice, bits) of the keys of ``rows``."""
        key = F.col(self.key)
        bits = rows.where(key.isNotNull()).select(self.bucket(key).alias("bucket"), F.explode(self._places(key)).alias("place"))
        return bits.groupBy("bucket", F.bitmap_bucket_number("place").alias("slice")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))

    def maybe(self, keys: DataFrame, batches: list[str]) -> DataFrame:
        """The keys (column ``key``, distinct) that the filters do not rule out, with their bucket."""
        asked = keys.where(F.col("key").isNotNull()).select("key", self.bucket(F.col("key")).alias("bucket"), F.explode(self._places(F.col("key"))).alias("place"))
        asked = asked.select("key", "bucket", F.bitmap_bucket_number("place").alias("slice"), F.bitmap_bit_position("place").alias("bit"))
        known = self._read("bloom", batches, None).groupBy("bucket", "slice").agg(F.bitmap_or_agg("bits").alias("bits"))
        byte = F.conv(F.hex(F.substring("bits", (F.floor(F.col("bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        is_set = byte.bitwiseAND(F.lit(1).cast("int") * F.pow(F.lit(2), F.col("bit") % 8).cast("int")) > 0
        return asked.join(known, ["bucket", "slice"]).where(is_set).groupBy("key", "bucket").agg(F.count("*").alias("n")).where(F.col("n") == BITS).drop("n")

    def absent(self, rows: DataFrame, batches: list[str] | None = None) -> DataFrame:
        """The rows whose key is not in the table (of all versions, or of some batches)."""
        batches = self.batches() if batches is None else batches
        if not batches:
            return rows
        ensure_checkpoint_dir(self.spark)
        maybe = self.maybe(rows.select(F.col(self.key).alias("key")).distinct(), batches).checkpoint()
        buckets = sorted(r["bucket"] for r in maybe.select("bucket").distinct().collect())  # at most self.buckets numbers
        self.last_read = buckets
        if not buckets:
            return rows
        stored = self._read("data", batches, buckets).select(F.col(self.key).alias("key"))
        seen = maybe.join(stored.where(F.col("key").isNotNull()), "key", "left_semi").select(F.col("key").alias("__seen"))
        joined = rows.join(seen, rows[self.key].eqNullSafe(seen["__seen"]), "left")
        return joined.where(F.col("__seen").isNull()).drop("__seen")

    # ---- writing

    def insert(self, rows: DataFrame, order: list[str] | None = None) -> DataFrame:
        """Insert the rows whose key is not there yet; returns what was inserted."""
        order = order or [c for c in rows.columns if c != self.key][:1] or [self.key]
        at, n = len(self.batches()), "__row"
        # what decides: the smallest order, then a hash of the row
        marked = rows.withColumn(n, F.xxhash64(*rows.columns))
        first = F.min(F.struct(*order, n)).alias("__first")
        winners = self.absent(marked.select(*dict.fromkeys([self.key, *order, n])), self.batches()).groupBy(self.key).agg(first)
        winners = winners.select(F.col(self.key).alias("__key"), F.col(f"__first.{n}").alias("__hash"))
        new = marked.join(winners, marked[self.key].eqNullSafe(winners["__key"]) & (marked[n] == winners["__hash"]), "left_semi")
        new = new.dropDuplicates([self.key, n]).drop(n)
        while True:
            batch = self._stage(new)
            staged = self.spark.read.schema(rows.schema).parquet(f"{self.path}/data/batch={batch}").select(*rows.columns)
            if staged.isEmpty():
                return staged
            while True:
                if self._commit(at, batch):
                    return staged
                # another writer was first: its batches may hold some of these keys
                since = self.batches()[at:]
                at += len(since)
                left = self.absent(staged, since)
                if left.count() < staged.count():
                    new = left
                    break

    def _stage(self, new: DataFrame) -> str:
        batch = uuid.uuid4().hex
        where = f"{self.path}/{{}}/batch={batch}"
        bucketed = new.withColumn("bucket", self.bucket(F.col(self.key)))
        # rebalance puts a bucket's rows together and splits a bucket that is large
        bucketed.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(where.format("data"))
        staged = self.spark.read.schema(new.schema).parquet(where.format("data"))
        self.filters(staged).write.parquet(where.format("bloom"))
        return batch
