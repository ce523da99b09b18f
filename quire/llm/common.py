"""Helpers the operators share: table access, Arrow column maps, stored intermediates, a two-level
prefix sum, and distributed connected components."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quire.session import ensure_checkpoint_dir, ship_package
from quire.sources.tables import read_table

#: Rows per Arrow batch. Texts reach 100 KB and more, so the default of 10,000 rows could hold a GB.
ARROW_ROWS = 512

#: Parts that a node's edges are cut into where they are joined.
HUB_PARTS = 128

#: Seconds that Spark gets to delete files that nothing refers to.
RELEASE_SECONDS = 0.5

#: Pieces that a group's running sum is cut into, so that no group is one task's work.
PREFIX_PIECES = 1024


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package to the executors, name the shared folder, bound the Arrow batches."""
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(prepare(spark), sf_dir, name)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def only(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns, also when names hold dots or back quotes."""
    return df.select(*[df["`" + c.replace("`", "``") + "`"] for c in columns])


def crc_mod(column: str, m: int):
    """crc32 of the value as text, modulo ``m``; NULL for NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(m)


def map_column(df: DataFrame, source: str, name: str, dtype: T.DataType,
               make: Callable[[], Callable[[pa.Array], pa.Array]]) -> DataFrame:
    """Add ``name``, computed from ``source`` one Arrow batch at a time; the other columns pass
    through untouched. ``make`` runs once per task and returns the batch function."""
    at = df.columns.index(source)
    schema = T.StructType([*df.schema.fields, T.StructField(name, dtype)])
    names = [f.name for f in schema.fields]

    def run(batches):
        f = make()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, f(b.column(at))], names=names)

    return df.mapInArrow(run, schema)


def map_columns(df: DataFrame, sources: list[str], fields: list[T.StructField],
                make: Callable[[], Callable[..., list[pa.Array]]]) -> DataFrame:
    """As ``map_column``, from several columns to several new ones."""
    at = [df.columns.index(c) for c in sources]
    schema = T.StructType([*df.schema.fields, *fields])
    names = [f.name for f in schema.fields]

    def run(batches):
        f = make()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, *f(*[b.column(k) for k in at])], names=names)

    return df.mapInArrow(run, schema)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column's values; NULL is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage: one write to the shared folder of ``spark.checkpoint.dir``."""
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that nothing refers to any more: it does so when the driver
    collects its garbage, which a driver with little to do seldom does. What Python let go is free in the JVM
    a moment later, so the garbage is collected twice."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(RELEASE_SECONDS)


def dealt(df: DataFrame, rows: int, rows_a_task: int) -> DataFrame:
    """Small rows that a step turns into many are dealt to enough tasks for that."""
    return df.repartition(max(1, rows // rows_a_task))


def prefix_sum(df: DataFrame, group: list[str], order: list[str], value: str, out: str,
               piece: str, pieces: int = PREFIX_PIECES) -> DataFrame:
    """``out``: the sum of ``value`` over the rows of the same group that come before, in the order
    (``piece``, ``order``); ``piece`` holds 0 .. ``pieces`` - 1.

    A group is summed piece by piece, then the at most ``pieces`` sums of a group are summed, so
    a group that holds a third of all rows is still spread over ``pieces`` tasks."""
    w = Window.partitionBy(*group, piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = df.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))
    over = Window.partitionBy(*group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    start = "__start"
    starts = (df.groupBy(*group, piece).agg(F.sum(value).alias("__sum"))
              .withColumn(start, F.coalesce(F.sum("__sum").over(over), F.lit(0))).drop("__sum"))
    keys = [*group, piece]
    right = starts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], start)
    on = [inner[k].eqNullSafe(right[f"__k{i}"]) for i, k in enumerate(keys)]
    joined = inner.join(right, on, "left")
    return (joined.withColumn(out, (F.col(out) + F.col(start)).cast("long"))
            .drop(start, *[f"__k{i}" for i in range(len(keys))]))


def beside_least(edges: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``edges`` with ``out``, the smallest ``value`` of the row's ``key``.

    A key's rows are cut into HUB_PARTS parts by a hash of the value: minima by part, then by key, then
    dealt back to the parts the key has. So the join's key is (key, part), and a hub that holds a
    third of all edges is spread over many tasks. The table of minima has at most a row for each edge."""
    rows = edges.withColumn("part", F.pmod(F.xxhash64(value), F.lit(HUB_PARTS)).cast("int"))
    by_part = rows.groupBy(key, "part").agg(F.min(value).alias(out))
    by_key = by_part.groupBy(key).agg(F.min(out).alias(out), F.collect_list("part").alias("parts"))
    return rows.join(by_key.select(key, out, F.explode("parts").alias("part")).hint("merge"), [key, "part"]).drop("part")


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """Connected components of the undirected graph with edges (u long, v long).

    Returns (node, root): root is the smallest node that can be reached. Nodes without an edge
    to another node are not returned; an empty graph gives an empty table.

    Large-star and small-star rounds: each points every node at the smallest neighbour it knows,
    until nothing changes, after a number of rounds logarithmic in the size of a component. A
    round is two group minima, pre-aggregated in the map tasks, and two joins with them, in which a
    hub's edges are cut into parts. (Joins are by merging: the sizes that Spark would estimate here
    are those before steps that add rows.) Each round is stored in the shared folder, so a lost
    executor costs one round."""
    e = stored(edges.where("u <> v")
               .select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct())
    seen = None
    for _ in range(most_rounds):
        said = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
        if said == seen or not said["n"]:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
                e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
        seen = said
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        large = (beside_least(both, "u", "v", "m").where("v > u")
                 .select(F.col("v").alias("hi"), F.least("u", "m").alias("lo")).distinct())
        e = stored(beside_least(large, "hi", "lo", "m")
                   .select(F.explode(F.array(F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")),
                                             F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("x"))
                   .select("x.hi", "x.lo").where("hi <> lo").distinct())
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
