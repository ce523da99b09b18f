"""Table scans. Pages, documents and events are read as Parquet; optional page columns
that a table does not carry (content type, feed author, fetch time) are added as NULL so
every job sees the same ``PAGES`` schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_OPTIONAL = {"content_type": "string", "feed_author": "string", "feed_summary": "string", "fetched_at": "timestamp"}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


#: Setting by which a caller may ask for a table's rows to be dealt to so many tasks before the
#: CPU-heavy steps. It is for small tables written as one row group, which Spark reads as one task.
#: Unset, nothing is shuffled, whatever the size of the table.
SCAN_PARTITIONS = "quire.scan.partitions"


def spread(df: DataFrame) -> DataFrame:
    """As the caller's setting says; see SCAN_PARTITIONS."""
    n = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(n)) if n else df


def pages(spark: SparkSession, sf_dir: str, with_html: bool = True) -> DataFrame:
    """PAGES: page_id, url, html, content_type, feed_author, feed_summary, fetched_at."""
    df = read_table(spark, sf_dir, "pages")
    for c, t in PAGE_OPTIONAL.items():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(t))
    cols = ["page_id", "url"] + (["html"] if with_html else []) + list(PAGE_OPTIONAL)
    df = df.select(*cols)
    return spread(df) if with_html else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "documents"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "labels")
