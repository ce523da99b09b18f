"""U1/U2/W2 dedup, A7 duplicate groups, K3/J4 insert-if-absent.

Keep-first per key is an aggregate, not a window: ``min_by(row, order)`` runs a partial
(map-side) aggregate before the shuffle, so a key holding a third of all rows arrives at its
reducer as one row per map task instead of as one giant window partition. The winner is the
smallest ``order`` (e.g. scraped_at, then page_id), so the result is deterministic. Only the
columns asked for travel with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str, order: list[str], columns: list[str] | None = None) -> DataFrame:
    """One row per ``key``: the row with the smallest ``order`` tuple. ``columns``: what the
    result needs (all columns by default); other columns are dropped before the shuffle."""
    columns = columns or df.columns
    payload = [c for c in columns if c != key]
    slim = df.select(*dict.fromkeys([key, *order, *payload]))
    winner = F.min_by(F.struct(*payload), F.struct(*order)).alias("_w")
    return slim.groupBy(key).agg(winner).select(*[F.col(key) if c == key else F.col("_w." + c).alias(c) for c in columns])


def dedup_by_url(articles: DataFrame, order: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Same canonical URL (``url_hash``) = same article."""
    return keep_first(articles, "url_hash", order or ["scraped_at", "url"], columns)


def dedup_by_content(articles: DataFrame, order: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Same content fingerprint across URLs = same article."""
    return keep_first(articles, "fingerprint", order or ["scraped_at", "url"], columns)


def duplicate_groups(df: DataFrame, key: str, first: str) -> DataFrame:
    """Keys held by more than one row, with the row count and the first ``first`` value."""
    return (df.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min(first).alias("first_" + first))
            .where(F.col("n_rows") > 1))


def insert_if_absent(target: DataFrame, batch: DataFrame, key: str = "url",
                     order: list[str] | None = None) -> DataFrame:
    """Rows of ``batch`` to append to ``target`` so that ``key`` stays unique and the
    first write wins: keys already in the target are removed first (the target's side of the join
    is its distinct keys), then the rest is reduced to one row per key (first by ``order``)."""
    return keep_first(anti_join(batch, target, key), key, order or [key])


def anti_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose ``key`` is not in ``right``.

    Written as a left outer join on the distinct right keys plus an IS NULL filter: a
    ``left_anti`` join gets pushed below aggregates and projections of the left side, which
    re-inlines every staged key expression there (planning blows up); the outer join is not. The
    null-safe comparison spares the right side an inferred filter, for the same reason. A NULL
    key is in no table."""
    seen = right.select(F.col(key).alias("_seen_key")).distinct().withColumn("_seen", F.lit(True))
    joined = left.join(seen, left[key].eqNullSafe(seen["_seen_key"]), "left")
    return joined.where(F.col("_seen").isNull() | F.col(key).isNull()).drop("_seen_key", "_seen")
