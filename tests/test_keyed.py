"""The keyed table: membership, first write wins, two writers at once, what an insert reads."""
import random
import threading

import pytest
from pyspark.sql import functions as F

from quire.sources import keyed
from quire.sources.keyed import KeyedTable

SCHEMA = "url string, at int, text string"


def made(spark, keys, at, text="t"):
    return spark.createDataFrame([(k, at, f"{text} {k}") for k in keys], SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), "url", buckets=16, slices=2)


def test_first_write_wins_and_keys_stay_unique(spark, table):
    assert table.rows() is None and table.absent(made(spark, ["a"], 1)).count() == 1
    one = table.insert(made(spark, ["a", "b", "c"], 1), ["at"])
    assert sorted(r.url for r in one.collect()) == ["a", "b", "c"]
    batch = made(spark, ["b", "d", "e"], 2).union(made(spark, ["d", "e"], 1, "earlier")).union(made(spark, ["e"], 1, "earlier"))
    two = table.insert(batch, ["at"])
    assert sorted((r.url, r.at, r.text) for r in two.collect()) == [("d", 1, "earlier d"), ("e", 1, "earlier e")]
    assert sorted((r.url, r.text) for r in table.rows().collect()) == [("a", "t a"), ("b", "t b"), ("c", "t c"), ("d", "earlier d"), ("e", "earlier e")]
    # a replay inserts nothing and makes no version
    versions = len(table.batches())
    assert table.insert(batch, ["at"]).count() == 0 and len(table.batches()) == versions
    assert table.insert(made(spark, [], 1), ["at"]).count() == 0


def test_null_keys(spark, table):
    rows = made(spark, ["a"], 1).union(made(spark, [None, None], 2)).union(made(spark, [None], 1))
    assert sorted((r.url or "", r.at) for r in table.insert(rows, ["at"]).collect()) == [("", 1), ("a", 1)]
    assert [r.url for r in table.insert(rows, ["at"]).collect()] == [None]


def test_membership_is_exact_beyond_the_filter(spark, table):
    """Filters so full that they rule little out give the same rows."""
    rng = random.Random(1)
    small = KeyedTable(spark, table.path, "url", buckets=2, slices=1)
    stored = [f"k{rng.randrange(60_000)}" for _ in range(20_000)]
    small.insert(made(spark, stored, 1), ["at"])
    asked = [f"k{k}" for k in range(0, 60_000, 7)]
    left = {r.url for r in small.absent(made(spark, asked, 2)).collect()}
    assert left == set(asked) - set(stored)


def test_an_insert_reads_only_buckets_that_may_hold_its_keys(spark, table):
    table.insert(made(spark, [f"k{k}" for k in range(500)], 1), ["at"])
    assert table.absent(made(spark, ["k3"], 2)).count() == 0 and len(table.last_read) == 1
    assert table.absent(made(spark, ["new one"], 2)).count() == 1 and len(table.last_read) <= 1
    plan = table._read("data", table.batches(), table.last_read or [0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket#" in plan.split("PartitionFilters")[1][:120]


def test_a_beaten_writer_keeps_keys_unique(spark, table):
    table.insert(made(spark, ["a"], 1), ["at"])
    mine, other = KeyedTable(spark, table.path, "url", 16, 2), KeyedTable(spark, table.path, "url", 16, 2)
    stage = mine._stage

    def staged(new):
        batch = stage(new)
        if other is not None and len(other.batches()) == 1:
            other.insert(made(spark, ["b", "c"], 5, "other"), ["at"])  # commits between staging and commit
        return batch

    mine._stage = staged
    got = {r.url for r in mine.insert(made(spark, ["a", "c", "d"], 2), ["at"]).collect()}
    assert got == {"d"}
    assert sorted((r.url, r.text.split()[0]) for r in table.rows().collect()) == [("a", "t"), ("b", "other"), ("c", "other"), ("d", "t")]
    assert len(table.batches()) == 3


def test_two_writers_at_once(spark, table):
    done = []

    def write(name):
        t = KeyedTable(spark, table.path, "url", 16, 2)
        done.append(t.insert(made(spark, [f"k{k}" for k in range(0, 60, 1 if name == "x" else 2)], 1, name), ["at"]).count())

    threads = [threading.Thread(target=write, args=(n,)) for n in "xy"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    rows = table.rows()
    assert rows.count() == rows.select("url").distinct().count() == 60 == sum(done)


def test_a_failed_writer_leaves_the_table_as_it_was(spark, table):
    table.insert(made(spark, ["a"], 1), ["at"])
    broken = made(spark, ["b"], 1).withColumn("text", F.expr("raise_error('no')"))
    with pytest.raises(Exception, match="no"):
        table.insert(broken, ["at"])
    assert [r.url for r in table.rows().collect()] == ["a"] and keyed.BITS == 4
