"""A sink of the user's own: two phases, nothing left of a failed job."""
import json
import os

import pytest
from pyspark.sql import functions as F

from quire.session import is_local
from quire.sources.custom import SINKS, Sink, committed_files, json_lines, register_sink
from quire.sources.sinks import write_articles


@pytest.fixture
def tagged(spark):
    def encode(rows):
        return b"".join(f"<{r['id']}|{r['title']}>".encode() for r in rows)
    yield register_sink(spark, Sink("tagged_rows", ".tag", encode, header=b"begin ", footer=b" end", rows_at_once=3))
    del SINKS["tagged_rows"]


def rows(spark, n, parts):
    return spark.range(0, n, 1, parts).select("id", F.concat(F.lit("title "), F.col("id").cast("string")).alias("title"))


def read(path):
    out = []
    for f in committed_files(str(path)):
        with open(f) as g:
            text = g.read()
        assert text.startswith("begin ") and text.endswith(" end")
        out += [int(x.split("|")[0]) for x in text[6:-4].strip("<>").split("><")]
    return sorted(out)


def test_rows_are_written_once_and_appended(spark, tagged, tmp_path):
    path = tmp_path / "out"
    assert committed_files(str(path)) == []
    write_articles(rows(spark, 20, 4), "tagged_rows", path=str(path))
    assert read(path) == list(range(20)) and len(committed_files(str(path))) == 4
    write_articles(rows(spark, 5, 8), "tagged_rows", path=str(path))  # some tasks have no rows
    assert read(path) == sorted([*range(20), *range(5)])
    write_articles(rows(spark, 3, 1), "tagged_rows", path=str(path), mode="overwrite")
    assert read(path) == [0, 1, 2]
    assert not os.listdir(path / "_staged")


def test_a_failing_task_leaves_no_output(spark, tagged, tmp_path):
    path = tmp_path / "out"
    bad = rows(spark, 40, 4).withColumn("title", F.when(F.col("id") == 37, F.expr("raise_error('broken row')")).otherwise(F.col("title")))
    with pytest.raises(Exception, match="broken row"):
        write_articles(bad, "tagged_rows", path=str(path))
    assert committed_files(str(path)) == []
    assert [f for _, _, files in os.walk(path) for f in files] == []


def test_json_lines_and_unknown_names(spark, tmp_path):
    assert [json.loads(x) for x in json_lines([{"a": "ü", "b": None}]).decode().splitlines()] == [{"a": "ü", "b": None}]
    with pytest.raises(ValueError, match="Unknown sink"):
        write_articles(rows(spark, 1, 1), "nowhere")


def test_only_one_process_may_have_a_folder_of_its_own():
    assert is_local("local") and is_local("local[8]") and not is_local("local-cluster[3,2,1024]") and not is_local("yarn")
