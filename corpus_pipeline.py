"""The corpus pipeline: raw documents to a mix of sources. Each stage takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next stage's ``docs``. All
but the last return the columns of ``documents``; the last adds size, source_size, target, taken."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quire.llm import decontam, langid, mixing, pii, simhash
from quire.llm.common import prepare, table
from quire.session import scratch_path


def _stage(f):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        return f(spark, docs, sf_dir)
    return run


STAGES = [
    ("language ID", _stage(langid.stage)),
    ("SimHash near-dedup", _stage(simhash.stage)),
    ("benchmark decontamination", _stage(decontam.stage)),
    ("PII", _stage(pii.stage)),
    ("mixing", _stage(mixing.stage)),
]

#: A learned language model, fingerprints and keyed permutations are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows rest in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, f) in enumerate(STAGES):
        docs = f(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}/{k}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
