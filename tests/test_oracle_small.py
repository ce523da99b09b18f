"""A few registered queries against their DuckDB oracle on the smallest tables."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from oracle_check import digest  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = ["url_keys", "host_routing", "doc_summary", "doc_articles", "doc_site_guardian", "content_dedup",
         "site_url_rules", "parse_dates", "meta_dates", "quality_by_source"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("pages", "documents", "events", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
