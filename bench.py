"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; print one JSON line.

Each query is fully executed with the ``noop`` writer (every row computed, nothing collected
to the driver). Time per query includes planning.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quire.plans.catalog import QUERIES  # noqa: E402
from quire.session import local_session  # noqa: E402
from quire.sources.tables import SCAN_PARTITIONS  # noqa: E402

HEADLINE = [
    "page_articles",     # HTML step + classification + extraction (the article table)
    "followed_links",    # links, resolution, URL rules, 100-per-page window
    "frontier",          # + url key, dedup aggregate, anti join with stored pages
    "url_keys",          # canonical URL + hash + host
    "url_dedup",         # U1 keep-first per canonical URL
    "doc_articles",      # generic mapping on documents (gate, summary, fingerprint)
    "doc_site_nbc",      # site mapping on documents (promo filter, ladder, verdict)
    "content_dedup",     # U2 keep-first per fingerprint
    "quality_report",    # A1
    "site_url_rules",    # F3-F10 on event URLs
    "parse_dates",       # X5 on event date strings
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="quire-bench")
    # the bench tables are one row group each: deal them to the cores
    spark.conf.set(SCAN_PARTITIONS, cpus if cpus.isdigit() else "8")
    # warm-up: start the JVM-side machinery and the Python workers once
    QUERIES["html_nodes"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
