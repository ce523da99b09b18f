"""Write PLANS.md: the physical plan of the headline queries with a short summary each
(scans and their ReadSchema, exchanges, aggregates, joins, Python steps)."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quire.plans.catalog import QUERIES  # noqa: E402
from quire.session import local_session  # noqa: E402

NAMES = ["url_keys", "page_articles", "followed_links", "frontier", "url_dedup", "content_dedup",
         "quality_by_source", "insert_if_absent"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/plans_report.py` on `{sf}` (AQE initial plans).", ""]
    for name in NAMES:
        df = QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"#\d+L?", "", plan)
        lines = plan.splitlines()
        summary = {
            "exchanges": sum("Exchange" in ln and "Reused" not in ln for ln in lines),
            "python steps": sum("MapInArrow" in ln or "ArrowEvalPython" in ln or "BatchEvalPython" in ln for ln in lines),
            "aggregates": sorted({m.group(0) for ln in lines for m in [re.search(r"(Hash|Sort|ObjectHash)Aggregate", ln)] if m}),
            "joins": sorted({m.group(0) for ln in lines for m in [re.search(r"\w+Join", ln)] if m}),
            "scans": sorted({re.search(r"ReadSchema: (struct<[^>]*>)", ln).group(1)
                             for ln in lines if "ReadSchema" in ln}),
        }
        out += [f"## {name}", "", "```"] + [f"{k}: {v}" for k, v in summary.items()] + ["```", "", "<details><summary>plan</summary>", "",
                                                                                         "```"] + lines[:120] + ["```", "", "</details>", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    print("wrote PLANS.md")


if __name__ == "__main__":
    main()
