"""Write the physical plans of the headline queries to docs/PLANS.md.

usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from parcelle.queries import REGISTRY  # noqa: E402
from parcelle.session import local_session  # noqa: E402

KEYS = ["clean_sales", "building_sales", "land_sales", "sale_points", "jdbc_filter",
        "landing_manifest", "region_filter", "flatten_json"]


def final_plan(df) -> str:
    """Run the frame's own query execution (JVM side, nothing collected) so
    the adaptive plan printed is the final one."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString()


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    head = (ROOT / "docs" / "PLANS.head.md").read_text()
    parts = [head.rstrip(), ""]
    for key in KEYS:
        df = REGISTRY[key](spark, sf_dir)
        parts += [f"## {key}", "", "```", final_plan(df).rstrip(), "```", ""]
    (ROOT / "docs" / "PLANS.md").write_text("\n".join(parts))


if __name__ == "__main__":
    main(sys.argv)
