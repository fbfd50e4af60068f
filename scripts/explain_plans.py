"""Write PLANS.md: condensed physical plans of the headline rollups.

    python scripts/explain_plans.py [sf_dir]

For each query two plans are shown: with the default broadcast bound (dimensions counted
small at this scale) and with the bound forced to 10 rows (the plan a cluster-scale account
table gets: shuffle joins, pre-aggregation, hot-key split). Only the operator tree and the
scan lines (pushed filters, read schema) are kept.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bankroll.catalog import run_query  # noqa: E402
from bankroll.operators import joins  # noqa: E402
from bankroll.session import get_session  # noqa: E402
from bankroll.sources import testdata  # noqa: E402

NAMES = ["q1", "q2", "q3", "q3r", "q4", "q5b", "q6", "qc3"]
KEEP = re.compile(r"^(\s*[:+|-].*|\S.*\(\d+\)\s*$|PushedFilters.*|ReadSchema.*|Arguments: (hashpartitioning|rangepartitioning).*)$")


def condensed(df) -> str:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    lines = []
    for line in text.splitlines():
        if line.startswith("===") or not line.strip():
            continue
        if KEEP.match(line) and not line.startswith("Output") and not line.startswith("Input"):
            lines.append(line)
    return "\n".join(lines)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    out = ["# Physical plans of the headline rollups", "",
           f"Generated by `scripts/explain_plans.py` on `{sf_dir}` (local[8]).", ""]
    for bound, title in ((None, "default broadcast bound"), ("10", "dimension over the bound")):
        testdata._TABLES.clear()
        if bound:
            spark.conf.set(joins.CONF_MAX_BROADCAST_ROWS, bound)
            spark.conf.set(joins.CONF_HOT_KEY_ROWS, "50")
        else:
            spark.conf.unset(joins.CONF_MAX_BROADCAST_ROWS)
            spark.conf.unset(joins.CONF_HOT_KEY_ROWS)
        out += [f"## {title}", ""]
        for name in NAMES:
            out += [f"### {name}", "", "```", condensed(run_query(spark, name, sf_dir)), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
