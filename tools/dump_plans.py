"""Write PLANS.md: the physical plan tree (operators only) of headline queries.

Usage: python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from courtload.plans.registry import QUERIES  # noqa: E402
from courtload.session import build_session  # noqa: E402

HEADLINE = ["player_game_workload", "rolling_workload", "workload_tiers", "back_to_back_analysis",
            "join_training_schedule", "injury_risk_features", "season_profile", "stream_alerts"]


def tree(df) -> str:
    """Operator tree of the formatted plan, plus each scan's pushed filters and read schema."""
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    head, _, details = text.partition("\n\n\n")
    scans = []
    for block in details.split("\n\n"):
        if block.lstrip().startswith("(") and "Scan parquet" in block.split("\n")[0]:
            loc = re.search(r"Location: .*\[(.*)\]", block)
            pf = re.search(r"PushedFilters: (.*)", block)
            rs = re.search(r"ReadSchema: (.*)", block)
            scans.append(f"{block.split(chr(10))[0].strip()} {loc.group(1).rsplit('/', 1)[-1] if loc else ''}\n"
                         f"    PushedFilters: {pf.group(1) if pf else '-'}\n    ReadSchema: {rs.group(1) if rs else '-'}")
    return head.strip() + "\n\n" + "\n".join(scans)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    out = ["# Physical plans of headline queries",
           "",
           f"Generated by `tools/dump_plans.py` on `{sf}` (local[8], 16 shuffle partitions, AQE on; "
           "plans before AQE re-optimisation). Materialised intermediates (the columns "
           "that tiers are selected on) show up as Parquet scans of the checkpoint folder.",
           ""]
    for name in HEADLINE:
        out += [f"## {name}", "", "```", tree(QUERIES[name](spark, sf)), "```", ""]
    (ROOT / "PLANS.md").write_text("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
