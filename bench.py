"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed to completion with the ``noop`` sink (full plan, no
collect).  ``batch_job`` runs the whole batch job (processed + analytics
zones written to the scratch folder).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "join_tracking_stats", "player_game_workload", "rolling_workload", "workload_tiers",
    "back_to_back_analysis", "btb_by_profile", "travel_correlations", "join_training_schedule",
    "weekly_training", "injury_risk_features", "risk_feature_correlations", "stream_alerts",
    "stream_live_exertion", "stream_alert_sink",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from courtload.plans.batch import run_batch
    from courtload.plans.registry import QUERIES
    from courtload.session import build_session

    spark = build_session(f"local[{cpus}]", app="courtload-bench", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                                 "spark.checkpoint.dir": tempfile.mkdtemp(prefix="courtload-bench-")})
    times: dict[str, float] = {}
    # warm-up (JIT, parquet footers): one pass of the join chain, untimed
    for name in ("player_team_map", "player_game_workload"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    run_batch(spark, sf_dir)
    times["batch_job"] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
