"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads, ``BENCH_RUNS`` the timed runs
after one warm-up (the median counts). Results are computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.catalogue import QUERIES  # noqa: E402
from slatecraft.session import build_session  # noqa: E402

HEADLINE = (
    "mrt5_top_users",
    "mrt1_top_lineups",
    "mrt1_captain",
    "mrt3_complete",
    "mrt6_pair_corr",
    "mrt7_pair_corr_lines",
    "mrt8_team_counts",
    "mrt9_stack_sizes",
    "mrt10_team_details",
    "mrt11_anchor_patterns",
    "mrt12_anchor_in_stack",
    "mrt13_min_points",
    "mrt15_exposure",
    "mrt16_size_quintiles",
    "dds1_contests",
    "dds2_players",
    "dds4_users",
    "dds6_lineups",
    "dds7_lines",
    "doc13_results_with_totals",
    "doc14_player_results",
    "doc15_ranked_users",
)


def seconds(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": "20g",
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        seconds(spark, sf_dir, name)
        times[name] = round(statistics.median(seconds(spark, sf_dir, name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
