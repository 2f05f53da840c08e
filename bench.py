"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores. Each query
runs once untimed, which also writes the raw deliveries that some queries read, then its best of BENCH_RUNS (default 1) runs counts.
"""

from __future__ import annotations

import json
import os
import time

from flowtally.checks import all_checks
from flowtally.session import local_session

HEADLINE = [
    "route_matrix",
    "top_routes",
    "yearly_returns",
    "yearly_types",
    "yearly_contributions",
    "operation_costs",
    "operation_costs_by_record",
    "cost_per_person",
    "average_by_year",
    "average_by_year_and_destination",
    "share_left_out",
    "cube_slice",
    "flow_offsets",
    "tidy_returns",
    "staff_and_costs",
    "representatives",
    "sheet_operations",
    "sheet_destinations",
    "whole_ledger",
    "newer_route_matrix",
    "newer_yearly_types",
    "combined_yearly_returns",
    "fill_down_by_key",
    "fill_down_whole_table",
    "row_keys",
    "title_case_texts",
    "pattern_removal",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cpus, "bench")
    checks = all_checks()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            checks[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:]), 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline queries, total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
