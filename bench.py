"""Time the headline queries; prints one JSON line.

Every query runs to a no-op sink, so all of its rows are computed and none
is collected. The value is the sum of the best of two runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyloom import workloads  # noqa: E402
from tallyloom.session import local_session  # noqa: E402

HEADLINE = [
    "q_load_orders",
    "q_upsert_scoped",
    "q_upfront_offprice",
    "q_offprice_by_season",
    "q_impute_ship_date",
    "q_inventory",
    "q_load_containers",
    "q_reconcile_invoices",
    "q_align_curve",
    "q_parse_scale",
    "q_form_to_po",
    "q_ffill",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cores)
    spark.sparkContext.setLogLevel("ERROR")
    workloads.load_all()
    names = list(workloads.QUERIES) if names == ["all"] else names
    spark.read.parquet(f"{folder}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            workloads.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
