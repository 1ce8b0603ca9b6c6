"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose tables and cores. Every row of every result is computed
and discarded. The first run of a query warms the JVM and is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time


def main() -> None:
    from ledgerloom.catalog import QUERIES
    from ledgerloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    names = [
        "core_transactions", "fact_mart", "balance_mart", "fact_mart_masked",
        "balance_mart_masked", "volume_monitoring", "spend_by_period", "check_suite",
        "asof_rate_join_interval", "asof_rate_join_dense", "asof_rate_join_union",
        "stream_ingest",
    ]
    times = {}
    for name in names:
        for _ in range(2):
            start = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - start, 3)
        print(f"{name}: {times[name]} s", file=sys.stderr)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
