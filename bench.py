"""Headline queries end to end; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_QUERIES
(comma-separated names, default the headline set).
"""

from __future__ import annotations

import json
import os
import time

from drawdown.plans import catalog
from drawdown.session import local_session

HEADLINE = (
    "monthly_consumption",
    "account_metrics",
    "rep_rollup",
    "org_summary",
    "account_detail",
    "renewal_pipeline",
    "in_contract_logs",
    "out_of_contract_usage",
    "overlapping_pairs",
    "rolling_rates",
    "rolling_rates_daily",
    "early_shelfware_streak",
    "dq_report",
    "comp_yearly",
    "scd2_contracts",
    "stream_daily_usage",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = local_session(cpus=cpus, partitions=cpus)
    queries = catalog.queries()
    # Start the engine before the clock does.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall-clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
