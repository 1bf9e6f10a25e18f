"""Time the headline queries: ``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores.

Prints one JSON line. Every query is planned and run in full into a no-op sink, so that no rows
travel to the driver: best of ``BENCH_RUNS`` (default 1) after two queries that warm the JVM up.
"""

from __future__ import annotations

import json
import os
import time

from pricelake.queries import run
from pricelake.session import build_session

HEADLINE = (
    "clean_full", "stg_view", "mart_monthly", "mart_monthly_by_category", "mart_trend", "mart_trend_by_series",
    "q2_commodity_stats", "q3_wide_commodities", "q6_yoy", "q7_volatility", "q8_profile", "sf_mom",
    "quality_report", "dim_market", "load_fact", "staging_incremental",
)


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    run(name, spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session("bench", cores, int(cores), **{"spark.driver.memory": "16g"})
    for name in ("clean_full", "mart_trend"):
        seconds(spark, name, folder)
    times = {}
    for name in HEADLINE:
        times[name] = round(min(seconds(spark, name, folder) for _ in range(runs)), 3)
    result = {
        "metric": "headline queries, total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cores": int(cores),
        "spark": spark.version,
        "shuffle_partitions": int(cores),
    }
    spark.stop()
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
