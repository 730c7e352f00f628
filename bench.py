"""Times headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores.
Each query is written to the no-op sink, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import time

HEADLINE = [
    "did_events",
    "capacity_timeline",
    "regional_correlations",
    "kpi_summary",
    "monthly_energy",
    "weather_join",
    "weather_residual",
    "normalize_readings",
    "ingest_demand",
    "ingest_retail",
    "dedup_latest",
    "demand_timeseries",
    "demand_change",
    "spearman",
    "control_region",
    "nearest_station",
    "point_in_region",
    "scan_demand",
    "page_completeness",
    "demand_anomalies",
    "live_pricing",
    "alert_cooldown_batch",
    "forecast_predict",
    "batch_kpi",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    from gridtide.plans.catalog import QUERIES
    from gridtide.session import build_session

    spark = build_session(
        "gridtide-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # one unmeasured run starts the executor threads and compiles the JVM's hot paths
    QUERIES[HEADLINE[0]](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
