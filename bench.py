"""Time the headline queries on local cores and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from stockyard.plans import catalog
from stockyard.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = [
    "mart_order_sla", "mart_inventory_health", "mart_stockout_risk", "mart_operator_productivity",
    "mart_picking_performance", "mart_geo_performance", "mart_geo_inventory", "mart_weather_impact",
    "asof_proxy", "asof_proxy_heavy_key", "dedup_latest", "dim_products", "orphan_by_month", "sla_distribution",
    "lost_clients", "churn_summary", "ingestion_gaps", "layer_summary", "test_results", "sla_by_place",
    "top_operators", "revenue_by_day", "estimated_by_product", "merge_incremental", "weather_explode", "geo_enrich",
    "chunk_documents", "cosine_topk",
]


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]", "stockyard-bench", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__sql__ui__retainedExecutions="10",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    names = sys.argv[1:] or HEADLINE
    best: dict[str, float] = {}
    for _ in range(RUNS):
        for name in names:
            began = time.perf_counter()
            queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - began
            best[name] = min(took, best.get(name, took))
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries, best of runs", "value": round(sum(best.values()), 3),
        "unit": "sec", "queries": {name: round(sec, 3) for name, sec in best.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
