"""Time the headline queries; prints one JSON line.

Every query is built and run from the input tables; nothing is shared between
queries except in the ``stored_*`` group, which reads marts written by ``build_marts``.
"""

from __future__ import annotations

import json
import os
import time

from patronage.queries import QUERIES
from patronage.queries.store import stored_marts
from patronage.session import build_session
from patronage.sources.sample_tables import SampleTables

FROM_RAW = ["order_values", "customer_orders", "customer_reviews", "fact_orders", "fact_order_items", "customer_versions",
            "customer_360", "rfm_features", "clv_features", "pre_cutoff_features", "purchase_intervals", "pareto_curve",
            "order_value_stats", "correlation_pairs", "cleaned_documents", "document_sentiment"]
FROM_MARTS = ["churn_signals", "geo_performance", "clv_bands", "action_queue_overridden", "threshold_sweep", "measures_clv",
              "quality_report", "segment_clusters"]


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                          spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, job) -> None:
        started = time.perf_counter()
        job()
        times[name] = round(time.perf_counter() - started, 3)

    def run(name: str) -> None:
        QUERIES[name].run(spark, path).write.format("noop").mode("overwrite").save()

    timed("warm_up", lambda: run("customer_values"))
    for name in FROM_RAW:
        timed(name, lambda: run(name))
    timed("build_marts", lambda: stored_marts(SampleTables(spark, path)))
    for name in FROM_MARTS:
        timed(name, lambda: run(name))
    times.pop("warm_up")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(path.rstrip("/"))}))


if __name__ == "__main__":
    main()
