"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the data, BENCH_CPUS (default 8) the cores.
Each query runs once on the smallest data to load classes, then is timed once, its whole
result computed and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from monthmill.catalog.queries import QUERIES
from monthmill.session import build_session

HEADLINE = [
    "loan_silver",
    "financials_silver",
    "attributes_silver",
    "clickstream_silver",
    "label_store",
    "loan_type_flags",
    "pit_join",
    "asof_financials",
    "asof_collapsed",
    "exact_join",
    "feature_store_asof",
    "lineitem_medians",
    "pipeline_labels",
    "null_profile",
    "column_cardinality",
    "numeric_summary",
    "upper_quantiles",
    "histogram_quantity",
    "anomaly_counts",
    "monthly_revenue",
    "country_revenue",
    "orders_by_weekday",
    "customer_summary",
    "pareto_customers",
    "top_products",
    "product_long_tail",
    "basket_summary",
    "rfm_scores",
    "rfm_segments",
    "churn_rate",
    "customer_metadata",
]


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=os.environ.get("BENCH_TMP") or tempfile.mkdtemp(prefix="monthmill-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        if os.path.isdir(warm_dir):
            run(spark, name, warm_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "total wall time of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
