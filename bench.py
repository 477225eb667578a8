"""Wall time of headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local threads. Each query runs
once to warm the JVM and once for the record, its result sent to a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from clearledger.workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "customer_transactions_summary",
    "transactions_in_eur",
    "int_transactions",
    "int_loans",
    "clean_dates_sql",
    "clean_numbers_sql",
    "check_relationships",
    "check_unique",
    "fk_report",
    "currency_coverage",
    "profile_counts",
    "profile_numeric",
    "profile_categorical",
    "date_distribution",
    "outliers_iqr",
    "outliers_mad_dates",
    "duplicate_records",
    "composite_key_duplicates",
    "dedupe_keep_last",
    "date_format_report",
    "whitespace_report",
    "email_report",
    "correlation_matrix",
    "boxplot_stats",
    "kde_by_category",
    "check_suite_summary",
)


def run(spark: SparkSession, name: str, folder: str) -> float:
    """Seconds from asking for a query until its last row is out."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("clearledger-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        run(spark, name, folder)
        times[name] = round(run(spark, name, folder), 3)
    spark.stop()
    result = {
        "metric": "total wall time of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
