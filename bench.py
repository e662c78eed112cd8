"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query runs once to warm up and then three times; its time is the median.
Queries are materialised in full to Spark's no-op sink.  ``full_run`` is the whole
job over raw files written beforehand: bronze, silver, gold and the report.
"""

import json
import os
import statistics
import tempfile
import time
from functools import partial

from pyspark.sql import SparkSession

from retail_strata.plans.full import run_all
from retail_strata.plans.raw_views import write_raw_files
from retail_strata.plans.tables import Layers
from retail_strata.queries import QUERIES

HEADLINE = (
    "silver_customers", "silver_products", "silver_sales", "silver_payments",
    "gold_sales_summary", "gold_customer_metrics", "gold_product_performance",
    "gold_payment_analysis", "dedup_latest", "feed_sales",
)
REPEATS = 3


def run_query(spark: SparkSession, folder: str, name: str) -> None:
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()


def run_job(spark: SparkSession, raw: Layers) -> None:
    """Into fresh layers, so that every repeat does the same work."""
    fresh = Layers.under(tempfile.mkdtemp(prefix="bench-"))
    run_all(spark, Layers(raw.raw, fresh.bronze, fresh.silver, fresh.gold)).report.collect()


def median_seconds(work) -> float:
    work()
    times = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("retail_strata bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: median_seconds(partial(run_query, spark, folder, name)) for name in HEADLINE}
    raw = Layers.under(tempfile.mkdtemp(prefix="bench-raw-"))
    write_raw_files(spark, folder, raw)
    seconds["full_run"] = median_seconds(partial(run_job, spark, raw))
    spark.stop()
    print(json.dumps({
        "metric": "total_median_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
