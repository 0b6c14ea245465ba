"""Time the headline queries and both end-to-end jobs; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once, after one run of the flagship query that starts the session and
compiles common code.  ``lines_per_second`` is the number of invoice lines over the
seconds of the whole detailed job: CSV export, Bronze, Silver and Gold.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tillwise.plans.catalog import QUERIES
from tillwise.sources.invoice_adapter import read_table

HEADLINE = """
silver_detailed silver_simple retention daily_sales_detailed country_sales_detailed product_ranking
rfm_detailed cltv_detailed daily_sales_simple top_products_20 country_sales_simple rfm_simple
projection_12m null_profile completeness_silver outliers_3sigma forecast_features customer_features
cluster_profile regression_metrics model_health completeness freshness accuracy_drift prediction_volume
pipeline_success pipeline_duration alerts metrics_summary value_histogram top20_customers country_share
csv_ingest stream_windows stream_cleaning job_detailed job_simple
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    seconds("country_sales_detailed")
    chosen = sys.argv[1:] or HEADLINE
    times = {name: seconds(name) for name in chosen}
    result = {
        "metric": "total seconds over headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    if "job_detailed" in times:
        lines = read_table(spark, sf_dir, "lineitem").count()
        result["lines_per_second"] = round(lines / times["job_detailed"])
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
