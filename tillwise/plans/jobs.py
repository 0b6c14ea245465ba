"""Jobs: read tables, chain operators, write tables.

Each returns the observed row counts of what it wrote.  Hand-over between stages is a
written table, so a lost executor repeats tasks of one stage only.
"""

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.operators import bronze, customers, quality, sales, silver
from tillwise.schemas import CORRUPT_COLUMN
from tillwise.sources.tables import BRONZE, GOLD, SILVER, Lakehouse, read_csv

def write_together(lake: Lakehouse, layer: str, tables: Mapping[str, DataFrame], **options) -> dict[str, int]:
    """Write independent tables at the same time; returns their row counts.

    Small tables leave most of a cluster idle when they are written one after another.
    """
    with ThreadPoolExecutor(len(tables)) as pool:
        written = {
            name: pool.submit(lake.write, table, layer, name, **options) for name, table in tables.items()
        }
        return {name: result.result()["rows"] for name, result in written.items()}


LINES = "online_retail"
CLEANED = "online_retail_cleaned"
SIMPLE = "simple"


def run_bronze(
    spark: SparkSession,
    csv_path: str,
    lake: Lakehouse,
    *,
    table: str = LINES,
    mode: str = "overwrite",
    as_of: datetime | str | Column | None = None,
) -> dict:
    """CSV to Bronze in one pass; the null counts are observed during the write."""
    lines = bronze.annotate(read_csv(spark, csv_path), as_of)
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in lines.columns if c != CORRUPT_COLUMN]
    return lake.write(lines, BRONZE, table, mode, metrics=nulls)


def run_silver(
    spark: SparkSession,
    lake: Lakehouse,
    *,
    source: str = LINES,
    table: str = CLEANED,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> dict:
    """Bronze to detailed Silver, with its quality report; by month if so partitioned.

    The empty cells are counted while Silver is written; only the outliers, which need
    the mean first, read it again, one column wide.
    """
    cleaned = silver.silver_detailed(lake.read(spark, BRONZE, source).drop(CORRUPT_COLUMN))
    checked = [c for c in cleaned.columns if c not in quality.MAY_BE_EMPTY]
    written = lake.write(
        cleaned,
        SILVER,
        table,
        mode,
        partition_by=partition_by,
        metrics=[quality.missing_cells(cleaned, checked).alias("null_cells")],
    )
    found = {"total_rows": written["rows"], "null_cells": written["null_cells"]}
    counts = spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in found.items()])
    lake.write(quality.completeness_score(counts, len(checked)), SILVER, f"{table}_completeness")
    lake.write(quality.quantity_outliers(lake.read(spark, SILVER, table)), SILVER, f"{table}_outliers")
    return written


def run_gold(spark: SparkSession, lake: Lakehouse, *, source: str = CLEANED) -> dict:
    """Five Gold tables from two scans of Silver, after one of its product names.

    The invoice rollup feeds the day, country and customer tables; products come from
    the lines, the names tell which products have too many of them for one task.  Rollup, customer base and product totals are written tables, which keeps
    their readers' plans short.
    """
    lines = lake.read(spark, SILVER, source)
    crowded = [row["slot"] for row in sales.crowded_slots(lines).collect()]
    shared = {
        "invoice_rollup": sales.invoice_rollup(lines),
        "product_totals": sales.product_sales(lines, crowded=crowded),
    }
    counts = write_together(lake, GOLD, shared)
    rollup = lake.read(spark, GOLD, "invoice_rollup")
    products = lake.read(spark, GOLD, "product_totals")
    counts |= write_together(
        lake,
        GOLD,
        {
            "customer_base": customers.customer_base(rollup),
            "daily_sales": sales.daily_sales(rollup),
            "country_sales": sales.country_sales(rollup),
            "top_products": sales.rank_products(products),
        },
    )
    base = lake.read(spark, GOLD, "customer_base")
    return counts | write_together(
        lake,
        GOLD,
        {"rfm_table": customers.rfm_detailed(base), "cltv_table": customers.cltv_detailed(base)},
    )


def run_detailed(spark: SparkSession, csv_path: str, lake: Lakehouse) -> dict:
    """CSV to Bronze, Silver and Gold."""
    counts = {"bronze": run_bronze(spark, csv_path, lake)["rows"], "silver": run_silver(spark, lake)["rows"]}
    return counts | run_gold(spark, lake)


def run_simple(spark: SparkSession, csv_path: str, lake: Lakehouse) -> dict:
    """The simple variant end to end: three sales tables and three customer tables.

    Table names carry a prefix, so both variants can live in one lakehouse.  A rollup by day, customer and country
    is summed from the lines once and feeds the day, country and customer tables.
    """
    bronze_table, silver_table = f"{SIMPLE}_{LINES}", f"{SIMPLE}_{CLEANED}"
    raw = read_csv(spark, csv_path).drop(CORRUPT_COLUMN, "source_file")
    counts = {"bronze": lake.write(raw, BRONZE, bronze_table)["rows"]}
    cleaned = silver.silver_simple(lake.read(spark, BRONZE, bronze_table))
    counts["silver"] = lake.write(cleaned, SILVER, silver_table)["rows"]
    lines = lake.read(spark, SILVER, silver_table)

    def name(table: str) -> str:
        return f"{SIMPLE}_{table}"

    shared = {name("rollup"): sales.rollup_simple(lines), name("top_products"): sales.top_products(lines)}
    counts |= write_together(lake, GOLD, shared)
    rollup = lake.read(spark, GOLD, name("rollup"))
    counts |= write_together(
        lake,
        GOLD,
        {
            name("daily_sales"): sales.daily_sales_simple(rollup),
            name("country_sales"): sales.country_sales_simple(lines, rollup),
        },
    )
    tables = {name("rfm_table"): customers.rfm_simple(rollup)}
    counts |= write_together(lake, GOLD, tables, enforce_schema=True)
    cltv = customers.cltv_simple(lake.read(spark, GOLD, name("rfm_table")))
    tables = {name("cltv_table"): cltv, name("forecast_table"): customers.projection(cltv)}
    counts |= write_together(lake, GOLD, tables, enforce_schema=True)
    return counts
