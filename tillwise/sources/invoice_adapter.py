"""Invoice lines from order tables (line items, orders, customers, parts, nations)."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.constants import INVOICE_TIME_FORMAT

# Spellings that the country rules have to clean up.
COUNTRY_SPELLINGS = {0: "EIRE", 1: " European Community", 2: "Unspecified"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _country() -> Column:
    spelled = [
        F.when(F.col("n_nationkey") == key, F.lit(text)) for key, text in COUNTRY_SPELLINGS.items()
    ]
    return F.coalesce(*spelled, F.col("n_name"))


def to_invoice_lines(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame, part: DataFrame
) -> DataFrame:
    """One invoice line per line item; every line is kept.

    The keys decide which lines carry the defects that cleaning has to handle: credit
    notes, test articles, negative quantities, guests and country spellings.
    ``lineitem`` may be a stream.  Line items and orders are both fact tables, so they
    meet in a shuffle join, which AQE splits where an order or customer is hot; without
    the hint a small compressed line item file could be taken for a broadcast side.  The
    dimensions are broadcast only when the planner finds them small.  What an order says is
    worked out once for each order, before its lines meet it.
    """
    headers = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey",
            "o_custkey",
            F.date_format("o_orderdate", INVOICE_TIME_FORMAT).alias("InvoiceDate"),
            _country().alias("Country"),
        )
    )
    lines = lineitem.join(headers.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )
    credit = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    quantity = F.col("l_quantity").cast("int")
    return lines.select(
        F.concat(F.when(credit, F.lit("C")).otherwise(F.lit("")), F.col("l_orderkey").cast("string")).alias(
            "InvoiceNo"
        ),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.when(F.col("l_partkey") % 97 == 0, F.concat(F.lit("test "), "p_name"))
        .otherwise(F.concat(F.lit(" "), "p_name", F.lit(" ")))
        .alias("Description"),
        F.when(F.col("l_orderkey") % 50 == 0, -quantity).otherwise(quantity).alias("Quantity"),
        "InvoiceDate",
        F.col("p_retailprice").alias("UnitPrice"),
        F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey").cast("string")).alias("CustomerID"),
        "Country",
    )


def invoice_lines(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    return to_invoice_lines(
        read_table(spark, sf_dir, "lineitem") if lineitem is None else lineitem,
        *(read_table(spark, sf_dir, name) for name in ("orders", "customer", "nation", "part")),
    )
