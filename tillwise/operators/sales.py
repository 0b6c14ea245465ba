"""Sales tables: by day, country and product; detailed and simple variants."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.constants import TOP_PRODUCTS, TOP_PRODUCTS_SHORT
from tillwise.functions import money
from tillwise.functions.distribution import with_ranks

PRODUCT_KEYS = ("StockCode", "Description")
PRODUCT_SLOTS = 65_536
#: A product with more lines is spread over many tasks; sets of fewer fit in one.
CROWDED_LINES = 200_000
INVOICE_KEYS = ("Year", "Month", "Day", "Country", "InvoiceNo", "CustomerID")


def _amount():
    return F.col("Quantity") * F.col("UnitPrice")


def measures(df: DataFrame) -> DataFrame:
    """Additive measures of silver lines; an invoice rollup passes through unchanged."""
    if "amount_sum" in df.columns:
        return df
    amount = F.col("TotalAmount")
    return df.select(
        *INVOICE_KEYS,
        money.exact(amount).alias("amount_sum"),
        amount.isNotNull().cast("bigint").alias("amount_count"),
        amount.alias("amount_max"),
        amount.alias("amount_min"),
        F.col("Quantity").cast("bigint").alias("quantity_sum"),
        F.lit(1).cast("bigint").alias("line_count"),
        F.col("InvoiceTimestamp").isNotNull().cast("bigint").alias("stamp_count"),
        F.col("InvoiceTimestamp").alias("first_stamp"),
        F.col("InvoiceTimestamp").alias("last_stamp"),
    )


def invoice_rollup(lines: DataFrame) -> DataFrame:
    """One row per invoice, customer, country and day.

    Day, country and customer tables all derive from it, so a job that builds several
    of them scans and shuffles the lines once.
    """
    return (
        measures(lines)
        .groupBy(*INVOICE_KEYS)
        .agg(
            *[
                F.sum(name).alias(name)
                for name in ("amount_sum", "amount_count", "quantity_sum", "line_count", "stamp_count")
            ],
            F.max("amount_max").alias("amount_max"),
            F.min("amount_min").alias("amount_min"),
            F.min("first_stamp").alias("first_stamp"),
            F.max("last_stamp").alias("last_stamp"),
        )
    )


def _distinct(column: str, approx: bool):
    return F.approx_count_distinct(column) if approx else F.count_distinct(F.col(column))


def _mean_amount():
    return money.as_double(money.to_cents(money.mean(F.col("_amount"), F.col("_lines"))))


def daily_sales(df: DataFrame, *, approx: bool = False) -> DataFrame:
    """Detailed daily table from silver lines or an invoice rollup.

    Distinct counts expand to (day, value) pairs that are shuffled by both, so a busy
    day is spread over many tasks.
    """
    registered = F.when(F.col("CustomerID").isNotNull(), F.col("line_count"))
    return (
        measures(df)
        .groupBy("Year", "Month", "Day")
        .agg(
            F.sum("amount_sum").alias("_amount"),
            F.sum("amount_count").alias("_lines"),
            _distinct("InvoiceNo", approx).alias("transaction_count"),
            F.coalesce(F.sum(registered), F.lit(0)).alias("customer_interactions"),
            _distinct("CustomerID", approx).alias("unique_customers"),
            F.max("amount_max").alias("max_order_value"),
            F.min("amount_min").alias("min_order_value"),
        )
        .select(
            "Year",
            "Month",
            "Day",
            money.as_double(money.to_cents(F.col("_amount"))).alias("daily_revenue"),
            "transaction_count",
            "customer_interactions",
            "unique_customers",
            _mean_amount().alias("avg_order_value"),
            "max_order_value",
            "min_order_value",
        )
        .orderBy("Year", "Month", "Day")
    )


def country_sales(df: DataFrame, *, approx: bool = False) -> DataFrame:
    """Detailed country table; revenue per customer is null where all are guests."""
    revenue = money.to_cents(F.col("_amount"))
    return (
        measures(df)
        .groupBy("Country")
        .agg(
            F.sum("amount_sum").alias("_amount"),
            F.sum("amount_count").alias("_lines"),
            _distinct("InvoiceNo", approx).alias("total_orders"),
            _distinct("CustomerID", approx).alias("unique_customers"),
            F.sum("quantity_sum").alias("total_quantity_sold"),
        )
        .select(
            "Country",
            money.as_double(revenue).alias("total_revenue"),
            "total_orders",
            "unique_customers",
            _mean_amount().alias("avg_order_value"),
            "total_quantity_sold",
            money.as_double(money.to_cents(money.mean(revenue, F.col("unique_customers")))).alias(
                "revenue_per_customer"
            ),
        )
        .orderBy(F.desc("total_revenue"), "Country")
    )


def _product_slot():
    return F.pmod(F.xxhash64(*PRODUCT_KEYS), F.lit(PRODUCT_SLOTS)).cast("int")


def crowded_slots(lines: DataFrame, limit: int = CROWDED_LINES) -> DataFrame:
    """Hash slots of products with more than ``limit`` lines: at most one for each ``limit`` lines of the table."""
    return lines.groupBy(_product_slot().alias("slot")).count().filter(F.col("count") > limit).select("slot")


def _product_measures(lines: DataFrame, distinct: Callable[[str], Column]) -> DataFrame:
    return lines.groupBy(*PRODUCT_KEYS).agg(
        money.total(F.col("TotalAmount")).alias("_amount"),
        F.sum(F.col("Quantity").cast("bigint")).alias("total_quantity_sold"),
        distinct("InvoiceNo").alias("total_orders"),
        distinct("CustomerID").alias("unique_customers"),
        money.total(F.col("UnitPrice")).alias("_price"),
        F.count("UnitPrice").alias("_prices"),
    )


def product_sales(lines: DataFrame, *, approx: bool = False, crowded: Sequence[int] | None = None) -> DataFrame:
    """Product totals.  Distinct counts expand every line to three, shuffled by product and value.

    With ``crowded`` (``crowded_slots``, collected) only the products of these slots do so.  The lines of all others
    are shuffled once, by product, and counted as sets of one product, which hold few lines.
    """
    revenue = money.to_cents(F.col("_amount"))
    if crowded is None:
        measured = _product_measures(lines, lambda c: _distinct(c, approx))
    else:
        known = lines.select(*PRODUCT_KEYS, "InvoiceNo", "CustomerID", "Quantity", "UnitPrice", "TotalAmount")
        inside = _product_slot().isin(list(crowded))
        few = known.filter(~inside) if crowded else known
        measured = _product_measures(few.repartition(*PRODUCT_KEYS), lambda c: F.size(F.collect_set(c)).cast("bigint"))
        if crowded:
            measured = measured.unionByName(_product_measures(known.filter(inside), lambda c: _distinct(c, approx)))
    return (
        measured
        .select(
            "StockCode",
            "Description",
            money.as_double(revenue).alias("total_revenue"),
            "total_quantity_sold",
            "total_orders",
            "unique_customers",
            money.as_double(money.to_cents(money.mean(F.col("_price"), F.col("_prices")))).alias(
                "avg_unit_price"
            ),
            money.as_double(money.to_cents(money.mean(revenue, F.col("total_orders")))).alias(
                "revenue_per_order"
            ),
        )
    )


def rank_products(products: DataFrame) -> DataFrame:
    """Revenue and quantity ranks over the whole product table, best revenue first."""
    return with_ranks(
        products, {"revenue_rank": "total_revenue", "quantity_rank": "total_quantity_sold"}
    ).orderBy("revenue_rank", "StockCode", "Description")


def product_ranking(lines: DataFrame, *, approx: bool = False) -> DataFrame:
    return rank_products(product_sales(lines, approx=approx))


def measures_simple(df: DataFrame) -> DataFrame:
    """Additive measures of simple silver lines; a simple rollup passes through unchanged."""
    if "amount_sum" in df.columns:
        return df
    return df.select(
        F.to_date("InvoiceDate").alias("SaleDate"),
        "CustomerID",
        "Country",
        F.col("Quantity").cast("bigint").alias("quantity_sum"),
        money.exact(_amount()).alias("amount_sum"),
        F.col("InvoiceNo").isNotNull().cast("bigint").alias("invoice_count"),
        F.col("InvoiceDate").alias("last_stamp"),
    )


def rollup_simple(lines: DataFrame) -> DataFrame:
    """One row per day, customer and country: what the simple day and customer tables and most of the country table need."""
    return (
        measures_simple(lines)
        .groupBy("SaleDate", "CustomerID", "Country")
        .agg(
            *[F.sum(name).alias(name) for name in ("quantity_sum", "amount_sum", "invoice_count")],
            F.max("last_stamp").alias("last_stamp"),
        )
    )


def daily_sales_simple(df: DataFrame) -> DataFrame:
    """Simple daily table from silver lines or a simple rollup."""
    return (
        measures_simple(df)
        .groupBy("SaleDate")
        .agg(
            F.sum("quantity_sum").alias("TotalQuantity"),
            money.as_double(F.sum("amount_sum")).alias("TotalRevenue"),
            F.count_distinct(F.col("CustomerID")).alias("UniqueCustomers"),
            F.sum("invoice_count").alias("TotalTransactions"),
        )
        .orderBy("SaleDate")
    )


def top_products(lines: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """Best sellers by units; ties are settled by stock code and description."""
    return (
        lines.groupBy("StockCode", "Description")
        .agg(
            F.sum(F.col("Quantity").cast("bigint")).alias("TotalSold"),
            money.total(_amount()).alias("_revenue"),
            money.total(F.col("UnitPrice")).alias("_price"),
            F.count("UnitPrice").alias("_prices"),
        )
        .select(
            "StockCode",
            "Description",
            "TotalSold",
            money.as_double(F.col("_revenue")).alias("TotalRevenue"),
            F.try_divide(money.as_double(F.col("_price")), F.col("_prices")).alias("AvgPrice"),
        )
        .orderBy(F.desc("TotalSold"), "StockCode", "Description")
        .limit(n)
    )


def top_descriptions(lines: DataFrame, n: int = TOP_PRODUCTS_SHORT) -> DataFrame:
    return (
        lines.groupBy("Description")
        .agg(F.sum(F.col("Quantity").cast("bigint")).alias("TotalSold"))
        .orderBy(F.desc("TotalSold"), "Description")
        .limit(n)
    )


def country_sales_simple(lines: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    """Simple country table; with ``rollup`` (``rollup_simple``) the lines only tell which products a country bought.

    Otherwise two distinct counts expand every line to three.
    """
    people = F.count_distinct(F.col("CustomerID")).alias("UniqueCustomers")
    products = F.count_distinct(F.col("StockCode")).alias("UniqueProducts")
    if rollup is None:
        countries = lines.groupBy("Country").agg(
            money.as_double(money.total(_amount())).alias("CountryRevenue"),
            F.sum(F.col("Quantity").cast("bigint")).alias("TotalQuantity"),
            people,
            products,
        )
    else:
        bought = lines.groupBy(F.col("Country").alias("_country")).agg(products)
        measured = rollup.groupBy("Country").agg(
            money.as_double(F.sum("amount_sum")).alias("CountryRevenue"),
            F.sum("quantity_sum").alias("TotalQuantity"),
            people,
        )
        countries = measured.join(bought, F.col("Country").eqNullSafe(F.col("_country"))).drop("_country")
    return countries.orderBy(F.desc("CountryRevenue"), "Country")
