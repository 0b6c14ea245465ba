"""The stored Gold tables in one long form: table, key, measure, and a value or a text.

Comparing a job means comparing every table it writes; the long form makes them one result.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GoldTable:
    """Key columns, and the other columns by what they hold."""

    keys: tuple[str, ...]
    numbers: tuple[str, ...]
    texts: tuple[str, ...] = ()
    times: tuple[str, ...] = ()


DETAILED = {
    "daily_sales": GoldTable(
        ("Year", "Month", "Day"),
        (
            "daily_revenue", "transaction_count", "customer_interactions", "unique_customers",
            "avg_order_value", "max_order_value", "min_order_value",
        ),
    ),
    "country_sales": GoldTable(
        ("Country",),
        (
            "total_revenue", "total_orders", "unique_customers", "avg_order_value",
            "total_quantity_sold", "revenue_per_customer",
        ),
    ),
    "top_products": GoldTable(
        ("StockCode", "Description"),
        (
            "total_revenue", "total_quantity_sold", "total_orders", "unique_customers",
            "avg_unit_price", "revenue_per_order", "revenue_rank", "quantity_rank",
        ),
    ),
    "rfm_table": GoldTable(
        ("CustomerID",),
        ("frequency", "monetary_value", "recency", "recency_score", "frequency_score", "monetary_score"),
        ("customer_segment",),
        ("last_purchase_date",),
    ),
    "cltv_table": GoldTable(
        ("CustomerID",),
        (
            "total_orders", "total_spent", "avg_order_value", "total_transactions",
            "customer_lifespan_days", "purchase_frequency", "predicted_cltv",
        ),
        ("cltv_segment",),
        ("first_purchase", "last_purchase"),
    ),
}

_RFM = ("Recency", "Frequency", "Monetary")
SIMPLE = {
    "simple_daily_sales": GoldTable(("SaleDate",), ("TotalQuantity", "TotalRevenue", "UniqueCustomers", "TotalTransactions")),
    "simple_top_products": GoldTable(("StockCode", "Description"), ("TotalSold", "TotalRevenue", "AvgPrice")),
    "simple_country_sales": GoldTable(("Country",), ("CountryRevenue", "TotalQuantity", "UniqueCustomers", "UniqueProducts")),
    "simple_rfm_table": GoldTable(("CustomerID",), _RFM),
    "simple_cltv_table": GoldTable(("CustomerID",), (*_RFM, "CLTV")),
    "simple_forecast_table": GoldTable(("CustomerID",), (*_RFM, "CLTV", "ExpectedRevenue_12M")),
}


def long_form(df: DataFrame, name: str, table: GoldTable) -> DataFrame:
    """One row per key and column; times are seconds since 1970."""

    def entry(column: str, value=None, text=None):
        value = F.lit(None) if value is None else value
        text = F.lit(None) if text is None else text
        return F.struct(F.lit(column).alias("measure"), value.cast("double").alias("value"), text.cast("string").alias("text"))

    entries = [entry(c, value=F.col(c)) for c in table.numbers]
    entries += [entry(c, text=F.col(c)) for c in table.texts]
    entries += [entry(c, value=F.unix_seconds(F.col(c).cast("timestamp"))) for c in table.times]
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in table.keys])
    rows = df.select(key.alias("key"), F.inline(F.array(*entries)))
    return rows.select(F.lit(name).alias("table"), "key", "measure", "value", "text")


def long_sql(source: str, name: str, table: GoldTable) -> str:
    """The same in SQL over the table or subquery ``source``."""
    key = " || '|' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '?')" for c in table.keys)
    rows = [(c, f"CAST({c} AS DOUBLE)", "CAST(NULL AS VARCHAR)") for c in table.numbers]
    rows += [(c, "CAST(NULL AS DOUBLE)", f"CAST({c} AS VARCHAR)") for c in table.texts]
    rows += [(c, f"CAST(epoch({c}) AS DOUBLE)", "CAST(NULL AS VARCHAR)") for c in table.times]
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", {key} AS key, '{c}' AS measure, {value} AS value, {text} AS text FROM {source}"""
        for c, value, text in rows
    )
