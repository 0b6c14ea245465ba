"""Cleaning of invoice lines: the detailed and the simple variant."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.constants import (
    COUNTRY_ALIASES,
    CREDIT_PREFIX,
    GUEST,
    NON_SALE_WORDS,
    REGISTERED,
    REQUIRED_SIMPLE,
)
from tillwise.functions.scoring import first_match
from tillwise.functions.times import parse_invoice_time
from tillwise.operators.quality import percent


def valid_line():
    """Named invoice, positive quantity and price."""
    return (F.col("InvoiceNo") != "") & (F.col("Quantity") > 0) & (F.col("UnitPrice") > 0)


def sale_line():
    """Not a credit note and not a test, sample or adjustment; unknown text does not pass."""
    text = F.col("Description")
    keep = ~F.col("InvoiceNo").startswith(CREDIT_PREFIX)
    for word in NON_SALE_WORDS:
        keep = keep & ~text.contains(word)
    return keep


def clean_lines(lines: DataFrame) -> DataFrame:
    tidy = {name: F.trim(F.upper(name)) for name in ("Description", "Country", "StockCode")}
    stamp = F.col("InvoiceTimestamp")
    return (
        lines.filter(valid_line())
        .withColumns(tidy | {"InvoiceTimestamp": parse_invoice_time(F.col("InvoiceDate"))})
        .withColumns(
            {
                "Year": F.year(stamp),
                "Month": F.month(stamp),
                "Day": F.dayofmonth(stamp),
                "DayOfWeek": F.dayofweek(stamp),
                "TotalAmount": F.col("Quantity") * F.col("UnitPrice"),
            }
        )
    )


def apply_business_rules(lines: DataFrame) -> DataFrame:
    country = F.col("Country")
    aliases = [(country == found, wanted) for found, wanted in COUNTRY_ALIASES.items()]
    return lines.filter(sale_line()).withColumns(
        {
            "Country": F.coalesce(first_match(aliases), country),
            "CustomerType": F.when(F.col("CustomerID").isNull(), GUEST).otherwise(REGISTERED),
        }
    )


def silver_detailed(lines: DataFrame) -> DataFrame:
    return apply_business_rules(clean_lines(lines))


def silver_simple(lines: DataFrame) -> DataFrame:
    """Registered customers only; ``InvoiceDate`` becomes a timestamp."""
    return (
        lines.na.drop(subset=list(REQUIRED_SIMPLE))
        .withColumns(
            {
                "InvoiceDate": parse_invoice_time(F.col("InvoiceDate").cast("string")),
                "Quantity": F.col("Quantity").try_cast("int"),
                "UnitPrice": F.col("UnitPrice").try_cast("double"),
                "CustomerID": F.col("CustomerID").cast("string"),
                "Description": F.trim("Description"),
            }
        )
        .filter((F.col("Quantity") > 0) & (F.col("UnitPrice") > 0))
    )


def retention(lines: DataFrame) -> DataFrame:
    """Rows before cleaning, after cleaning and after the business rules, in one pass."""
    sold = lines.select(
        F.coalesce(valid_line(), F.lit(False)).alias("kept"),
        "InvoiceNo",
        F.upper("Description").alias("Description"),
    ).select("kept", (F.col("kept") & F.coalesce(sale_line(), F.lit(False))).alias("sold"))
    counted = sold.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if("kept").alias("rows_cleaned"),
        F.count_if("sold").alias("rows_sold"),
    )

    return counted.select(
        "rows_in",
        "rows_cleaned",
        (F.col("rows_in") - F.col("rows_cleaned")).alias("rows_removed"),
        percent(F.col("rows_cleaned"), F.col("rows_in")).alias("retention_rate"),
        "rows_sold",
        percent(F.col("rows_sold"), F.col("rows_cleaned")).alias("filtered_percentage"),
    )
