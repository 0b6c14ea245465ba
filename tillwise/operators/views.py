"""Queries behind the dashboard: series, top lists, key figures, histograms, shares."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.constants import HISTOGRAM_BINS
from tillwise.functions import money


def revenue_series(daily: DataFrame) -> DataFrame:
    return daily.select("SaleDate", "TotalRevenue").orderBy("SaleDate")


def revenue_totals(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.count(F.lit(1)).alias("days"),
        money.as_double(money.to_cents(money.total(F.col("TotalRevenue")))).alias("total_revenue"),
    )


def customer_kpis(rfm: DataFrame) -> DataFrame:
    def mean(column: str):
        return money.as_double(
            F.round(money.mean(money.total(F.col(column)), F.count(column)), 2)
        ).alias(f"mean_{column.lower()}")

    return rfm.agg(
        F.count(F.lit(1)).alias("customers"), mean("Monetary"), mean("Frequency"), mean("Recency")
    )


def histograms(df: DataFrame, measures: Sequence[str], bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins from smallest to largest value, the last one closed; empty bins stay.

    A measure with a single value is spread half a unit to both sides.  Only one row per
    measure and bin leaves the scan.
    """
    extremes = df.agg(
        F.struct(
            *[
                F.struct(
                    F.min(F.col(m).cast("double")).alias("low"), F.max(F.col(m).cast("double")).alias("high")
                ).alias(m)
                for m in measures
            ]
        )
    ).scalar()

    def edges(measure: str):
        low, high = F.col("_seen")[measure]["low"], F.col("_seen")[measure]["high"]
        flat = low == high
        return F.when(flat, low - 0.5).otherwise(low), F.when(flat, high + 0.5).otherwise(high)

    def placed(measure: str):
        low, high = edges(measure)
        position = F.floor((F.col(measure).cast("double") - low) / (high - low) * bins).cast("int")
        inside = F.when(position.isNotNull(), F.least(position, F.lit(bins - 1)))
        return F.struct(F.lit(measure).alias("measure"), inside.alias("bin"))

    counted = (
        df.select(*measures)
        .withColumn("_seen", extremes)
        .select(F.explode(F.array(*[placed(m) for m in measures])).alias("p"))
        .groupBy("p.measure", "p.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )

    def frame(measure: str):
        low, high = edges(measure)
        return F.struct(F.lit(measure).alias("measure"), low.alias("low"), high.alias("high"))

    width = (F.col("f.high") - F.col("f.low")) / bins
    grid = (
        df.sparkSession.range(bins)
        .select(F.col("id").cast("int").alias("bin"), extremes.alias("_seen"))
        .select("bin", F.explode(F.array(*[frame(m) for m in measures])).alias("f"))
        .select(
            F.col("f.measure").alias("measure"),
            "bin",
            (F.col("f.low") + F.col("bin") * width).alias("bin_start"),
            (F.col("f.low") + (F.col("bin") + 1) * width).alias("bin_end"),
        )
    )
    return grid.join(counted, ["measure", "bin"], "left").na.fill(0, ["n"])


def country_share(countries: DataFrame, n: int = 5) -> DataFrame:
    """The first countries by revenue and their share among each other in percent."""
    revenue = F.col("CountryRevenue")
    return (
        countries.select("Country", "CountryRevenue")
        .orderBy(F.desc("CountryRevenue"), "Country")
        .limit(n)
        .withColumn("share_pct", F.round(revenue / F.sum(revenue).over(Window.partitionBy()) * 100, 2))
    )
