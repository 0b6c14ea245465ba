"""Customer tables: RFM scores and segments, lifetime value, 12-month projection."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.constants import DAYS_PER_YEAR, MONTHS_PER_YEAR, QUINTILES
from tillwise.functions import money
from tillwise.functions.distribution import quantiles
from tillwise.functions.scalars import table_wide
from tillwise.functions.scoring import cltv_band, quintile_score, rfm_segment
from tillwise.operators.sales import measures, measures_simple


def customer_base(df: DataFrame) -> DataFrame:
    """One row per registered customer, from silver lines or an invoice rollup.

    The distinct invoice count is shuffled by (customer, invoice) first, so one very
    busy customer does not land in one task.  RFM and lifetime value read their input
    more than once (cut points, then scores), so store this table and pass it to them.
    """
    return (
        measures(df)
        .filter(F.col("CustomerID").isNotNull())
        .groupBy("CustomerID")
        .agg(
            F.min("first_stamp").alias("first_purchase"),
            F.max("last_stamp").alias("last_purchase"),
            F.count_distinct(F.col("InvoiceNo")).alias("orders"),
            F.sum("amount_sum").alias("amount"),
            F.sum("amount_count").alias("amounts"),
            F.sum("stamp_count").alias("transactions"),
            F.sum("line_count").alias("lines"),
        )
    )


def as_customer_base(df: DataFrame) -> DataFrame:
    return df if "orders" in df.columns else customer_base(df)


def analysis_date(lines: DataFrame, column: str = "InvoiceTimestamp") -> DataFrame:
    """One row: the latest invoice time."""
    return lines.agg(F.max(column).alias("analysis_date"))


def _rfm_inputs(df: DataFrame) -> DataFrame:
    """Days before today order customers as negated day numbers do, so the recency cut
    points need no latest date and come with the other two."""
    return as_customer_base(df).select(
        "CustomerID",
        F.col("orders").alias("frequency"),
        money.as_double(F.col("amount")).alias("spend"),
        money.as_double(money.to_cents(F.col("amount"))).alias("monetary_value"),
        (-F.unix_date(F.to_date("last_purchase"))).alias("age"),
        F.col("last_purchase").alias("last_purchase_date"),
    )


RFM_METRICS = ("age", "frequency", "spend")
# The smallest age is the latest purchase; it comes with the cut points.
LEAST_AND_QUINTILES = (0.0, *QUINTILES)


def rfm_thresholds(df: DataFrame, *, sketch: bool = False) -> DataFrame:
    """One row: quintile cut points of recency, frequency and spend."""
    customers = _rfm_inputs(df)
    cuts = F.col("cuts")
    newest = cuts["age"][0]
    shifts = {"recency": ("age", newest), "frequency": ("frequency", F.lit(0)), "monetary": ("spend", F.lit(0))}
    points = [
        (cuts[source][i] - shift).cast("double").alias(f"{name}_{round(p * 100)}")
        for name, (source, shift) in shifts.items()
        for i, p in enumerate(QUINTILES, start=1)
    ]
    found = quantiles(customers, RFM_METRICS, LEAST_AND_QUINTILES, sketch=sketch)
    return customers.sparkSession.range(1).select(found.alias("cuts")).select(*points)


def rfm_detailed(df: DataFrame, *, sketch: bool = False) -> DataFrame:
    """RFM scores and segments from silver lines, an invoice rollup or a customer base.

    ``sketch`` finds the cut points with quantile sketches and the rows near them instead of all positions.
    """
    customers = _rfm_inputs(df)
    cuts = F.col("_cuts")

    def score(metric: str, *, low_is_good: bool = False):
        return quintile_score(F.col(metric), F.slice(cuts[metric], 2, 4), low_is_good=low_is_good)

    scores = {
        "recency_score": score("age", low_is_good=True),
        "frequency_score": score("frequency"),
        "monetary_score": score("spend"),
    }
    found = quantiles(customers, RFM_METRICS, LEAST_AND_QUINTILES, sketch=sketch)
    return (
        customers.withColumn("_cuts", found)
        .withColumns(scores)
        .select(
            "CustomerID",
            "last_purchase_date",
            "frequency",
            "monetary_value",
            (F.col("age") - cuts["age"][0]).cast("int").alias("recency"),
            *scores,
            rfm_segment(*map(F.col, scores)).alias("customer_segment"),
        )
    )


def _cltv_inputs(df: DataFrame) -> DataFrame:
    lifespan = F.datediff("last_purchase", "first_purchase") + 1
    mean_line = F.try_divide(money.as_double(F.col("amount")), F.col("amounts"))
    return (
        as_customer_base(df)
        .withColumns(
            {
                "customer_lifespan_days": lifespan,
                "purchase_frequency": F.try_divide(F.col("orders").cast("double"), lifespan),
            }
        )
        .select(
            "CustomerID",
            "first_purchase",
            "last_purchase",
            F.col("orders").alias("total_orders"),
            money.as_double(money.to_cents(F.col("amount"))).alias("total_spent"),
            money.as_double(money.to_cents(money.mean(F.col("amount"), F.col("amounts")))).alias(
                "avg_order_value"
            ),
            F.col("transactions").alias("total_transactions"),
            "customer_lifespan_days",
            "purchase_frequency",
            F.round(mean_line * F.col("purchase_frequency") * F.lit(DAYS_PER_YEAR), 2).alias(
                "predicted_cltv"
            ),
        )
    )


def cltv_detailed(df: DataFrame, *, sketch: bool = False) -> DataFrame:
    """Lifetime value and value band, best first; cut points as in ``rfm_detailed``."""
    customers = _cltv_inputs(df)
    cuts = quantiles(customers, ["predicted_cltv"], sketch=sketch)["predicted_cltv"]
    return (
        customers.withColumn("_cuts", cuts)
        .withColumn("cltv_segment", cltv_band(F.col("predicted_cltv"), F.col("_cuts")))
        .drop("_cuts")
        .orderBy(F.desc("predicted_cltv"), "CustomerID")
    )


def rfm_simple(df: DataFrame) -> DataFrame:
    """Line-count RFM from simple silver lines or a simple rollup; no scores, no rounding.

    Guests count towards the latest date only, so they are one more group that is left
    out at the end; customer table and latest date come from one scan.
    """
    people = measures_simple(df).groupBy("CustomerID").agg(
        F.max("last_stamp").alias("last"),
        F.sum("invoice_count").alias("Frequency"),
        F.sum("amount_sum").alias("amount"),
        F.count("CustomerID").alias("registered"),
    )
    latest = table_wide(people, latest=F.max("last"))["latest"]
    return people.filter(F.col("registered") > 0).select(
        "CustomerID",
        F.datediff(latest, "last").alias("Recency"),
        "Frequency",
        money.as_double(F.col("amount")).alias("Monetary"),
    )


def cltv_simple(rfm: DataFrame) -> DataFrame:
    return rfm.withColumn(
        "CLTV", F.col("Frequency") * F.col("Monetary") / (F.col("Recency") + 1)
    )


def projection(cltv: DataFrame, months: int = MONTHS_PER_YEAR) -> DataFrame:
    return cltv.withColumn(f"ExpectedRevenue_{months}M", F.col("CLTV") * F.lit(months))


def projection_total(projected: DataFrame, column: str = "ExpectedRevenue_12M") -> DataFrame:
    return projected.agg(money.as_double(money.to_cents(money.total(F.col(column)))).alias("total_projection"))


def segment_counts(rfm: DataFrame, column: str = "customer_segment") -> DataFrame:
    return rfm.groupBy(column).agg(F.count(F.lit(1)).alias("customers"))


def distinct_segments(segments: DataFrame, column: str) -> DataFrame:
    return segments.select(column).distinct().agg(F.count(F.lit(1)).alias("segments"))


def top_customers(customers: DataFrame, measure: str, n: int) -> DataFrame:
    return customers.orderBy(F.desc(measure), "CustomerID").limit(n)
