"""Model features: daily series for the forecast, customers for the clusters."""

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.constants import FORECAST_FEATURES
from tillwise.functions import money
from tillwise.functions.scalars import table_wide
from tillwise.functions.times import moment
from tillwise.operators.customers import as_customer_base

SHORT_LAG, LONG_LAG = 7, 30


def _mean_of_previous(rows: int, keys: Sequence[str]) -> Column:
    frame = Window.partitionBy(*keys).orderBy("sale_date").rowsBetween(-rows, -1)
    revenue = F.col("daily_revenue").cast("decimal(30,2)")
    return F.try_divide(money.as_double(F.sum(revenue).over(frame)), F.count(revenue).over(frame))


def forecast_features(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Calendar features and means of the previous 7 and 30 days with sales.

    Without ``keys`` the series is ordered in one task.  It has one row per calendar day
    (a century is 36,525 rows), so that stays small at any number of lines; series per
    country or store pass their columns as ``keys``.
    """
    day = F.col("sale_date")
    return (
        daily.withColumn("sale_date", F.make_date("Year", "Month", "Day"))
        .select(
            *keys,
            "sale_date",
            "daily_revenue",
            F.dayofyear(day).alias("day_of_year"),
            F.month(day).alias("month"),
            F.dayofweek(day).alias("day_of_week"),
            _mean_of_previous(SHORT_LAG, keys).alias("lag_7"),
            _mean_of_previous(LONG_LAG, keys).alias("lag_30"),
            _mean_of_previous(SHORT_LAG, keys).alias("rolling_mean_7"),
        )
        .na.fill(0, list(FORECAST_FEATURES))
    )


def customer_features(df: DataFrame, as_of: datetime | date | str | Column | None = None) -> DataFrame:
    """Recency, line count, spend and mean line value per registered customer.

    ``as_of`` defaults to the latest purchase in the table.
    """
    customers = as_customer_base(df).select("CustomerID", "last_purchase", "lines", "amount", "amounts")
    today = (
        table_wide(customers, latest=F.max("last_purchase"))["latest"] if as_of is None else moment(as_of)
    )
    monetary = money.as_double(F.col("amount"))
    return customers.select(
        "CustomerID",
        F.datediff(today, "last_purchase").alias("recency"),
        F.col("lines").alias("frequency"),
        monetary.alias("monetary"),
        F.try_divide(monetary, F.col("amounts")).alias("avg_order_value"),
    )


def rolling_folds(series: DataFrame, folds: int, days: int, day: str = "sale_date") -> DataFrame:
    """Each row once for every fold that it takes part in: ``fold`` (1 is the latest) and ``part``, train or test.

    Fold f ends ``(f - 1) * days`` days before the last day: its last ``days`` days are for testing and all days before
    for training, so no model sees the future of what it is tested on.  One dataset for all folds: errors of
    all of them are one aggregation.  The last day is a scalar subquery; rows without a day are in no fold.
    """
    last = table_wide(series, last=F.max(day))["last"]
    age = F.datediff(last, F.col(day))
    rows = series.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds)))).withColumn("_age", age)
    oldest = F.col("fold") * days
    dealt = rows.filter(F.col("_age") >= (F.col("fold") - 1) * days)
    return dealt.withColumn("part", F.when(F.col("_age") < oldest, "test").otherwise("train")).drop("_age")


def horizon_features(daily: DataFrame, horizons: int, keys: Sequence[str] = ()) -> DataFrame:
    """Rows (origin day, horizon) for direct forecasts: what is known on the origin day and the calendar of the target day.

    ``daily_revenue`` is that of the target day, null where it has no sales or lies ahead.  Means are those of
    the last 7 and 30 days with sales up to the origin, so no row knows anything later, whatever its horizon.  One model
    fits all horizons and one transform forecasts them, without a loop.  There are ``horizons`` rows for each calendar
    day and key.
    """

    def recent(rows: int) -> Column:
        frame = Window.partitionBy(*keys).orderBy("origin").rowsBetween(1 - rows, 0)
        revenue = F.col("daily_revenue").cast("decimal(30,2)")
        return F.try_divide(money.as_double(F.sum(revenue).over(frame)), F.count(revenue).over(frame))

    days = daily.filter(F.col("Year").isNotNull()).select(*keys, F.make_date("Year", "Month", "Day").alias("origin"), "daily_revenue")
    known = days.select(*keys, "origin", recent(SHORT_LAG).alias("lag_7"), recent(LONG_LAG).alias("lag_30"))
    rows = known.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizons))))
    rows = rows.withColumn("target", F.date_add("origin", F.col("horizon")))
    labels = days.select(*[F.col(k).alias(f"label_{k}") for k in keys], F.col("origin").alias("label_day"), "daily_revenue")
    same = F.col("target") == F.col("label_day")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"label_{key}"))
    day = F.col("target")
    return rows.join(labels, same, "left").select(
        *keys,
        "origin",
        "horizon",
        "target",
        F.dayofyear(day).alias("day_of_year"),
        F.month(day).alias("month"),
        F.dayofweek(day).alias("day_of_week"),
        F.coalesce("lag_7", F.lit(0.0)).alias("lag_7"),
        F.coalesce("lag_30", F.lit(0.0)).alias("lag_30"),
        F.coalesce("lag_7", F.lit(0.0)).alias("rolling_mean_7"),
        "daily_revenue",
    )
