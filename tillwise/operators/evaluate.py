"""Model evaluation, business impact and health as tables.

Wide tables hold one row per model; ``metric_rows`` turns them into
``(model, metric, value)`` rows, which impact and health work on.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.constants import HEALTHY, MODEL_CHECKS, SEVERITY
from tillwise.functions.scoring import first_match
from tillwise.functions.text import fixed
from tillwise.operators.quality import percent

CLUSTER_STATISTICS = ("recency", "frequency", "monetary")


def regression_metrics(
    predictions: DataFrame,
    label: str = "daily_revenue",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """All error measures from one aggregation.

    ``r_squared`` divides by n times the sample variance; ``r2`` is the usual
    coefficient, which divides by the sum of squares about the mean.
    """
    actual, error = F.col(label), F.col(label) - F.col(prediction)
    squared = error * error
    rows = F.count(actual)
    unexplained = F.sum(squared)
    return (
        predictions.groupBy(*by)
        .agg(
            F.avg(squared).alias("mse"),
            F.sqrt(F.avg(squared)).alias("rmse"),
            F.avg(F.abs(error)).alias("mae"),
            F.avg(F.abs(F.try_divide(error, actual)) * 100).alias("mape"),
            (1 - unexplained / F.nullif(rows * F.var_samp(actual), F.lit(0.0))).alias("r_squared"),
            (1 - unexplained / F.nullif(rows * F.var_pop(actual), F.lit(0.0))).alias("r2"),
            rows.alias("sample_count"),
        )
        .na.fill(0.0, ["r_squared", "r2"])
    )


def cluster_sizes(predictions: DataFrame, cluster: str = "cluster") -> DataFrame:
    return predictions.groupBy(cluster).agg(F.count(F.lit(1)).alias("count"))


def balance_score(predictions: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Smallest over largest cluster."""
    return cluster_sizes(predictions, cluster).agg(
        F.count(F.lit(1)).alias("num_clusters"),
        F.sum("count").alias("total_samples"),
        F.try_divide(F.min("count"), F.max("count")).alias("balance_ratio"),
    )


def cluster_profile(
    predictions: DataFrame,
    cluster: str = "cluster",
    features: Sequence[str] = CLUSTER_STATISTICS,
) -> DataFrame:
    """Size, share and feature statistics of every cluster from one aggregation.

    The window that compares clusters runs over one row per cluster.
    """

    def statistics(feature: str) -> list[Column]:
        value = F.col(feature)
        exact = F.sum(value.cast("decimal(38,10)")).cast("double")
        return [
            F.coalesce(c.cast("double"), F.lit(0.0)).alias(f"{feature}_{name}")
            for name, c in (
                ("mean", F.try_divide(exact, F.count(value))),
                ("std", F.stddev_samp(value)),
                ("min", F.min(value)),
                ("max", F.max(value)),
            )
        ]

    present = [f for f in features if f in predictions.columns]
    everything = Window.partitionBy()
    size = F.col("count")
    return (
        predictions.groupBy(cluster)
        .agg(F.count(F.lit(1)).alias("count"), *[c for f in present for c in statistics(f)])
        .withColumns(
            {
                "percentage": percent(size, F.sum(size).over(everything)),
                "balance_ratio": F.try_divide(
                    F.min(size).over(everything), F.max(size).over(everything)
                ),
            }
        )
    )


def metric_rows(wide: DataFrame, model: str, metrics: Sequence[str]) -> DataFrame:
    """``(model, metric, value)`` rows of a wide metric table."""
    return wide.select(
        F.col(model).cast("string").alias("model"), *[F.col(m).cast("double").alias(m) for m in metrics]
    ).unpivot("model", list(metrics), "metric", "value")


def business_impact(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Change of each metric from baseline to current, per model.

    Gives percentage changes for the metrics both have, the absolute error saved, and
    100 times the current r squared as a reliability score.
    """
    value = F.col("value")
    change = F.coalesce(
        F.round(F.try_divide(value - F.col("base"), F.col("base")) * 100, 2), F.lit(0.0)
    )
    both = current.join(
        baseline.withColumnRenamed("value", "base"), ["model", "metric"]
    )
    gains = F.array(
        F.struct(F.concat("metric", F.lit("_improvement_pct")).alias("impact"), change.alias("value")),
        F.struct(
            F.when(F.col("metric") == "mae", "forecast_accuracy_improvement").alias("impact"),
            F.round(F.col("base") - value, 2).alias("value"),
        ),
    )
    reliability = current.filter(F.col("metric") == "r_squared").select(
        "model", F.lit("model_reliability_score").alias("impact"), F.round(value * 100, 1).alias("value")
    )
    return (
        both.select("model", F.explode(gains).alias("gain"))
        .select("model", "gain.impact", "gain.value")
        .filter(F.col("impact").isNotNull())
        .unionByName(reliability)
    )


def _breaches() -> tuple[Column, Column, Column, Column]:
    """Per metric row: order of the check (null: not checked), breached, status, text."""
    metric, value = F.col("metric"), F.col("value")
    orders, breached, states, texts = [], [], [], []
    for order, (name, side, limit, status, title, unit, digits) in enumerate(MODEL_CHECKS):
        text = f"{title} (%s{unit.replace('%', '%%')}) {side} threshold ({limit}{unit.replace('%', '%%')})"
        here = metric == name
        broken = value < limit if side == "below" else value > limit
        orders.append(F.when(here, F.lit(order)))
        breached.append(F.when(here, broken))
        states.append((here, status))
        texts.append(F.when(here, F.format_string(text, fixed(value, digits))))
    return (
        F.coalesce(*orders),
        F.coalesce(*breached, F.lit(False)),
        first_match(states),
        F.coalesce(*texts),
    )


def model_health(metrics: DataFrame) -> DataFrame:
    """Status, alerts and passed checks per model from ``(model, metric, value)`` rows.

    Checks run in the order of the limit table and the last one that fails sets
    ``status``; ``max_severity`` is the worst.  Alert lists hold at most one text per
    limit.
    """
    order, breached, status, text = _breaches()
    severity = F.array_position(F.array(*map(F.lit, SEVERITY)), F.col("status"))
    checked = metrics.select(
        "model",
        order.alias("order"),
        breached.alias("breached"),
        status.alias("status"),
        text.alias("text"),
    )
    broken = F.col("breached")
    alerts = F.array_sort(F.collect_list(F.when(broken, F.struct("order", "text"))))
    return checked.groupBy("model").agg(
        F.coalesce(
            F.max_by(F.when(broken, F.col("status")), F.when(broken, F.col("order"))), F.lit(HEALTHY)
        ).alias("status"),
        F.element_at(
            F.array(*map(F.lit, SEVERITY)),
            F.coalesce(F.max(F.when(broken, severity)), F.lit(1)).cast("int"),
        ).alias("max_severity"),
        F.count_if(broken).alias("alert_count"),
        F.count_if(F.col("order").isNotNull() & ~broken).alias("passed_checks"),
        F.count(F.lit(1)).alias("metrics_checked"),
        F.concat_ws("; ", F.transform(alerts, lambda a: a["text"])).alias("alerts"),
    )


def performance_report(health: DataFrame) -> DataFrame:
    """One row over all models; the last unhealthy model by name sets the overall health."""
    unhealthy = F.col("status") != HEALTHY
    return health.agg(
        F.count(F.lit(1)).alias("models_evaluated"),
        F.coalesce(
            F.max_by(F.when(unhealthy, F.col("status")), F.when(unhealthy, F.col("model"))),
            F.lit(HEALTHY),
        ).alias("overall_health"),
        F.coalesce(F.sum("alert_count"), F.lit(0)).alias("total_alerts"),
    )
