"""Training and inference jobs for the two models."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.constants import CLUSTERS, FORECAST_DAYS
from tillwise.operators import customers, evaluate, features, models, sales
from tillwise.plans.jobs import CLEANED, write_together
from tillwise.sources.tables import GOLD, SILVER, Lakehouse, write_report

FORECAST_MODEL, SEGMENT_MODEL = "sales_forecast", "customer_segmentation"


@dataclass(frozen=True)
class Result:
    """Outcome of a job; a failure is reported in ``status``, not raised."""

    status: str
    details: dict


def _reported(job) -> Result:
    try:
        return Result("success", job())
    except Exception as error:  # noqa: BLE001 - the caller reads the status
        return Result("failed", {"error": f"{type(error).__name__}: {error}"})


def train(spark: SparkSession, lake: Lakehouse, model_root: str, *, k: int = CLUSTERS) -> Result:
    """Train both models on Silver, save them, and store metrics and a health report."""

    def job() -> dict:
        lines = lake.read(spark, SILVER, CLEANED)
        lake.write(sales.daily_sales(lines), GOLD, "training_daily")
        lake.write(features.customer_features(lines), GOLD, "training_customers")
        daily = lake.read(spark, GOLD, "training_daily")
        people = lake.read(spark, GOLD, "training_customers")

        forecaster, errors = models.train_forecast(features.forecast_features(daily))
        clusters = models.train_clusters(people, k)
        models.save_model(forecaster, f"{model_root}/{FORECAST_MODEL}")
        models.save_model(clusters, f"{model_root}/{SEGMENT_MODEL}")

        assigned = models.assign_clusters(clusters, people).filter(models.complete())
        measured = evaluate.metric_rows(
            errors.withColumn("model", F.lit(FORECAST_MODEL)), "model", ["mae", "rmse", "mape", "r_squared", "r2"]
        ).unionByName(
            evaluate.metric_rows(
                evaluate.balance_score(assigned).withColumn("model", F.lit(SEGMENT_MODEL)),
                "model",
                ["num_clusters", "balance_ratio"],
            )
        )
        lake.write(measured, GOLD, "model_metrics")
        measured = lake.read(spark, GOLD, "model_metrics")
        health = evaluate.model_health(measured)
        write_report(evaluate.performance_report(health), f"{model_root}/performance_report")
        return {
            "models": [FORECAST_MODEL, SEGMENT_MODEL],
            "silhouette": models.silhouette(assigned),
            "customers_left_out": models.incomplete_customers(people),
        }

    return _reported(job)


def infer(spark: SparkSession, lake: Lakehouse, model_root: str, *, days: int = FORECAST_DAYS) -> Result:
    """Load the saved models; write a forecast and the customer segments."""

    def job() -> dict:
        lines = lake.read(spark, SILVER, CLEANED)
        forecaster = models.load_model(f"{model_root}/{FORECAST_MODEL}")
        clusters = models.load_model(f"{model_root}/{SEGMENT_MODEL}")
        # Customers with a segment and those without are two readers, so the features are stored first.
        written = write_together(
            lake,
            GOLD,
            {
                "sales_forecast": models.forecast(forecaster, sales.daily_sales(lines), days),
                "inference_customers": features.customer_features(lines),
            },
        )
        people = lake.read(spark, GOLD, "inference_customers")
        segmented = lake.write(models.customer_segments(clusters, people), GOLD, "customer_segments")
        labels = customers.distinct_segments(
            segments(spark, lake).filter(F.col("segment_label").isNotNull()), "segment_label"
        )
        return {
            "forecast_days": written["sales_forecast"],
            "customers": segmented["rows"],
            "segments": labels.first()["segments"],
        }

    return _reported(job)


def segments(spark: SparkSession, lake: Lakehouse) -> DataFrame:
    return lake.read(spark, GOLD, "customer_segments")
