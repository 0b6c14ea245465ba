"""Pipeline run log and model predictions from the event and order tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.constants import PIPELINE_END, SUCCESS

LOG_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def run_log(events: DataFrame) -> DataFrame:
    """One log line per event; sign-ups stand for starts, errors for failed runs."""
    ended = F.col("event_type") != "signup"
    return events.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit("INFO").alias("level"),
        F.lit("pipeline").alias("logger"),
        F.concat(F.lit("run "), F.col("event_id").cast("string")).alias("message"),
        F.lit("jobs").alias("module"),
        F.lit("run").alias("function"),
        F.lit(1).alias("line"),
        F.lit(None).cast("string").alias("exception"),
        F.concat(F.lit("pipeline_"), F.col("user_id").cast("string")).alias("pipeline_name"),
        F.when(ended, PIPELINE_END).otherwise("pipeline_start").alias("event_type"),
        F.when(ended, F.when(F.col("event_type") == "error", "failed").otherwise(SUCCESS)).alias("status"),
        F.when(ended, F.col("value") * 60).alias("duration_seconds"),
        F.lit(None).cast("string").alias("table_name"),
        F.lit(None).cast("string").alias("operation"),
    )


def write_log(log: DataFrame, path: str) -> None:
    log.write.mode("overwrite").option("timestampFormat", LOG_TIME_FORMAT).json(path)


def predictions(orders: DataFrame, spread: int = 5) -> DataFrame:
    """Order totals with a prediction up to ``spread`` percent off; the priority is the model."""
    wheel = 2 * spread + 1
    error = (F.col("o_orderkey") % wheel - spread) / F.lit(100.0)
    return orders.select(
        F.col("o_orderpriority").alias("model"),
        "o_orderstatus",
        F.col("o_totalprice").alias("actual"),
        (F.col("o_totalprice") * (1 + error)).alias("prediction"),
    )
