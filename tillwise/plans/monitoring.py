"""Monitoring cycle: run the checks, append their metrics and the alerts they raise."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tillwise.operators import monitor
from tillwise.sources.tables import Lakehouse

MONITORING = "monitoring"
METRICS, ALERTS = "metrics", "alerts"


def collect(checks: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def run_cycle(spark: SparkSession, lake: Lakehouse, checks: Iterable[DataFrame], cycle: str) -> dict:
    """Store one cycle under its own name, so repeating it replaces it and adds nothing.

    Alerts derive from the metrics as stored, not from a second run of the checks.
    """
    measured = lake.write(collect(checks), MONITORING, f"{METRICS}/cycle={cycle}")
    stored = lake.read(spark, MONITORING, f"{METRICS}/cycle={cycle}")
    raised = lake.write(monitor.alerts(stored), MONITORING, f"{ALERTS}/cycle={cycle}")
    return {"metrics_collected": measured["rows"], "alerts_generated": raised["rows"]}


def history(spark: SparkSession, lake: Lakehouse) -> tuple[DataFrame, DataFrame]:
    """All metrics and alerts so far."""
    return lake.read(spark, MONITORING, METRICS), lake.read(spark, MONITORING, ALERTS)
