from datetime import datetime, timedelta

import pytest
from conftest import keyed, records
from pyspark.sql import functions as F

from tillwise import schemas
from tillwise.operators import monitor
from tillwise.plans import monitoring
from tillwise.sources import run_log_adapter
from tillwise.sources.tables import Lakehouse, read_run_log

PAIRS = "actual double, predicted double"


def test_completeness_counts_nulls_and_nan(spark, now):
    df = spark.createDataFrame([("a", 1.0), (None, float("nan")), ("c", None), ("d", 4.0)], "s string, v double")
    row = monitor.completeness(df, "t", now).first()
    assert (row["name"], row["value"], row["threshold"]) == ("t_completeness", 0.625, 0.95)
    assert (row["status"], row["alert_level"], row["timestamp"]) == ("unhealthy", "warning", now)


def test_completeness_of_every_type(spark, silver_lines, now):
    row = monitor.completeness(silver_lines, "silver", now).first()
    assert row["value"] == pytest.approx(1 - 2 / (8 * 15))
    assert (row["status"], row["alert_level"]) == ("healthy", None)


def test_completeness_of_an_empty_table(silver_lines, now):
    row = monitor.completeness(silver_lines.limit(0), "silver", now).first()
    assert (row["value"], row["status"]) == (0.0, "unhealthy")


@pytest.mark.parametrize("hours, status", [(1.5, "healthy"), (2.0, "healthy"), (3.0, "unhealthy")])
def test_freshness(spark, now, hours, status):
    df = spark.createDataFrame([(now - timedelta(hours=h),) for h in (hours, 50)], "t timestamp")
    row = monitor.freshness(df, "t", "x", now).first()
    assert (row["value"], row["status"]) == (pytest.approx(hours), status)
    assert row["alert_level"] == (None if status == "healthy" else "warning")


def test_freshness_without_any_time(spark, now):
    for df in (spark.createDataFrame([], "t timestamp"), spark.createDataFrame([(None,)], "t timestamp")):
        row = monitor.freshness(df, "t", "x", now).first()
        assert (row["value"], row["status"], row["alert_level"]) == (999.0, "unhealthy", "critical")


@pytest.mark.parametrize(
    "predicted, value, status",
    [
        ([200, 100, 150, 300, 50], 0.24, "unhealthy"),
        ([105, 195, 295, 155, 245], 0.971, "unhealthy"),
        ([115, 170, 345, 128, 287], 0.852, "healthy"),
    ],
)
def test_accuracy_drifts_to_both_sides(spark, now, predicted, value, status):
    rows = list(zip([100.0, 200.0, 300.0, 150.0, 250.0], map(float, predicted)))
    row = monitor.accuracy(spark.createDataFrame(rows, PAIRS), "actual", "predicted", "m", as_of=now).first()
    assert (row["name"], row["status"], row["threshold"]) == ("m_accuracy", status, 0.8)
    assert row["value"] == pytest.approx(value, abs=1e-3)


def test_accuracy_without_pairs(spark, now):
    for rows in ([], [(1.0, None), (2.0, 2.0)]):
        row = monitor.accuracy(spark.createDataFrame(rows, PAIRS), "actual", "predicted", "m", as_of=now).first()
        assert (row["value"], row["alert_level"], row["status"]) == (0.0, "critical", "unhealthy")


def test_prediction_volume(spark, now):
    made = spark.createDataFrame([("a",)] * 95 + [("b",)] * 50 + [("new",)], "model string")
    expected = spark.createDataFrame([("a", 100), ("b", 100), ("idle", 10), ("none", 0)], "model string, expected_count bigint")
    rows = keyed(monitor.prediction_volume(made, expected, as_of=now), "name")
    assert (rows["a_prediction_volume"]["value"], rows["a_prediction_volume"]["status"]) == (0.95, "healthy")
    assert (rows["b_prediction_volume"]["value"], rows["b_prediction_volume"]["alert_level"]) == (0.5, "warning")
    assert [rows[f"{m}_prediction_volume"]["value"] for m in ("idle", "none", "new")] == [0.0, 0.0, 0.0]


def run(name, status, seconds, event="pipeline_end", level="INFO"):
    return (datetime(2024, 1, 1), level, "p", "m", "mod", "f", 1, None, name, event, status, seconds, None, None)


def test_success_rate_and_duration(spark, now):
    rows = [run("good", "success", 45.0 * 60)] * 99 + [run("good", "failed", 45.0 * 60)]
    rows += [run("bad", "success", 75.0 * 60)] * 9 + [run("bad", "failed", 75.0 * 60)]
    rows += [run("bad", None, None, event="pipeline_start")] * 5
    log = spark.createDataFrame(rows, schemas.RUN_LOG)
    rate = keyed(monitor.success_rate(log, now), "name")
    assert (rate["good_success_rate"]["value"], rate["good_success_rate"]["status"]) == (0.99, "healthy")
    assert (rate["bad_success_rate"]["value"], rate["bad_success_rate"]["alert_level"]) == (0.9, "critical")
    length = keyed(monitor.duration(log, now), "name")
    assert (length["good_duration"]["value"], length["good_duration"]["status"]) == (45.0, "healthy")
    assert (length["bad_duration"]["value"], length["bad_duration"]["alert_level"]) == (75.0, "warning")


@pytest.fixture
def metrics(spark, now):
    rows = [
        ("p_success_rate", 0.90, 0.98, "pipeline_health", now, "unhealthy", "critical"),
        ("t_completeness", 0.8125, 0.95, "data_quality", now, "unhealthy", "warning"),
        ("m_accuracy", 0.86, 0.80, "model_performance", now - timedelta(hours=30), "healthy", None),
    ]
    return spark.createDataFrame(rows, schemas.METRICS)


def test_alerts(metrics, now):
    rows = keyed(monitor.alerts(metrics), "metric_name")
    assert set(rows) == {"p_success_rate", "t_completeness"}
    alert = rows["t_completeness"]
    assert alert["id"].startswith(f"t_completeness_{int((now - datetime(1970, 1, 1)).total_seconds())}_")
    assert alert["title"] == "Data_Quality Alert: t_completeness"
    assert alert["description"] == "Metric t_completeness is 0.812, threshold: 0.950"
    assert (alert["level"], alert["current_value"], alert["resolved"]) == ("warning", 0.8125, False)


def test_numbers_in_alerts_are_those_of_printf(spark, now):
    """A double whose shortest text ends in 5 lies above or below that tie."""
    values = [0.7875, 0.9625, 0.9735, 0.9995, -0.7875, 0.0005, 1e-300, 12345.0625, 2.0**53, 2.0**62]
    rows = [(f"x{i}", v, 0.98, "data_quality", now, "unhealthy", "warning") for i, v in enumerate(values)]
    raised = keyed(monitor.alerts(spark.createDataFrame(rows, schemas.METRICS)), "metric_name")
    for i, v in enumerate(values):
        assert raised[f"x{i}"]["description"] == f"Metric x{i} is {v:.3f}, threshold: 0.980"


def test_alerts_of_one_second_have_different_ids(spark, now):
    rows = [
        ("x", 0.1, 0.9, "data_quality", now + timedelta(milliseconds=i), "unhealthy", "warning") for i in range(3)
    ]
    ids = [r["id"] for r in monitor.alerts(spark.createDataFrame(rows, schemas.METRICS)).collect()]
    assert len(set(ids)) == 3


def test_routes(metrics, spark):
    raised = monitor.alerts(metrics)
    routes = {(r["level"], r["channel"]) for r in monitor.alert_routes(raised).collect()}
    assert routes == {
        ("warning", "log"), ("warning", "email"), ("critical", "log"), ("critical", "email"), ("critical", "slack"),
    }
    unknown = monitor.alert_routes(raised.withColumn("level", F.lit("odd")))
    assert {r["channel"] for r in unknown.collect()} == {"log"}


def test_resolving(metrics):
    raised = monitor.alerts(metrics)
    done = raised.filter("level = 'warning'").select("id")
    left = monitor.active_alerts(monitor.resolve(raised, done.unionByName(done)))
    assert [r["metric_name"] for r in left.collect()] == ["p_success_rate"]
    assert monitor.active_alerts(raised, "warning").count() == 1
    assert monitor.active_alerts(raised, "info").count() == 0


def test_summary(metrics, spark, now):
    raised = monitor.alerts(metrics)
    row = monitor.metrics_summary(metrics, raised, now).first()
    assert (row["total_metrics"], row["recent_metrics"], row["active_alerts"]) == (3, 2, 2)
    assert (row["health_status"], row["message"]) == ("unhealthy", None)
    later = monitor.metrics_summary(metrics, raised, now + timedelta(days=9)).first()
    assert (later["recent_metrics"], later["health_status"]) == (0, "healthy")
    none = monitor.metrics_summary(metrics.limit(0), raised.limit(0), now).first()
    assert (none["total_metrics"], none["health_status"], none["message"]) == (0, None, "No metrics collected yet")


def test_recent_metrics(metrics):
    assert [r["name"] for r in monitor.recent_metrics(metrics, 2).collect()] == ["p_success_rate", "t_completeness"]


def test_run_log_survives_json(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    log = run_log_adapter.run_log(events)
    run_log_adapter.write_log(log, str(tmp_path / "log"))
    stored = read_run_log(spark, str(tmp_path / "log"))
    assert stored.columns == log.columns
    assert sorted(map(str, stored.collect())) == sorted(map(str, log.collect()))


def test_cycle_can_be_repeated(spark, silver_lines, now, tmp_path):
    lake = Lakehouse(str(tmp_path / "lake"))
    checks = lambda: [
        monitor.completeness(silver_lines, "silver", now),
        monitor.freshness(silver_lines, "InvoiceTimestamp", "silver", now),
    ]
    for _ in range(2):
        assert monitoring.run_cycle(spark, lake, checks(), "one") == {"metrics_collected": 2, "alerts_generated": 1}
    monitoring.run_cycle(spark, lake, checks(), "two")
    metrics, raised = monitoring.history(spark, lake)
    assert (metrics.count(), raised.count()) == (4, 2)
    assert {r["metric_name"] for r in records(raised)} == {"silver_freshness"}


def test_both_pipeline_checks_come_from_one_pass(spark, now, capsys):
    log = run_log_adapter.run_log(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    both = monitor.pipeline_health(log)
    single = monitor.success_rate(log).unionByName(monitor.duration(log))
    assert sorted(map(str, both.collect())) == sorted(map(str, single.collect()))
    monitor.pipeline_health(log).explain()
    assert capsys.readouterr().out.count("FileScan") == 1


def test_feature_drift(spark, now):
    then = spark.createDataFrame([(10.0, 1.0), (30.0, 1.0)], "a double, b double")
    baseline = monitor.feature_means(then, ["a", "b"]).unionByName(
        spark.createDataFrame([("gone", 2.0)], "feature string, mean double")
    )
    later = spark.createDataFrame([(21.0, 1.5), (21.0, None)], "a double, b double")
    rows = {r["name"]: r for r in monitor.feature_drift(later, baseline, "m", now).collect()}
    assert rows["m_a_drift"]["value"] == pytest.approx(0.05) and rows["m_a_drift"]["status"] == "healthy"
    assert rows["m_b_drift"]["value"] == pytest.approx(0.5) and rows["m_b_drift"]["alert_level"] == "warning"
    assert (rows["m_gone_drift"]["value"], rows["m_gone_drift"]["alert_level"]) == (1.0, "critical")


def test_model_age(spark, now):
    table = spark.createDataFrame(
        [("new", now), ("old", now.replace(year=now.year - 1)), ("unknown", None)], "model string, trained_at timestamp"
    )
    rows = {r["name"]: (r["value"], r["status"], r["alert_level"]) for r in monitor.model_age(table, now).collect()}
    assert rows["new_age_days"] == (0.0, "healthy", None)
    assert rows["old_age_days"] == (365.0, "unhealthy", "warning")
    assert rows["unknown_age_days"][1:] == ("unhealthy", "critical")
