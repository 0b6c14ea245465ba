from datetime import date, timedelta

import pytest
from conftest import keyed, records
from pyspark.sql import functions as F

from tillwise.constants import CLUSTER_LABELS
from tillwise.operators import evaluate, features, models, sales
from tillwise.plans import jobs, modelling
from tillwise.sources.tables import GOLD, SILVER, Lakehouse, write_report


@pytest.fixture(scope="module")
def daily(spark):
    start = date(2024, 1, 1)
    days = [(start + timedelta(days=i), float(100 + 10 * (i % 7))) for i in range(60)]
    return spark.createDataFrame(days, "d date, daily_revenue double").select(
        F.year("d").alias("Year"), F.month("d").alias("Month"), F.dayofmonth("d").alias("Day"), "daily_revenue"
    )


@pytest.fixture(scope="module")
def people(spark):
    rows = [(str(i), i % 9, 3 + i % 5, 100.0 + i, 20.0) for i in range(40)]
    rows += [(str(100 + i), 200 + i % 9, 1, 5.0 + i % 3, 5.0) for i in range(40)]
    rows += [(str(200 + i), i % 4, 60 + i % 5, 9000.0 + i, 150.0) for i in range(20)]
    return spark.createDataFrame(
        rows, "CustomerID string, recency int, frequency bigint, monetary double, avg_order_value double"
    )


def test_forecast_features(silver_lines):
    rows = keyed(features.forecast_features(sales.daily_sales(silver_lines)), "sale_date")
    means = {day: (r["lag_7"], r["lag_30"], r["rolling_mean_7"]) for day, r in rows.items()}
    assert means == {date(2022, 6, 10): (0.0,) * 3, date(2022, 6, 12): (17.25,) * 3, date(2022, 7, 1): (51.5,) * 3}
    first = rows[date(2022, 6, 10)]
    assert (first["day_of_year"], first["month"], first["day_of_week"]) == (161, 6, 6)


def test_windows_against_brute_force(daily):
    rows = records(features.forecast_features(daily).orderBy("sale_date"))
    revenue = [r["daily_revenue"] for r in rows]
    for i, row in enumerate(rows):
        for name, size in (("lag_7", 7), ("lag_30", 30)):
            before = revenue[max(0, i - size) : i]
            assert row[name] == pytest.approx(sum(before) / len(before) if before else 0.0)


def test_series_per_key_do_not_mix(daily):
    both = daily.withColumn("Country", F.lit("A")).unionByName(
        daily.withColumn("Country", F.lit("B")).withColumn("daily_revenue", F.col("daily_revenue") * 2)
    )
    rows = keyed(features.forecast_features(both, ["Country"]), "Country", "sale_date")
    day = date(2024, 1, 20)
    assert rows["B", day]["lag_7"] == pytest.approx(2 * rows["A", day]["lag_7"])


def test_folds_never_train_on_what_follows(daily):
    series = features.forecast_features(daily)
    rows = records(features.rolling_folds(series, 3, 10))
    days = sorted(r["sale_date"] for r in records(series))
    for fold in (1, 2, 3):
        own = {part: sorted(r["sale_date"] for r in rows if (r["fold"], r["part"]) == (fold, part)) for part in ("train", "test")}
        end = days[-1] - timedelta(days=10 * (fold - 1))
        assert own["test"] == [d for d in days if end - timedelta(days=10) < d <= end]
        assert own["train"] == [d for d in days if d <= end - timedelta(days=10)]


def test_horizons_know_nothing_later_than_their_origin(daily):
    rows = keyed(features.horizon_features(daily, 5), "origin", "horizon")
    revenue = {date(r["Year"], r["Month"], r["Day"]): r["daily_revenue"] for r in records(daily)}
    days = sorted(revenue)
    assert len(rows) == 5 * len(days)
    for (origin, horizon), row in rows.items():
        past = [revenue[d] for d in days if d <= origin]
        assert row["target"] == origin + timedelta(days=horizon) and row["daily_revenue"] == revenue.get(row["target"])
        for name, size in (("lag_7", 7), ("lag_30", 30)):
            assert row[name] == pytest.approx(sum(past[-size:]) / len(past[-size:]))
        assert row["month"] == row["target"].month


def test_direct_forecast_follows_the_calendar(daily):
    """One model; every horizon has its own features, so a weekly pattern shows in the forecast."""
    weekly = daily.withColumn("daily_revenue", F.when(F.dayofweek(F.make_date("Year", "Month", "Day")) == 1, 900.0).otherwise(100.0))
    rows = features.horizon_features(weekly, 14)
    made = keyed(models.forecast_direct(models.train_direct(rows), rows), "horizon")
    assert set(made) == set(range(1, 15))
    sundays = [r["prediction"] for r in made.values() if r["prediction_date"].isoweekday() == 7]
    others = [r["prediction"] for r in made.values() if r["prediction_date"].isoweekday() != 7]
    assert len(sundays) == 2 and min(sundays) > 2 * max(others)


def test_customer_features(silver_lines):
    rows = keyed(features.customer_features(silver_lines, "2022-07-11 00:00:00"), "CustomerID")
    found = {k: (r["recency"], r["frequency"], r["monetary"], r["avg_order_value"]) for k, r in rows.items()}
    assert found == {"c2": (10, 3, 138.0, 46.0), "c5": (29, 1, 36.75, 36.75), "c8": (10, 2, 98.0, 49.0)}
    assert keyed(features.customer_features(silver_lines), "CustomerID")["c5"]["recency"] == 19


def test_future_features_use_history(daily):
    rows = records(models.future_features(daily, 3).orderBy("prediction_date"))
    assert [r["prediction_date"] for r in rows] == [date(2024, 3, 1), date(2024, 3, 2), date(2024, 3, 3)]
    history = [100 + 10 * (i % 7) for i in range(60)]
    assert rows[0]["lag_7"] == pytest.approx(sum(history[-7:]) / 7)
    assert rows[0]["lag_30"] == pytest.approx(sum(history[-30:]) / 30)
    assert [r["day_of_week"] for r in rows] == [6, 7, 1]


def test_split_is_the_same_on_any_partitioning(daily):
    days = features.forecast_features(daily)
    chosen = [
        {r[0] for r in d.filter(models.in_training(F.col("sale_date"))).select("sale_date").collect()}
        for d in (days, days.repartition(7), days.coalesce(1))
    ]
    assert chosen[0] == chosen[1] == chosen[2]
    assert 40 <= len(chosen[0]) <= 56


def test_forecast_model_is_repeatable_and_reloads(daily, tmp_path):
    known = features.forecast_features(daily)
    model, errors = models.train_forecast(known, trees=10)
    again, _ = models.train_forecast(known, trees=10)
    first = records(models.forecast(model, daily, 5))
    assert first == records(models.forecast(again, daily, 5))
    assert set(errors.columns) == {"mae", "rmse", "r2", "mape", "r_squared"}
    path = str(tmp_path / "m")
    models.save_model(model, path)
    models.save_model(model, path)
    assert records(models.forecast(models.load_model(path), daily, 5)) == first


def test_clusters_are_labelled_by_spend(people):
    model = models.train_clusters(people, k=3)
    rows = keyed(models.customer_segments(model, people), "CustomerID")
    assert len(rows) == people.count()
    assert rows["200"]["segment_label"] == CLUSTER_LABELS[0]
    assert rows["0"]["segment_label"] == CLUSTER_LABELS[1]
    assert rows["100"]["segment_label"] == CLUSTER_LABELS[2]
    assert 0.5 < models.silhouette(models.assign_clusters(model, people)) <= 1


def test_cluster_tables(people):
    fixed = people.withColumn(
        "cluster", F.when(F.col("monetary") > 1000, 0).when(F.col("recency") < 100, 1).otherwise(2)
    )
    rows = keyed(evaluate.cluster_profile(fixed), "cluster")
    assert [(rows[c]["count"], rows[c]["percentage"]) for c in range(3)] == [(20, 20.0), (40, 40.0), (40, 40.0)]
    assert all(r["balance_ratio"] == 0.5 for r in rows.values())
    assert rows[0]["monetary_min"] == 9000.0 and rows[0]["monetary_max"] == 9019.0
    assert rows[0]["monetary_mean"] == pytest.approx(9009.5)
    assert evaluate.balance_score(fixed).first()["balance_ratio"] == 0.5
    lone = evaluate.cluster_profile(fixed.filter("CustomerID = '200'")).first()
    assert lone["monetary_std"] == 0.0 and lone["balance_ratio"] == 1.0


def test_regression_metrics(spark):
    rows = [(100.0, 110.0), (200.0, 190.0), (400.0, 380.0), (0.0, 5.0)]
    row = evaluate.regression_metrics(spark.createDataFrame(rows, "daily_revenue double, prediction double")).first()
    assert row["mse"] == pytest.approx((100 + 100 + 400 + 25) / 4)
    assert row["rmse"] == pytest.approx(row["mse"] ** 0.5)
    assert row["mae"] == pytest.approx(45 / 4)
    assert row["mape"] == pytest.approx((10 + 5 + 5) / 3), "a zero label is skipped"
    mean = 175.0
    squares = sum((a - mean) ** 2 for a, _ in rows)
    assert row["r_squared"] == pytest.approx(1 - 625 / (4 * squares / 3))
    assert row["r2"] == pytest.approx(1 - 625 / squares)
    assert row["sample_count"] == 4


def test_r_squared_of_constant_labels_is_zero(spark):
    df = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "daily_revenue double, prediction double")
    assert evaluate.regression_metrics(df).first()["r_squared"] == 0.0
    assert evaluate.regression_metrics(df.limit(1)).first()["r_squared"] == 0.0


METRICS = "model string, metric string, value double"


def test_business_impact(spark):
    base = spark.createDataFrame([("m", "mae", 120.0), ("m", "r_squared", 0.65), ("m", "zero", 0.0)], METRICS)
    now = spark.createDataFrame([("m", "mae", 100.0), ("m", "r_squared", 0.75), ("m", "zero", 3.0)], METRICS)
    found = {r["impact"]: r["value"] for r in evaluate.business_impact(base, now).collect()}
    assert found == {
        "mae_improvement_pct": -16.67,
        "r_squared_improvement_pct": 15.38,
        "zero_improvement_pct": 0.0,
        "forecast_accuracy_improvement": 20.0,
        "model_reliability_score": 75.0,
    }


def test_model_health(spark):
    rows = [
        ("good", "r_squared", 0.85), ("good", "mae", 50.0), ("good", "mape", 8.5),
        ("bad", "r_squared", 0.45), ("bad", "mae", 1500.0), ("bad", "mape", 25.0),
        ("costly", "mae", 1500.0), ("uneven", "balance_ratio", 0.2), ("other", "rmse", 9e9),
    ]
    health = keyed(evaluate.model_health(spark.createDataFrame(rows, METRICS)), "model")
    good, bad = health["good"], health["bad"]
    assert (good["status"], good["alert_count"], good["passed_checks"]) == ("healthy", 0, 3)
    assert (bad["status"], bad["max_severity"], bad["alert_count"]) == ("warning", "critical", 3)
    assert bad["alerts"] == (
        "R-squared (0.450) below threshold (0.7); MAE (1500.00) above threshold (1000.0); "
        "MAPE (25.0%) above threshold (15.0%)"
    )
    assert health["costly"]["status"] == "critical"
    assert health["uneven"]["alerts"] == "Cluster balance ratio (0.200) below threshold (0.3)"
    assert (health["other"]["status"], health["other"]["metrics_checked"]) == ("healthy", 1)


def test_performance_report(spark, tmp_path):
    rows = [("forecast", "mae", 100.0), ("forecast", "r_squared", 0.8), ("segmentation", "balance_ratio", 0.6)]
    health = evaluate.model_health(spark.createDataFrame(rows, METRICS))
    report = evaluate.performance_report(health)
    assert records(report) == [{"models_evaluated": 2, "overall_health": "healthy", "total_alerts": 0}]
    write_report(report, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).first()["overall_health"] == "healthy"
    worse = spark.createDataFrame(rows + [("a", "mae", 2000.0), ("z", "mape", 99.0)], METRICS)
    row = evaluate.performance_report(evaluate.model_health(worse)).first()
    assert (row["overall_health"], row["total_alerts"]) == ("warning", 2)


def test_training_and_inference_jobs(spark, tmp_path):
    from tillwise.operators import silver
    from tillwise.sources.invoice_adapter import invoice_lines

    lake = Lakehouse(str(tmp_path / "lake"))
    assert modelling.infer(spark, lake, str(tmp_path / "models")).status == "failed"
    lines = silver.silver_detailed(invoice_lines(spark, "/root/testdata/sf0.001"))
    lake.write(lines, SILVER, jobs.CLEANED)
    trained = modelling.train(spark, lake, str(tmp_path / "models"), k=3)
    assert trained.status == "success", trained.details
    result = modelling.infer(spark, lake, str(tmp_path / "models"), days=10)
    assert result.status == "success", result.details
    registered = lines.filter("CustomerID is not null").select("CustomerID").distinct().count()
    assert result.details == {"forecast_days": 10, "customers": registered, "segments": 3}
    assert lake.read(spark, GOLD, "model_metrics").count() == 7


def test_customers_without_a_date_do_not_stop_the_models(spark, people):
    unknown = spark.createDataFrame(
        [("x", None, 2, 50.0, 25.0)], "CustomerID string, recency int, frequency bigint, monetary double, avg_order_value double"
    )
    everyone = people.unionByName(unknown)
    assert models.incomplete_customers(everyone) == 1
    model = models.train_clusters(everyone, k=3)
    rows = keyed(models.customer_segments(model, everyone), "CustomerID")
    assert len(rows) == people.count() + 1
    assert (rows["x"]["cluster"], rows["x"]["segment_label"]) == (None, None)
    assert 0.5 < models.silhouette(models.assign_clusters(model, everyone)) <= 1


def test_sales_without_a_date_are_no_day_of_the_series(spark, daily):
    undated = spark.createDataFrame([(None, None, None, 5.0)], daily.schema)
    model, _ = models.train_forecast(features.forecast_features(daily.unionByName(undated)), trees=3)
    assert models.forecast(model, daily, 2).count() == 2
