"""Named queries over the order and event tables, one per operator or job.

Each takes a session and the folder of the tables.  Queries that write first (sources,
jobs, streams) use fresh folders below the session's shared folder and return the
written tables.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tillwise.operators import (
    aliases,
    bronze,
    customers,
    evaluate,
    features,
    models,
    monitor,
    quality,
    sales,
    silver,
    views,
)
from tillwise.constants import FORECAST_DAYS, QUINTILES
from tillwise.functions import sketches
from tillwise.plans import gold_tables, jobs, modelling, monitoring
from tillwise.schemas import CORRUPT_COLUMN
from tillwise.sources import run_log_adapter
from tillwise.sources.invoice_adapter import invoice_lines, read_table
from tillwise.sources.tables import GOLD, SILVER, Lakehouse, read_csv, read_run_log, remove, write_table
from tillwise.sources.workspace import new_folder, stored
from tillwise.streaming import pipelines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# A fixed reference time after the newest order and event.
AS_OF = "2024-02-01 00:00:00"
REGRESSION_DIGITS = {"mse": 1, "rmse": 3, "mae": 4, "mape": 6, "r_squared": 8, "r2": 8}


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock times, which compare equal in any session zone."""
    return df.withColumns(
        {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields if isinstance(f.dataType, TimestampType)}
    )


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, sf_dir: zoneless(build(spark, sf_dir))
    return build


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items() if c in df.columns})


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_detailed(invoice_lines(spark, sf_dir))


def _simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_simple(invoice_lines(spark, sf_dir))


def _customer_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(customers.customer_base(_silver(spark, sf_dir)), "customer_base")


def _projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.projection(customers.cltv_simple(customers.rfm_simple(_simple(spark, sf_dir))))


# --- cleaning ----------------------------------------------------------------
@query
def silver_detailed(spark, sf_dir):
    return _silver(spark, sf_dir)


@query
def silver_simple(spark, sf_dir):
    return _simple(spark, sf_dir)


@query
def bronze_annotated(spark, sf_dir):
    return bronze.annotate(invoice_lines(spark, sf_dir), AS_OF)


@query
def retention(spark, sf_dir):
    return silver.retention(invoice_lines(spark, sf_dir))


# --- sales -------------------------------------------------------------------
@query
def daily_sales_detailed(spark, sf_dir):
    return sales.daily_sales(_silver(spark, sf_dir))


@query
def country_sales_detailed(spark, sf_dir):
    return sales.country_sales(_silver(spark, sf_dir))


@query
def product_ranking(spark, sf_dir):
    return sales.rank_products(stored(sales.product_sales(_silver(spark, sf_dir)), "product_totals"))


@query
def product_sales(spark, sf_dir):
    return sales.product_sales(_silver(spark, sf_dir))


@query
def customer_base(spark, sf_dir):
    base = customers.customer_base(_silver(spark, sf_dir))
    return base.withColumn("amount", F.col("amount").cast("double"))


@query
def invoice_rollup(spark, sf_dir):
    rollup = sales.invoice_rollup(_silver(spark, sf_dir))
    return rollup.withColumn("amount_sum", F.col("amount_sum").cast("double"))


@query
def daily_sales_simple(spark, sf_dir):
    return sales.daily_sales_simple(_simple(spark, sf_dir))


@query
def daily_sales_short(spark, sf_dir):
    return sales.daily_sales_simple(_simple(spark, sf_dir)).select("SaleDate", "TotalQuantity", "TotalRevenue")


@query
def top_products_20(spark, sf_dir):
    return sales.top_products(_simple(spark, sf_dir))


@query
def top_products_10(spark, sf_dir):
    return sales.top_descriptions(_simple(spark, sf_dir))


@query
def country_sales_simple(spark, sf_dir):
    return sales.country_sales_simple(_simple(spark, sf_dir))


@query
def country_revenue(spark, sf_dir):
    return sales.country_sales_simple(_simple(spark, sf_dir)).select("Country", "CountryRevenue")


# --- customers ---------------------------------------------------------------
@query
def rfm_detailed(spark, sf_dir):
    return customers.rfm_detailed(_customer_base(spark, sf_dir))


@query
def rfm_sketch(spark, sf_dir):
    return customers.rfm_detailed(_customer_base(spark, sf_dir), sketch=True)


@query
def rfm_thresholds(spark, sf_dir):
    return customers.rfm_thresholds(_customer_base(spark, sf_dir))


@query
def cltv_detailed(spark, sf_dir):
    return customers.cltv_detailed(_customer_base(spark, sf_dir))


@query
def cltv_sketch(spark, sf_dir):
    return customers.cltv_detailed(_customer_base(spark, sf_dir), sketch=True)


def _within(errors: DataFrame) -> DataFrame:
    return errors.select("measure", "share", "n", (F.col("error") <= sketches.rank_error()).alias("within"))


@query
def quantiles_from_sketches(spark, sf_dir):
    """Cut points of line amounts and units, merged from one stored sketch per country and month."""
    lines = _silver(spark, sf_dir)
    measures = {"TotalAmount": "double", "Quantity": "bigint"}
    table = stored(sketches.quantile_table(lines, list(measures), ["Country", "Year", "Month"]), "quantile_sketches")
    cuts = sketches.merged_quantiles(table, measures, QUINTILES)
    found = cuts.select(F.struct(*measures).alias("cuts")).scalar()
    return _within(sketches.rank_errors(lines, list(measures), found, QUINTILES))


@query
def distinct_from_sketches(spark, sf_dir):
    """Customers and invoices of each country and year, and whether daily sketches say the same within their error."""
    lines = _silver(spark, sf_dir)
    columns = ["CustomerID", "InvoiceNo"]
    table = stored(sketches.distinct_table(lines, columns, ["Year", "Month", "Day", "Country"]), "distinct_sketches")
    near = sketches.merged_distinct(table, columns, ["Country", "Year"])
    near = near.select(F.col("Country").alias("near_country"), F.col("Year").alias("near_year"), *[F.col(c).alias(f"near_{c}") for c in columns])
    exact = lines.groupBy("Country", "Year").agg(*[F.count_distinct(F.col(c)).alias(c) for c in columns])
    both = exact.join(near, (F.col("Country") == F.col("near_country")) & (F.col("Year") == F.col("near_year")), "left")
    within = [F.abs(F.col(c) - F.col(f"near_{c}")) <= 1 + sketches.distinct_error() * F.col(c) for c in columns]
    return both.select("Country", "Year", *columns, (within[0] & within[1]).alias("within"))


@query
def returning_customers(spark, sf_dir):
    """Customers who bought in a month and in the one before, and whether the sets of daily sketches agree."""
    lines = _silver(spark, sf_dir).filter(F.col("CustomerID").isNotNull())
    month = F.col("Year") * 12 + F.col("Month")
    table = stored(sketches.distinct_table(lines, ["CustomerID"], ["Year", "Month", "Day"]), "customer_sets")
    near = sketches.returning(table, "CustomerID", month).select(F.col("period").alias("near_period"), F.col("returning").alias("near"), "seen")
    seen = lines.select(month.alias("period"), "CustomerID").distinct()
    before = seen.select((F.col("period") + 1).alias("period"), "CustomerID")
    exact = seen.join(before, ["period", "CustomerID"], "left_semi").groupBy("period").agg(F.count(F.lit(1)).alias("returning"))
    both = exact.join(near, F.col("period") == F.col("near_period"), "left")
    within = F.abs(F.col("returning") - F.col("near")) <= 1 + sketches.distinct_error() * F.col("seen")
    return both.select("period", "returning", within.alias("within"))


@query
def alias_rules(spark, sf_dir):
    """Invoice numbers replaced by the priority of their order: as many rules as there are orders."""
    rules = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("found"), F.col("o_orderpriority").alias("wanted"))
    lines = aliases.with_aliases(invoice_lines(spark, sf_dir), "InvoiceNo", rules)
    return lines.select("InvoiceNo", "StockCode", "Quantity")


@query
def analysis_date(spark, sf_dir):
    registered = _silver(spark, sf_dir).filter(F.col("CustomerID").isNotNull())
    return customers.analysis_date(registered)


@query
def rfm_simple(spark, sf_dir):
    return customers.rfm_simple(_simple(spark, sf_dir))


@query
def cltv_simple(spark, sf_dir):
    return customers.cltv_simple(customers.rfm_simple(_simple(spark, sf_dir)))


@query
def projection_12m(spark, sf_dir):
    return _projection(spark, sf_dir)


@query
def projection_total(spark, sf_dir):
    return customers.projection_total(_projection(spark, sf_dir))


@query
def segment_counts(spark, sf_dir):
    return customers.segment_counts(customers.rfm_detailed(_customer_base(spark, sf_dir)))


@query
def distinct_segments(spark, sf_dir):
    return customers.distinct_segments(customers.rfm_detailed(_customer_base(spark, sf_dir)), "customer_segment")


# --- quality -----------------------------------------------------------------
@query
def null_profile(spark, sf_dir):
    return rounded(quality.null_profile(invoice_lines(spark, sf_dir)), {"completeness_score": 9})


@query
def columns_with_nulls(spark, sf_dir):
    return quality.columns_with_nulls(quality.null_profile(invoice_lines(spark, sf_dir)))


@query
def completeness_silver(spark, sf_dir):
    return quality.silver_completeness(_silver(spark, sf_dir))


@query
def outliers_3sigma(spark, sf_dir):
    return quality.quantity_outliers(_silver(spark, sf_dir))


@query
def outliers_raw(spark, sf_dir):
    return quality.quantity_outliers(invoice_lines(spark, sf_dir))


# --- models ------------------------------------------------------------------
@query
def forecast_features(spark, sf_dir):
    return features.forecast_features(sales.daily_sales(_silver(spark, sf_dir)))


@query
def horizon_features(spark, sf_dir):
    return features.horizon_features(stored(sales.daily_sales(_silver(spark, sf_dir)), "daily"), FORECAST_DAYS)


@query
def rolling_origin_errors(spark, sf_dir):
    """Six folds in time order and the errors of a plain forecast (the mean of the last seven days) in each."""
    series = stored(features.forecast_features(sales.daily_sales(_silver(spark, sf_dir))), "series")
    folds = features.rolling_folds(series, 6, FORECAST_DAYS)
    days = folds.groupBy("fold").agg(
        F.count_if(F.col("part") == "train").alias("train_days"),
        F.max(F.when(F.col("part") == "train", F.col("sale_date"))).alias("train_end"),
        F.min(F.when(F.col("part") == "test", F.col("sale_date"))).alias("test_start"),
    )
    tested = folds.filter(F.col("part") == "test").withColumn("prediction", F.col("lag_7"))
    errors = evaluate.regression_metrics(tested, by=["fold"]).select("fold", "mae", "rmse", "sample_count")
    return rounded(days.join(errors, "fold"), {"mae": 4, "rmse": 3})


@query
def direct_forecast_checked(spark, sf_dir):
    """The days of the direct forecast, and whether each lies between the smallest and largest day so far."""
    daily = stored(sales.daily_sales(_silver(spark, sf_dir)), "daily")
    rows = stored(features.horizon_features(daily, FORECAST_DAYS), "horizons")
    known = daily.agg(F.struct(F.min("daily_revenue").alias("low"), F.max("daily_revenue").alias("high"))).scalar()
    made = models.forecast_direct(models.train_direct(rows), rows)
    return made.select("prediction_date", "horizon", F.col("prediction").between(known["low"], known["high"]).alias("inside"))


@query
def future_features(spark, sf_dir):
    return models.future_features(sales.daily_sales(_silver(spark, sf_dir)))


@query
def customer_features(spark, sf_dir):
    return features.customer_features(_silver(spark, sf_dir), AS_OF)


def _labelled_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a fixed label by spend instead of a trained cluster."""
    known = features.customer_features(_silver(spark, sf_dir))
    band = F.floor(F.col("monetary") / 300000).cast("int")
    return known.withColumn("cluster", F.least(band, F.lit(4)))


@query
def cluster_profile(spark, sf_dir):
    stats = {f"{f}_std": 4 for f in evaluate.CLUSTER_STATISTICS}
    return rounded(evaluate.cluster_profile(_labelled_customers(spark, sf_dir)), stats)


@query
def cluster_balance(spark, sf_dir):
    return evaluate.balance_score(_labelled_customers(spark, sf_dir))


@query
def cluster_sizes(spark, sf_dir):
    return evaluate.cluster_sizes(_labelled_customers(spark, sf_dir))


def _model_errors(spark: SparkSession, sf_dir: str, spread: int = 5) -> DataFrame:
    made = run_log_adapter.predictions(read_table(spark, sf_dir, "orders"), spread)
    return rounded(
        evaluate.regression_metrics(made, "actual", "prediction", by=["model"]), REGRESSION_DIGITS
    )


def _metric_values(spark: SparkSession, sf_dir: str, spread: int = 5) -> DataFrame:
    return evaluate.metric_rows(
        _model_errors(spark, sf_dir, spread), "model", ["mae", "rmse", "mape", "r_squared"]
    )


def _health(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = evaluate.balance_score(_labelled_customers(spark, sf_dir))
    sizes = evaluate.metric_rows(
        balance.withColumn("model", F.lit("customer_segmentation")), "model", ["num_clusters", "balance_ratio"]
    )
    return evaluate.model_health(_metric_values(spark, sf_dir).unionByName(sizes))


@query
def regression_metrics(spark, sf_dir):
    return _model_errors(spark, sf_dir)


@query
def model_impact(spark, sf_dir):
    return evaluate.business_impact(_metric_values(spark, sf_dir, 5), _metric_values(spark, sf_dir, 2))


@query
def model_health(spark, sf_dir):
    return _health(spark, sf_dir)


@query
def model_report(spark, sf_dir):
    return evaluate.performance_report(_health(spark, sf_dir))


@query
def sales_forecast(spark, sf_dir):
    daily = sales.daily_sales(_silver(spark, sf_dir))
    model, _ = models.train_forecast(features.forecast_features(daily))
    return models.forecast(model, daily)


@query
def customer_clusters(spark, sf_dir):
    known = stored(features.customer_features(_silver(spark, sf_dir)), "customer_features")
    return models.customer_segments(models.train_clusters(known), known)


@query
def sales_forecast_checked(spark, sf_dir):
    """The days of the forecast, and whether each lies between the smallest and largest day so far."""
    daily = stored(sales.daily_sales(_silver(spark, sf_dir)), "daily")
    model, _ = models.train_forecast(features.forecast_features(daily))
    known = daily.agg(F.struct(F.min("daily_revenue").alias("low"), F.max("daily_revenue").alias("high"))).scalar()
    inside = F.col("prediction").between(known["low"], known["high"])
    return models.forecast(model, daily).select("prediction_date", inside.alias("inside"))


@query
def customer_clusters_checked(spark, sf_dir):
    """Every customer with its features, and whether its cluster's centre is the nearest."""
    known = stored(features.customer_features(_silver(spark, sf_dir), AS_OF), "customer_features")
    model = models.train_clusters(known)
    return models.nearest_checked(model, known).select("CustomerID", "recency", "frequency", "monetary", "nearest")


@query
def model_reload(spark, sf_dir):
    """Both models, live and after saving and loading: how many rows, and whether all are the same."""
    folder = new_folder(spark, "reload")
    lines = _silver(spark, sf_dir)
    daily = stored(sales.daily_sales(lines), "daily")
    known = stored(features.customer_features(lines, AS_OF), "customer_features")
    trained = {
        "forecast": (models.train_forecast(features.forecast_features(daily))[0], lambda m: models.forecast(m, daily)),
        "clusters": (models.train_clusters(known), lambda m: models.customer_segments(m, known)),
    }
    found = []
    for name, (live, rows_of) in trained.items():
        models.save_model(live, f"{folder}/{name}")
        again = rows_of(models.load_model(f"{folder}/{name}"))
        sides = rows_of(live).withColumn("side", F.lit(1)).unionByName(again.withColumn("side", F.lit(-1)))
        rest = sides.groupBy(*again.columns).agg(F.sum("side").alias("side"), F.count_if(F.col("side") > 0).alias("live"))
        same = F.max(F.abs("side")) == 0
        found.append(rest.agg(F.sum("live").alias("rows"), same.alias("same")).select(F.lit(name).alias("model"), "rows", "same"))
    return monitoring.collect(found)


# --- monitoring --------------------------------------------------------------
def _run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_log_adapter.run_log(read_table(spark, sf_dir, "events"))


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_log_adapter.predictions(read_table(spark, sf_dir, "orders"))


def _accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = monitor.accuracy(_predictions(spark, sf_dir), "actual", "prediction", by=["model"], as_of=AS_OF)
    return rounded(made, {"value": 9})


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored, so that alerts and summaries do not read the log again."""
    checks = [monitor.pipeline_health(_run_log(spark, sf_dir)), _accuracy(spark, sf_dir)]
    return stored(monitoring.collect(checks), "metrics")


def _volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every model is expected to predict twice for each customer."""
    made = _predictions(spark, sf_dir)
    customers_known = read_table(spark, sf_dir, "customer").agg(2 * F.count(F.lit(1))).scalar()
    expected = made.select("model").distinct().withColumn("expected_count", customers_known)
    return monitor.prediction_volume(made, expected, as_of=AS_OF)


@query
def completeness(spark, sf_dir):
    tables = {name: read_table(spark, sf_dir, name) for name in ("customer", "orders", "lineitem", "events")}
    tables["invoice_lines"] = invoice_lines(spark, sf_dir)
    return monitoring.collect([monitor.completeness(df, name, AS_OF) for name, df in tables.items()])


@query
def freshness(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    newest = events.agg(F.max("ts").cast("timestamp")).scalar()
    return rounded(monitor.freshness(events, "ts", "events", newest, by=["event_type"]), {"value": 6})


@query
def accuracy_drift(spark, sf_dir):
    return _accuracy(spark, sf_dir)


@query
def prediction_volume(spark, sf_dir):
    return _volume(spark, sf_dir)


@query
def feature_drift(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem")
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    baseline = stored(monitor.feature_means(lines.filter("l_linestatus = 'F'"), names), "baseline")
    current = lines.filter("l_linestatus <> 'F'").select(*names)
    return rounded(monitor.feature_drift(current, baseline, "lines", AS_OF), {"value": 9})


@query
def distribution_drift(spark, sf_dir):
    """Line items that were shipped late against early ones, and those of large orders against small ones."""
    lines = read_table(spark, sf_dir, "lineitem")
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    found = []
    for model, early in (("flag", F.col("l_linestatus") == "F"), ("units", F.col("l_quantity") < 25)):
        baseline = stored(monitor.feature_sketches(lines.filter(early), names), "baseline_sketches")
        found.append(monitor.distribution_drift(lines.filter(~early).select(*names), baseline, model, AS_OF))
    return monitoring.collect(found).select("name", "threshold", "metric_type", "timestamp", "status", "alert_level")


@query
def model_age(spark, sf_dir):
    trained = read_table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("model"))
    return rounded(monitor.model_age(trained.agg(F.max("o_orderdate").alias("trained_at")), AS_OF), {"value": 6})


@query
def pipeline_success(spark, sf_dir):
    return monitor.success_rate(_run_log(spark, sf_dir))


@query
def pipeline_duration(spark, sf_dir):
    return monitor.duration(_run_log(spark, sf_dir))


@query
def alerts(spark, sf_dir):
    return monitor.alerts(_metrics(spark, sf_dir))


@query
def alert_routes(spark, sf_dir):
    return monitor.alert_routes(monitor.alerts(_metrics(spark, sf_dir)))


def _resolved(metrics: DataFrame) -> DataFrame:
    """All alerts, the ones of level warning resolved by id."""
    raised = monitor.alerts(metrics)
    return monitor.resolve(raised, raised.filter(F.col("level") == "warning"))


@query
def active_alerts(spark, sf_dir):
    return monitor.active_alerts(_resolved(_metrics(spark, sf_dir)))


@query
def critical_alerts(spark, sf_dir):
    return monitor.active_alerts(monitor.alerts(_metrics(spark, sf_dir)), "critical")


@query
def metrics_summary(spark, sf_dir):
    metrics = _metrics(spark, sf_dir)
    newest = _run_log(spark, sf_dir).agg(F.max("timestamp")).scalar()
    return monitor.metrics_summary(metrics, _resolved(metrics), newest)


@query
def recent_metrics(spark, sf_dir):
    return monitor.recent_metrics(_metrics(spark, sf_dir))


@query
def monitoring_cycle(spark, sf_dir):
    lake = Lakehouse(new_folder(spark, "monitoring"))
    log = _run_log(spark, sf_dir)
    checks = [
        monitor.completeness(invoice_lines(spark, sf_dir), "invoice_lines", AS_OF),
        monitor.freshness(read_table(spark, sf_dir, "events"), "ts", "events", AS_OF),
        _accuracy(spark, sf_dir),
        _volume(spark, sf_dir),
        monitor.pipeline_health(log, AS_OF),
    ]
    monitoring.run_cycle(spark, lake, checks, "first")
    metrics, raised = monitoring.history(spark, lake)
    found = raised.groupBy("metric_name").agg(F.count(F.lit(1)).alias("alerts"))
    return (
        metrics.join(found, metrics["name"] == found["metric_name"], "left")
        .groupBy("metric_type", "status")
        .agg(F.count(F.lit(1)).alias("metrics"), F.coalesce(F.sum("alerts"), F.lit(0)).alias("alerts"))
    )


# --- dashboard ---------------------------------------------------------------
@query
def revenue_series(spark, sf_dir):
    return views.revenue_series(sales.daily_sales_simple(_simple(spark, sf_dir)))


@query
def revenue_totals(spark, sf_dir):
    return views.revenue_totals(sales.daily_sales_simple(_simple(spark, sf_dir)))


@query
def top10_lists(spark, sf_dir):
    lines = _simple(spark, sf_dir)
    products = sales.top_products(lines, 10).select(
        F.lit("product").alias("list"), F.col("Description").alias("entry"), F.col("TotalSold").cast("double").alias("measure")
    )
    countries = (
        sales.country_sales_simple(lines)
        .limit(10)
        .select(F.lit("country").alias("list"), F.col("Country").alias("entry"), F.col("CountryRevenue").alias("measure"))
    )
    return products.unionByName(countries)


def _best_customers(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    projected = _projection(spark, sf_dir)
    return monitoring.collect(
        [
            customers.top_customers(projected, measure, n).select(
                F.lit(measure).alias("measure"), "CustomerID", F.col(measure).alias("value")
            )
            for measure in ("Monetary", "CLTV", "ExpectedRevenue_12M")
        ]
    )


@query
def top20_customers(spark, sf_dir):
    return _best_customers(spark, sf_dir, 20)


@query
def top5_customers(spark, sf_dir):
    return _best_customers(spark, sf_dir, 5)


@query
def customer_kpis(spark, sf_dir):
    return views.customer_kpis(customers.rfm_simple(_simple(spark, sf_dir)))


@query
def value_histogram(spark, sf_dir):
    measures = ["CLTV", "ExpectedRevenue_12M", "Recency", "Frequency", "Monetary"]
    return rounded(
        views.histograms(_projection(spark, sf_dir), measures), {"bin_start": 4, "bin_end": 4}
    )


@query
def country_share(spark, sf_dir):
    return views.country_share(sales.country_sales_simple(_simple(spark, sf_dir)))


# --- sources, sinks and jobs -------------------------------------------------
def _as_csv(spark: SparkSession, sf_dir: str, folder: str) -> str:
    path = f"{folder}/csv"
    (
        invoice_lines(spark, sf_dir)
        .write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def _with_bad_lines(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """CSV files in three deliveries; some articles have units or prices that are no numbers."""
    code = F.col("StockCode").cast("bigint")
    bad = {"Quantity": (code % 53 == 0, F.concat(F.lit("~"), "Quantity")), "UnitPrice": (code % 59 == 0, F.lit("free"))}
    lines = invoice_lines(spark, sf_dir).withColumn("delivery", code % 3)
    lines = lines.withColumns({c: F.when(wrong, text).otherwise(F.col(c).cast("string")) for c, (wrong, text) in bad.items()})
    writer = lines.write.option("header", True).option("escape", '"').partitionBy("delivery")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/csv")
    return f"{folder}/csv/delivery=*"


#: What stands for values that could not be read.
UNREADABLE = {"Quantity": 0, "UnitPrice": -1.0, "corrupt_text": ""}


def _marked(found: DataFrame) -> list:
    """Whether the line is corrupt, how its text begins, and the folder of its file."""
    begin = F.substring_index(CORRUPT_COLUMN, ",", 2).alias("corrupt_text")
    return [F.col(CORRUPT_COLUMN).isNotNull().alias("corrupt"), begin, F.element_at(F.split("source_file", "/"), -2).alias("delivery")]


@query
def csv_ingest(spark, sf_dir):
    found = read_csv(spark, _with_bad_lines(spark, sf_dir, new_folder(spark, "ingest")))
    annotated = bronze.annotate(found, AS_OF)
    return annotated.select("*", *_marked(annotated)).drop(CORRUPT_COLUMN, "source_file").na.fill(UNREADABLE)


@query
def table_overwrite(spark, sf_dir):
    """Replaced by a table of another schema, then by the lines with the schema enforced."""
    lake = Lakehouse(new_folder(spark, "overwrite"))
    lines = invoice_lines(spark, sf_dir)
    lake.write(lines.select("InvoiceNo"), SILVER, "lines")
    lake.write(lines, SILVER, "lines")
    lake.write(lines, SILVER, "lines", enforce_schema=True)
    return lake.read(spark, SILVER, "lines")


@query
def table_append(spark, sf_dir):
    lake = Lakehouse(new_folder(spark, "append"))
    lines = invoice_lines(spark, sf_dir)
    returned = F.col("Quantity") < 0
    lake.write(lines.filter(~returned), SILVER, "lines")
    lake.write(lines.filter(returned), SILVER, "lines", "append")
    return lake.read(spark, SILVER, "lines")


@query
def run_log_source(spark, sf_dir):
    path = f"{new_folder(spark, 'log')}/runs"
    run_log_adapter.write_log(_run_log(spark, sf_dir), path)
    return read_run_log(spark, path)



@query
def job_detailed(spark, sf_dir):
    """CSV to five Gold tables; returns the country table as stored."""
    folder = new_folder(spark, "detailed")
    lake = Lakehouse(f"{folder}/lake")
    jobs.run_detailed(spark, _as_csv(spark, sf_dir, folder), lake)
    return lake.read(spark, GOLD, "country_sales")


@query
def job_simple(spark, sf_dir):
    """The simple variant from CSV to its six tables; returns the projection as stored."""
    folder = new_folder(spark, "simple")
    lake = Lakehouse(f"{folder}/lake")
    jobs.run_simple(spark, _as_csv(spark, sf_dir, folder), lake)
    return lake.read(spark, GOLD, "simple_forecast_table")


def _stored_tables(spark: SparkSession, lake: Lakehouse, tables: dict) -> DataFrame:
    return monitoring.collect(
        [gold_tables.long_form(lake.read(spark, GOLD, name), name, table) for name, table in tables.items()]
    )


@query
def job_detailed_tables(spark, sf_dir):
    """CSV to Gold; all five tables as stored, in long form."""
    folder = new_folder(spark, "detailed")
    lake = Lakehouse(f"{folder}/lake")
    jobs.run_detailed(spark, _as_csv(spark, sf_dir, folder), lake)
    return _stored_tables(spark, lake, gold_tables.DETAILED)


@query
def job_simple_tables(spark, sf_dir):
    """The simple variant; all six tables as stored, in long form."""
    folder = new_folder(spark, "simple")
    lake = Lakehouse(f"{folder}/lake")
    jobs.run_simple(spark, _as_csv(spark, sf_dir, folder), lake)
    return _stored_tables(spark, lake, gold_tables.SIMPLE)


@query
def job_models(spark, sf_dir):
    """Training and inference over stored Silver; returns the stored segments."""
    folder = new_folder(spark, "models")
    lake = Lakehouse(f"{folder}/lake")
    write_table(_silver(spark, sf_dir), lake.path(SILVER, jobs.CLEANED))
    for result in (
        modelling.train(spark, lake, f"{folder}/models"),
        modelling.infer(spark, lake, f"{folder}/models"),
    ):
        if result.status != "success":
            raise RuntimeError(result.details["error"])
    return modelling.segments(spark, lake)


# --- streams -----------------------------------------------------------------
def _arriving(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # A glob, as a stream takes a table that is one file only by pattern.
    return pipelines.table_stream(spark, f"{sf_dir}/{name}.parquet*")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _arriving(spark, sf_dir, "events")


def _line_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invoice_lines(spark, sf_dir, _arriving(spark, sf_dir, "lineitem"))


def _streamed(spark: SparkSession, stream: DataFrame, purpose: str, partition_by=(), settings=None) -> DataFrame:
    folder = new_folder(spark, purpose)
    pipelines.run_available(stream, f"{folder}/table", f"{folder}/state", partition_by=partition_by, settings=settings)
    return spark.read.schema(stream.schema).parquet(f"{folder}/table")


WINDOW_DIGITS = {"mean": 6, "deviation": 6}


@query
def stream_windows(spark, sf_dir):
    totals = pipelines.window_totals(_event_stream(spark, sf_dir), "ts", "value", ["event_type"])
    return rounded(_streamed(spark, totals, "windows"), WINDOW_DIGITS)


@query
def stream_sliding_windows(spark, sf_dir):
    totals = pipelines.window_totals(
        _event_stream(spark, sf_dir), "ts", "value", window="6 hours", slide="3 hours"
    )
    return rounded(_streamed(spark, totals, "sliding"), WINDOW_DIGITS)


@query
def stream_alerts(spark, sf_dir):
    totals = pipelines.window_totals(_event_stream(spark, sf_dir), "ts", "value", ["event_type"])
    raised = pipelines.window_alerts(rounded(totals, WINDOW_DIGITS), "events", ["event_type"])
    return rounded(_streamed(spark, raised, "alerts"), {"threshold": 4})


@query
def stream_cleaning(spark, sf_dir):
    return _streamed(spark, pipelines.cleaned(_line_stream(spark, sf_dir)), "cleaning")


def _delivered(df: DataFrame, path: str, slices: list, **options) -> DataFrame:
    """A stream of a table whose slices (conditions) were written one after another; about one slice is a batch."""
    for condition in slices:
        df.filter(condition).write.mode("append").parquet(path)
    files = len(df.sparkSession.read.parquet(path).inputFiles())
    return pipelines.table_stream(df.sparkSession, path, max(1, files // len(slices)), **options)


@query
def stream_redelivery(spark, sf_dir):
    """Line items of which two thirds are delivered twice, some of them a third time.

    One stream writes each line once; another cleans that table.  It has no state, so its join is planned by
    size, and orders are read when lines are cleaned, not for every delivery.  Deliveries and state are needed no
    more by then and are removed, so disk holds them or the joins' shuffle files, not both.
    """
    folder = new_folder(spark, "redelivery")
    part = F.col("l_orderkey") % 3
    slices = [part == 0, part != 2, part >= 1, part == 1]
    lines = read_table(spark, sf_dir, "lineitem")
    with pipelines.with_settings(spark, pipelines.FRUGAL):
        delivered = _delivered(lines, f"{folder}/lines", slices, arrival="arrival", remove_read=True)
    # Line numbers come again in these tables, so a line is the same if all its columns are.
    known = pipelines.once(delivered, lines.columns, "arrival")
    settings = pipelines.frugal(spark, f"{folder}/lines")
    pipelines.run_available(known.select(lines.columns), f"{folder}/known", f"{folder}/state", settings=settings)
    remove(spark, [f"{folder}/lines", f"{folder}/state"])
    arriving = pipelines.table_stream(spark, f"{folder}/known")
    return _streamed(spark, pipelines.cleaned(invoice_lines(spark, sf_dir, arriving)), "redelivery", settings=pipelines.FRUGAL)


@query
def stream_past_anomalies(spark, sf_dir):
    """Event windows, each judged by all values of its type in earlier windows; the events arrive in four parts."""
    folder = new_folder(spark, "past")
    events = read_table(spark, sf_dir, "events")
    span = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    low, step = span["low"], (span["high"] - span["low"]) / 4
    cuts = [F.col("ts") >= F.lit(low), *[F.col("ts") >= F.lit(low + step * i) for i in (1, 2, 3)], F.lit(False)]
    arriving = _delivered(events, f"{folder}/events", [cuts[i] & ~cuts[i + 1] for i in range(4)])
    windows = pipelines.window_totals(arriving, "ts", "value", ["event_type"])
    pipelines.run_batches(windows, pipelines.judge_by_past(f"{folder}/past", ["event_type"]), f"{folder}/state")
    judged = spark.read.parquet(f"{folder}/past/judged").drop("batch_id")
    metrics = pipelines.past_anomalies(judged, "events", ["event_type"])
    return rounded(metrics, {"threshold": 4})


@query
def stream_daily_rollup(spark, sf_dir):
    """The daily table from merged days; the lines arrive in three parts that share most days."""
    folder = new_folder(spark, "rollup")
    part = F.col("l_orderkey") % 3
    stream = _delivered(read_table(spark, sf_dir, "lineitem"), f"{folder}/lines", [part == 0, part == 1, part == 2])
    arriving = invoice_lines(spark, sf_dir, stream)
    undated = F.col("StockCode").cast("bigint") % 89 == 0
    arriving = arriving.withColumn("InvoiceDate", F.when(undated, "unknown").otherwise(F.col("InvoiceDate")))
    work = pipelines.refresh_daily_rollup(f"{folder}/kept", f"{folder}/daily")
    pipelines.run_batches(pipelines.cleaned(arriving), work, f"{folder}/state")
    return spark.read.parquet(f"{folder}/daily").na.fill(0, ["Year", "Month", "Day"])


@query
def stream_validation(spark, sf_dir):
    folder = new_folder(spark, "validation")
    arriving = pipelines.csv_stream(spark, _with_bad_lines(spark, sf_dir, folder))
    pipelines.run_available(
        pipelines.validated(arriving), f"{folder}/checked", f"{folder}/state", partition_by=["check"]
    )
    checked = spark.read.parquet(f"{folder}/checked")
    return checked.select("check", "InvoiceNo", "StockCode", "Quantity", "UnitPrice", *_marked(checked)).na.fill(UNREADABLE)


@query
def stream_quality(spark, sf_dir):
    folder = new_folder(spark, "quality")
    work = pipelines.quality_per_batch("invoice_lines", f"{folder}/metrics")
    pipelines.run_batches(_line_stream(spark, sf_dir), work, f"{folder}/state")
    return spark.read.parquet(f"{folder}/metrics").select("name", "value", "threshold", "status", "alert_level")


@query
def stream_daily_sales(spark, sf_dir):
    folder = new_folder(spark, "refresh")
    work = pipelines.refresh_daily_sales(f"{folder}/silver", f"{folder}/daily")
    arriving = _line_stream(spark, sf_dir)
    # Some articles come without a readable date.
    undated = F.col("StockCode").cast("bigint") % 89 == 0
    arriving = arriving.withColumn("InvoiceDate", F.when(undated, "unknown").otherwise(F.col("InvoiceDate")))
    pipelines.run_batches(pipelines.cleaned(arriving), work, f"{folder}/state")
    # Year, month and day 0 stand for lines without a date.
    return spark.read.parquet(f"{folder}/daily").na.fill(0, ["Year", "Month", "Day"])
