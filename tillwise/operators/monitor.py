"""Monitoring as tables: metric rows, alerts, routes, summaries.

Every check returns rows of the ``metrics`` table, one per table, model or pipeline.
"""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tillwise import constants as K
from tillwise.functions import money
from tillwise.functions.sketches import ks_distance, quantile_sketch
from tillwise.functions.text import fixed
from tillwise.functions.times import moment
from tillwise.operators.quality import missing_cells

Moment = datetime | str | Column | None

# sklearn-style relative error divides by at least this.
MACHINE_EPSILON = 2.220446049250313e-16


def _metric_rows(
    df: DataFrame,
    *,
    name: Column,
    value: Column,
    threshold: float,
    kind: str,
    healthy: Column,
    level: Column | str,
    stamp: Column,
) -> DataFrame:
    level = F.lit(level) if isinstance(level, str) else level
    return df.select(
        name.alias("name"),
        value.cast("double").alias("value"),
        F.lit(threshold).cast("double").alias("threshold"),
        F.lit(kind).alias("metric_type"),
        stamp.alias("timestamp"),
        F.when(healthy, K.HEALTHY).otherwise(K.UNHEALTHY).alias("status"),
        F.when(~healthy, level).alias("alert_level"),
    )


def _named(subject: str | None, by: Sequence[str], suffix: str) -> Column:
    parts = ([F.lit(subject)] if subject else []) + [F.col(c).cast("string") for c in by]
    return F.concat_ws("_", *parts, F.lit(suffix))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def completeness(df: DataFrame, table: str, as_of: Moment = None) -> DataFrame:
    """Filled share of all cells; NaN counts as empty, an empty table as 0."""
    cells = F.col("rows") * F.lit(len(df.columns))
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"), missing_cells(df, df.columns, nan=True).alias("empty")
    ).select(_ratio(cells - F.col("empty"), cells).alias("value"))
    return _metric_rows(
        counted,
        name=F.lit(f"{table}_completeness"),
        value=F.col("value"),
        threshold=K.MIN_COMPLETENESS,
        kind=K.DATA_QUALITY,
        healthy=F.col("value") >= K.MIN_COMPLETENESS,
        level=K.WARNING,
        stamp=moment(as_of),
    )


def freshness(
    df: DataFrame, column: str, table: str, as_of: Moment = None, by: Sequence[str] = ()
) -> DataFrame:
    """Age of the newest row in hours; no time at all counts as very old and critical."""
    now = moment(as_of)
    newest = df.groupBy(*by).agg(F.max(F.col(column).cast("timestamp")).alias("newest"))
    age = (F.unix_micros(now) - F.unix_micros("newest")) / F.lit(3600 * 1_000_000)
    aged = newest.select(*by, age.alias("age"))
    value = F.coalesce("age", F.lit(K.MISSING_FRESHNESS_HOURS))
    return _metric_rows(
        aged,
        name=_named(table, by, "freshness"),
        value=value,
        threshold=K.MAX_FRESHNESS_HOURS,
        kind=K.DATA_QUALITY,
        healthy=value <= K.MAX_FRESHNESS_HOURS,
        level=F.when(F.col("age").isNull(), K.CRITICAL).otherwise(K.WARNING),
        stamp=now,
    )


def accuracy(
    predictions: DataFrame,
    actual: str,
    predicted: str,
    model: str | None = None,
    by: Sequence[str] = (),
    as_of: Moment = None,
) -> DataFrame:
    """One minus the mean relative error, and whether it moved from the baseline.

    The drift test has two sides: an accuracy well above the baseline is reported too.
    No rows, or rows without a partner value, give 0 and a critical alert.
    """
    relative = F.abs(F.col(actual) - F.col(predicted)) / F.greatest(
        F.abs(F.col(actual)), F.lit(MACHINE_EPSILON)
    )
    unpaired = F.count_if(F.col(actual).isNull() | F.col(predicted).isNull())
    measured = predictions.groupBy(*by).agg(
        F.when(unpaired == 0, 1 - F.avg(relative)).alias("accuracy")
    )
    drift = F.abs(F.col("accuracy") - K.BASELINE_ACCURACY)
    known = F.col("accuracy").isNotNull()
    return _metric_rows(
        measured,
        name=_named(model, by, "accuracy"),
        value=F.coalesce("accuracy", F.lit(0.0)),
        threshold=K.MIN_ACCURACY,
        kind=K.MODEL_PERFORMANCE,
        healthy=known & (drift <= K.MAX_ACCURACY_DRIFT),
        level=F.when(known, K.WARNING).otherwise(K.CRITICAL),
        stamp=moment(as_of),
    )


def prediction_volume(
    predictions: DataFrame, expected: DataFrame, model: str = "model", as_of: Moment = None
) -> DataFrame:
    """Predictions per model over the expected number; ``expected(model, expected_count)``.

    Both sides have one row per model when they are joined.
    """
    counts = predictions.groupBy(F.col(model).alias("model")).agg(F.count(F.lit(1)).alias("made"))
    compared = expected.join(counts, "model", "full_outer")
    ratio = F.when(
        F.col("expected_count") > 0,
        _ratio(F.coalesce("made", F.lit(0)), F.col("expected_count")),
    ).otherwise(0.0)
    return _metric_rows(
        compared.select("model", ratio.alias("value")),
        name=_named(None, ["model"], "prediction_volume"),
        value=F.col("value"),
        threshold=K.MIN_PREDICTION_VOLUME,
        kind=K.MODEL_PERFORMANCE,
        healthy=F.col("value") >= K.MIN_PREDICTION_VOLUME,
        level=K.WARNING,
        stamp=moment(as_of),
    )


def _finished(run_log: DataFrame) -> DataFrame:
    """Runs that ended, well or not; the log level says nothing about the outcome."""
    return run_log.filter(F.col("event_type") == K.PIPELINE_END)


def _runs(run_log: DataFrame) -> DataFrame:
    """Finished runs, good ones, seconds and last run of every pipeline."""
    return (
        _finished(run_log)
        .groupBy("pipeline_name")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.count_if(F.col("status") == K.SUCCESS).alias("good"),
            money.as_double(money.total(F.col("duration_seconds"))).alias("seconds"),
            F.count("duration_seconds").alias("timed"),
            F.max("timestamp").alias("last_run"),
        )
    )


_PIPELINE_CHECKS = {
    "success_rate": {"threshold": K.MIN_SUCCESS_RATE, "level": K.CRITICAL},
    "duration": {"threshold": K.MAX_DURATION_MINUTES, "level": K.WARNING},
}


def pipeline_health(run_log: DataFrame, as_of: Moment = None, checks: Sequence[str] = tuple(_PIPELINE_CHECKS)) -> DataFrame:
    """Share of finished runs that succeeded and mean minutes per run, from one pass over the log.

    Stamped ``as_of`` or with the last run.
    """
    rate = _ratio(F.col("good"), F.col("runs"))
    minutes = _ratio(F.col("seconds") / 60, F.col("timed"))
    measured = {
        "success_rate": (rate, rate >= K.MIN_SUCCESS_RATE),
        "duration": (minutes, minutes <= K.MAX_DURATION_MINUTES),
    }
    stamp = F.col("last_run") if as_of is None else moment(as_of)
    rows = F.array(
        *[
            F.struct(
                _named(None, ["pipeline_name"], check).alias("name"),
                measured[check][0].alias("value"),
                F.lit(float(_PIPELINE_CHECKS[check]["threshold"])).alias("threshold"),
                F.lit(K.PIPELINE_HEALTH).alias("metric_type"),
                stamp.alias("timestamp"),
                F.when(measured[check][1], K.HEALTHY).otherwise(K.UNHEALTHY).alias("status"),
                F.when(~measured[check][1], F.lit(_PIPELINE_CHECKS[check]["level"])).alias("alert_level"),
            )
            for check in checks
        ]
    )
    return _runs(run_log).select(F.inline(rows))


def success_rate(run_log: DataFrame, as_of: Moment = None) -> DataFrame:
    """Share of finished runs that succeeded."""
    return pipeline_health(run_log, as_of, ["success_rate"])


def duration(run_log: DataFrame, as_of: Moment = None) -> DataFrame:
    """Mean minutes per finished run."""
    return pipeline_health(run_log, as_of, ["duration"])


def feature_means(features: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(feature, mean)`` rows to keep as the baseline of ``feature_drift``; null for no values."""
    means = [F.try_divide(money.as_double(money.total(F.col(c))), F.count(c)) for c in names]
    pairs = [F.struct(F.lit(c).alias("feature"), m.alias("mean")) for c, m in zip(names, means)]
    return features.agg(F.array(*pairs).alias("pairs")).select(F.inline("pairs"))


def feature_drift(
    features: DataFrame, baseline: DataFrame, model: str | None = None, as_of: Moment = None
) -> DataFrame:
    """Shift of each feature's mean against ``baseline(feature, mean)``, relative to the baseline.

    One row per feature of the baseline; features without values, or a baseline without a mean,
    are a full shift and critical.
    """
    now = feature_means(features, features.columns).withColumnRenamed("mean", "mean_now")
    both = baseline.select("feature", "mean").join(now, "feature", "left")
    shift = F.abs(F.col("mean_now") - F.col("mean")) / F.greatest(F.abs("mean"), F.lit(MACHINE_EPSILON))
    value = F.coalesce(shift, F.lit(1.0))
    return _metric_rows(
        both,
        name=_named(model, ["feature"], "drift"),
        value=value,
        threshold=K.MAX_FEATURE_DRIFT,
        kind=K.MODEL_PERFORMANCE,
        healthy=shift.isNotNull() & (value <= K.MAX_FEATURE_DRIFT),
        level=F.when(shift.isNull(), K.CRITICAL).otherwise(K.WARNING),
        stamp=moment(as_of),
    )


def feature_sketches(features: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row: a quantile sketch of each feature (as double), to keep as the baseline of ``distribution_drift``."""
    return features.agg(*[quantile_sketch(features, c).alias(c) for c in names])


def distribution_drift(
    features: DataFrame, baseline: DataFrame, model: str | None = None, as_of: Moment = None
) -> DataFrame:
    """Kolmogorov-Smirnov distance of each feature from its baseline, from one sketch of each side in one pass.

    One row per feature of the baseline (``feature_sketches``); shifts of the mean, the spread and the tails all
    show.  A side without values is a full shift and critical.  The distance is off by twice ``sketches.rank_error()``
    and half a percent at most.
    """
    names = baseline.columns
    kinds = {c: "bigint" if isinstance(features.schema[c].dataType, IntegralType) else "double" for c in names}
    was = baseline.select(F.struct(*names).alias("was")).scalar()
    now = feature_sketches(features, names).withColumn("was", was)
    pairs = [F.struct(F.lit(c).alias("feature"), ks_distance(F.col("was")[c], F.col(c), kinds[c]).alias("distance")) for c in names]
    distance = F.col("distance")
    value = F.coalesce(distance, F.lit(1.0))
    return _metric_rows(
        now.select(F.inline(F.array(*pairs))),
        name=_named(model, ["feature"], "distribution_drift"),
        value=value,
        threshold=K.MAX_FEATURE_DRIFT,
        kind=K.MODEL_PERFORMANCE,
        healthy=distance.isNotNull() & (value <= K.MAX_FEATURE_DRIFT),
        level=F.when(distance.isNull(), K.CRITICAL).otherwise(K.WARNING),
        stamp=moment(as_of),
    )


def model_age(models: DataFrame, as_of: Moment = None) -> DataFrame:
    """Days since each model was trained, from ``models(model, trained_at)``; unknown is critical."""
    now = moment(as_of)
    days = (F.unix_micros(now) - F.unix_micros(F.col("trained_at").cast("timestamp"))) / F.lit(86_400_000_000.0)
    value = F.coalesce(days, F.lit(K.MISSING_FRESHNESS_HOURS))
    return _metric_rows(
        models,
        name=_named(None, ["model"], "age_days"),
        value=value,
        threshold=K.MAX_MODEL_AGE_DAYS,
        kind=K.MODEL_PERFORMANCE,
        healthy=days.isNotNull() & (value <= K.MAX_MODEL_AGE_DAYS),
        level=F.when(days.isNull(), K.CRITICAL).otherwise(K.WARNING),
        stamp=now,
    )


def alerts(metrics: DataFrame) -> DataFrame:
    """One open alert per metric row that carries a level.

    The id is name, second and a hash of the row, so two alerts of one second differ.
    """
    value, threshold = F.col("value"), F.col("threshold")
    instant = F.unix_micros("timestamp").cast("string")
    identity = F.md5(F.concat_ws("|", "name", "metric_type", "alert_level", instant))
    kind = F.translate(F.initcap(F.translate("metric_type", "_", " ")), " ", "_")
    return metrics.filter(F.col("alert_level").isNotNull()).select(
        F.concat_ws(
            "_", "name", F.unix_seconds("timestamp").cast("string"), F.substring(identity, 1, 8)
        ).alias("id"),
        F.concat(kind, F.lit(" Alert: "), "name").alias("title"),
        F.format_string(
            "Metric %s is %s, threshold: %s", "name", fixed(value, 3), fixed(threshold, 3)
        ).alias("description"),
        F.col("alert_level").alias("level"),
        F.col("name").alias("metric_name"),
        value.alias("current_value"),
        "threshold",
        "timestamp",
        F.lit(False).alias("resolved"),
    )


def alert_routes(alert_rows: DataFrame) -> DataFrame:
    """One row per alert and channel it goes to."""
    routes = F.create_map(
        *[
            part
            for level, channels in K.ALERT_CHANNELS.items()
            for part in (F.lit(level), F.array(*map(F.lit, channels)))
        ]
    )
    channels = F.coalesce(F.try_element_at(routes, F.col("level")), F.array(F.lit("log")))
    return alert_rows.select("id", "level", F.explode(channels).alias("channel"))


def resolve(alert_rows: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Mark the alerts whose ``id`` is in ``resolutions``."""
    done = resolutions.select("id").distinct().withColumn("_done", F.lit(True))
    return (
        alert_rows.join(done, "id", "left")
        .withColumn("resolved", F.col("resolved") | F.coalesce("_done", F.lit(False)))
        .drop("_done")
    )


def active_alerts(alert_rows: DataFrame, level: str | None = None) -> DataFrame:
    open_rows = alert_rows.filter(~F.col("resolved"))
    return open_rows if level is None else open_rows.filter(F.col("level") == level)


def metrics_summary(metrics: DataFrame, alert_rows: DataFrame, as_of: Moment = None) -> DataFrame:
    """Counts and overall health; only the last day's metrics decide the health."""
    since = moment(as_of) - F.expr(f"INTERVAL {K.RECENT_HOURS} HOURS")
    recent = F.col("timestamp") > since
    total = F.col("total_metrics")
    return (
        metrics.agg(
            F.count(F.lit(1)).alias("total_metrics"),
            F.count_if(recent).alias("recent_metrics"),
            F.bool_and(F.when(recent, F.col("status") == K.HEALTHY)).alias("_fine"),
        )
        .withColumn("active_alerts", active_alerts(alert_rows).agg(F.count(F.lit(1))).scalar())
        .select(
            "total_metrics",
            "recent_metrics",
            "active_alerts",
            F.when(total > 0, F.when(F.coalesce("_fine", F.lit(True)), K.HEALTHY).otherwise(K.UNHEALTHY)).alias(
                "health_status"
            ),
            F.when(total == 0, "No metrics collected yet").alias("message"),
        )
    )


def recent_metrics(metrics: DataFrame, n: int = K.RECENT_METRICS) -> DataFrame:
    return metrics.orderBy(F.desc("timestamp"), "name").limit(n)
