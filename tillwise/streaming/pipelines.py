"""Invoice lines and events as streams: ingestion, cleaning, windows, alerts, refresh.

The same cleaning functions serve tables and streams.  Streams are written by Spark's
file sink or by batches that replace their own folder, so a batch that is repeated
after a failure leaves no duplicates.
"""

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise import constants as K
from tillwise.functions import money
from tillwise.operators import monitor, sales, silver
from tillwise.schemas import CORRUPT_COLUMN, RAW_LINES
from tillwise.sources.tables import folder_bytes, partitions_with, remove, table_exists, versions

DAY = "1 day"
WATERMARK = "1 hour"
MONTH_KEYS = ("Year", "Month")
DAY_KEYS = (*MONTH_KEYS, "Day")
# What is kept of the values of earlier windows.
MOMENTS = ("origin", "n", "s1", "s2")
HISTORY = "origin double, n bigint, s1 double, s2 double"
# Settings for streams with much state and large batches.  A batch's shuffle files go when it ends, not when the driver
# happens to collect its garbage; a partition's state is held in memory only while its task runs; state and tables take
# less room.  None of them changes a row.
FRUGAL = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.parquet.compression.codec": "zstd",
}
PARTITIONS_SETTING = "spark.sql.shuffle.partitions"
# Bytes of a stream's files for each of its state's partitions, which a task holds in memory whole.
STATE_BYTES = 16 << 20
# The folder name Spark gives to a partition without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _with_arrival(stream: DataFrame, arrival: str | None) -> DataFrame:
    return stream.withColumn(arrival, F.col("_metadata.file_modification_time")) if arrival else stream


def csv_stream(
    spark: SparkSession,
    path: str,
    schema: str = RAW_LINES,
    files_per_batch: int | None = None,
    arrival: str | None = None,
) -> DataFrame:
    """CSV files as they arrive; unreadable lines are kept in ``_corrupt_record``.

    ``arrival`` names a column for the time at which the line's file arrived.
    """
    reader = (
        spark.readStream.schema(f"{schema}, {CORRUPT_COLUMN} string")
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("escape", '"')
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _with_arrival(reader.csv(path).withColumn("source_file", F.col("_metadata.file_path")), arrival)


def table_stream(
    spark: SparkSession,
    path: str,
    files_per_batch: int | None = None,
    format: str = "parquet",
    arrival: str | None = None,
    remove_read: bool = False,
) -> DataFrame:
    """Table files as they arrive, with the schema of the files already there; ``arrival`` as in ``csv_stream``.

    With ``remove_read`` the stream deletes each file when a later batch starts, for folders that only it reads.
    """
    reader = spark.readStream.format(format).schema(spark.read.format(format).load(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if remove_read:
        reader = reader.option("cleanSource", "delete")
    return _with_arrival(reader.load(path), arrival)


def kafka_stream(spark: SparkSession, servers: str, topic: str, schema: str = RAW_LINES) -> DataFrame:
    """JSON messages from Kafka; needs Spark's Kafka connector on the classpath."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
        .select(F.from_json(F.col("value").cast("string"), schema).alias("line"))
        .select("line.*")
    )


@contextmanager
def with_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for a while; what they were before comes back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def frugal(spark: SparkSession, path: str) -> dict[str, str]:
    """``FRUGAL`` with partitions enough for the state of a stream of the files in a folder."""
    wanted = -(-folder_bytes(spark, path) // STATE_BYTES)
    return FRUGAL | {PARTITIONS_SETTING: str(max(int(spark.conf.get(PARTITIONS_SETTING)), wanted))}


def run_available(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    partition_by: Sequence[str] = (),
    format: str = "parquet",
    settings: Mapping[str, str] | None = None,
) -> list:
    """Process what has arrived, append it to a table, and stop; returns the progress of the latest batches.

    ``settings`` are settings of the session while the stream runs.
    """
    writer = (
        stream.writeStream.format(format)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with with_settings(stream.sparkSession, settings or {}):
        running = writer.start()
        running.awaitTermination()
    return running.recentProgress


def run_batches(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> list:
    """Process what has arrived batch by batch and stop; returns the progress of the latest batches."""
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    running = writer.start()
    running.awaitTermination()
    return running.recentProgress


def once(stream: DataFrame, identity: Sequence[str], arrival: str, within: str = DAY) -> DataFrame:
    """Drop lines that an at-least-once source delivers again, in the same batch or a later one.

    Lines are the same if all ``identity`` columns agree, null being a value like others.  The state holds the
    identities only, dealt by them over all tasks, and forgets each one ``within`` after it arrived; a line repeated
    later than that is new.  ``arrival`` is the time of arrival, not of the sale: it moves on with every delivery, so
    the state's size follows the lines of one such span, however old the sales are.
    """
    return stream.withWatermark(arrival, within).dropDuplicatesWithinWatermark(list(identity))


def readable() -> Column:
    """The line could be parsed and names an invoice, an article and a time."""
    named = [F.col(c).isNotNull() for c in ("InvoiceNo", "StockCode", "InvoiceDate")]
    whole = F.col(CORRUPT_COLUMN).isNull()
    return whole & named[0] & named[1] & named[2]


def validated(stream: DataFrame) -> DataFrame:
    """Mark each line ``valid`` or ``quarantine``; written partitioned by ``check``."""
    return stream.withColumn("check", F.when(readable(), "valid").otherwise("quarantine"))


def cleaned(stream: DataFrame) -> DataFrame:
    return silver.silver_detailed(stream)


def window_totals(
    stream: DataFrame,
    time: str,
    amount: str,
    keys: Sequence[str] = (),
    *,
    window: str = DAY,
    slide: str | None = None,
    watermark: str = WATERMARK,
    distinct: str | None = None,
) -> DataFrame:
    """Count, sum, mean, deviation and extremes per time window and key.

    Windows are emitted when the watermark passes their end.  ``distinct`` adds an
    approximate distinct count, the only kind a stream can keep in bounded state.
    """
    value = F.col(amount)
    extra = [] if distinct is None else [F.approx_count_distinct(distinct).alias(f"distinct_{distinct}")]
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark)
    return (
        timed.groupBy(F.window(time, window, slide), *keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            money.total(value).alias("_total"),
            F.stddev_samp(value).alias("deviation"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
            *extra,
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *keys,
            "n",
            money.as_double(F.col("_total")).alias("total"),
            F.try_divide(money.as_double(F.col("_total")), F.col("n")).alias("mean"),
            "deviation",
            "low",
            "high",
            *[f"distinct_{distinct}" for _ in extra],
        )
    )


def window_anomalies(windows: DataFrame, subject: str, keys: Sequence[str] = ()) -> DataFrame:
    """Metric rows of closed windows; unhealthy when the peak leaves mean + 3 sigma."""
    limit = F.col("mean") + K.OUTLIER_SIGMAS * F.col("deviation")
    calm = F.coalesce(F.col("high") <= limit, F.lit(True))
    return windows.select(
        F.concat_ws("_", F.lit(subject), *[F.col(k).cast("string") for k in keys], F.lit("peak")).alias("name"),
        F.col("high").alias("value"),
        F.coalesce(limit, F.col("high")).alias("threshold"),
        F.lit(K.DATA_QUALITY).alias("metric_type"),
        F.col("window_start").alias("timestamp"),
        F.when(calm, K.HEALTHY).otherwise(K.UNHEALTHY).alias("status"),
        F.when(~calm, K.WARNING).alias("alert_level"),
    )


def judged_by_past(windows: DataFrame, history: DataFrame, keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Windows with the mean and deviation of all values in earlier windows of their key, and the history after them.

    ``history`` has one row per key: the columns ``keys``, ``origin``, ``n``, ``s1`` and ``s2``: the number of values,
    the sum of their differences from ``origin`` and of the squares of these.  Each window adds what its count, mean and
    deviation say, so moments merge exactly and no value is kept.  The origin is the key's first mean, which keeps
    the differences small beside large values.
    """
    past = history.select(*[F.col(k).alias(f"past_{k}") for k in keys], *[F.col(c).alias(f"past_{c}") for c in MOMENTS])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"past_{k}"))
    by_key = Window.partitionBy(*[F.col(k) for k in keys]).orderBy("window_start")
    known = windows.join(past, same, "left").drop(*[f"past_{k}" for k in keys])
    shift = F.col("mean") - F.col("origin")
    squares = F.coalesce(F.col("deviation") * F.col("deviation"), F.lit(0.0)) * (F.col("n") - 1)
    parts = known.withColumn("origin", F.coalesce("past_origin", F.first("mean", ignorenulls=True).over(by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(0.0)))
    parts = parts.withColumns({"own_s1": F.coalesce(F.col("n") * shift, F.lit(0.0)), "own_s2": F.coalesce(squares + F.col("n") * shift * shift, F.lit(0.0))})

    def before(part: str, own: str) -> Column:
        earlier = F.sum(own).over(by_key.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(F.col(f"past_{part}"), F.lit(0)) + F.coalesce(earlier, F.lit(0))

    seen = parts.withColumns({"seen_n": before("n", "n"), "seen_s1": before("s1", "own_s1"), "seen_s2": before("s2", "own_s2")})
    n = F.col("seen_n")
    variance = F.try_divide(F.col("seen_s2") - F.try_divide(F.col("seen_s1") * F.col("seen_s1"), n), F.when(n > 1, n - 1))
    judged = seen.select(
        *windows.columns,
        n.cast("bigint").alias("past_n"),
        (F.col("origin") + F.try_divide("seen_s1", n)).alias("past_mean"),
        F.when(n > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("past_deviation"),
    )
    kept = [F.col(f"past_{k}").alias(k) for k in keys]
    added = parts.select(*keys, "origin", F.col("n").cast("bigint").alias("n"), F.col("own_s1").alias("s1"), F.col("own_s2").alias("s2"))
    merged = past.select(*kept, *[F.col(f"past_{c}").alias(c) for c in MOMENTS]).unionByName(added)
    after = merged.groupBy(*keys).agg(F.first("origin").alias("origin"), *[F.sum(c).alias(c) for c in ("n", "s1", "s2")])
    return judged, after


def past_anomalies(judged: DataFrame, subject: str, keys: Sequence[str] = ()) -> DataFrame:
    """Metric rows of judged windows; unhealthy when the peak leaves the past's mean + 3 sigma.

    A window without a past of two values has nothing to be judged by and is healthy.
    """
    limit = F.col("past_mean") + K.OUTLIER_SIGMAS * F.col("past_deviation")
    calm = F.coalesce(F.col("high") <= limit, F.lit(True))
    return judged.select(
        F.concat_ws("_", F.lit(subject), *[F.col(k).cast("string") for k in keys], F.lit("past_peak")).alias("name"),
        F.col("high").alias("value"),
        F.coalesce(limit, F.col("high")).alias("threshold"),
        F.lit(K.DATA_QUALITY).alias("metric_type"),
        F.col("window_start").alias("timestamp"),
        F.when(calm, K.HEALTHY).otherwise(K.UNHEALTHY).alias("status"),
        F.when(~calm, K.WARNING).alias("alert_level"),
    )


def judge_by_past(path: str, keys: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """Work for ``run_batches`` on closed windows: judge each by what earlier batches and windows left.

    ``path`` holds the judged windows (``judged``) and the history after each batch (``history``), a folder for
    each batch.  A repeated batch starts from the history before it and replaces its own folders; histories that no
    repeat needs any more are removed, so one row per key and the last two batches are all that is kept.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [v for v in versions(spark, f"{path}/history") if v < batch_id]
        kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.select(*keys).schema), HISTORY])
        history = spark.read.schema(kinds).parquet(f"{path}/history/batch_id={max(earlier)}") if earlier else spark.createDataFrame([], kinds)
        batch = batch.persist()
        try:
            judged, after = judged_by_past(batch, history, keys)
            judged.write.mode("overwrite").parquet(f"{path}/judged/batch_id={batch_id}")
            after.write.mode("overwrite").parquet(f"{path}/history/batch_id={batch_id}")
        finally:
            batch.unpersist()
        remove(spark, [f"{path}/history/batch_id={v}" for v in sorted(earlier)[:-1]])

    return work


def window_alerts(windows: DataFrame, subject: str, keys: Sequence[str] = ()) -> DataFrame:
    return monitor.alerts(window_anomalies(windows, subject, keys))


def quality_per_batch(table: str, path: str) -> Callable[[DataFrame, int], None]:
    """Completeness of every batch as a metric row in the batch's own folder."""

    def work(batch: DataFrame, batch_id: int) -> None:
        checked = monitor.completeness(batch, table)
        checked.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return work


def refresh_daily_sales(silver_path: str, daily_path: str) -> Callable[[DataFrame, int], None]:
    """Keep a daily sales table current: add the batch, then rewrite the months it touches.

    Both tables are partitioned by month; inside a month every batch has its own partition, which
    a repeated batch replaces.  Only the folders of the touched months are listed and read, however
    many batches there were, and only their partitions of the daily table are replaced.
    Which months these are the written folders tell, so a batch is worked out once and no copy of it is kept.
    Lines without a readable time are a month and a day of their own, as in the batch table.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        (
            batch.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*MONTH_KEYS, "batch_id")
            .parquet(silver_path)
        )
        folders = partitions_with(spark, silver_path, MONTH_KEYS, f"batch_id={batch_id}")
        if not folders:
            return
        keys = ", ".join(f"{c} int" for c in (*MONTH_KEYS, "batch_id"))
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.drop(*MONTH_KEYS).schema), keys])
        lines = spark.read.schema(schema).option("basePath", silver_path).parquet(*folders)
        (
            sales.daily_sales(lines)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*MONTH_KEYS)
            .parquet(daily_path)
        )

    return work


def _same_day(rows: DataFrame, other: DataFrame, keys: Sequence[str] = DAY_KEYS) -> Column:
    """Rows and other rows agree in the keys; days without a date are one day."""
    both = [rows[k].eqNullSafe(other[k]) for k in keys]
    return reduce(Column.__and__, both)


def _read_folders(spark: SparkSession, root: str, folders: Sequence[str], schema: str) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*folders)


def refresh_daily_rollup(path: str, daily_path: str) -> Callable[[DataFrame, int], None]:
    """Keep a daily sales table current without reading earlier lines again.

    What is kept of a day are its invoices (``sales.invoice_rollup``): exact sums, counts and extremes, which merge,
    and the invoices and customers that distinct counts need.  A batch is rolled up, merged with what is kept of the
    days it touches, and stored as their version of this batch; ``index``, one row per calendar day, tells which
    version holds each day.  So a batch reads the lines it brings and the invoices of the days it touches, however
    long the months and the history are.  Of the daily table the touched months, at most 31 rows each, are replaced.

    A repeated batch starts from the index before it and replaces its own version.  Versions that neither the index
    of this batch nor the one before names are removed.
    """
    days_path, index_path = f"{path}/days", f"{path}/index"
    index_kind = ", ".join([*(f"{c} int" for c in DAY_KEYS), "version bigint"])

    def month_folder(row) -> str:
        return "/".join([days_path, *(f"{c}={NO_VALUE if row[c] is None else row[c]}" for c in MONTH_KEYS)])

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [v for v in versions(spark, index_path) if v < batch_id]
        added = sales.invoice_rollup(batch).persist()
        touched = added.select(*DAY_KEYS).distinct().persist()
        kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in added.drop(*MONTH_KEYS).schema]
        kind = ", ".join([*kept, *(f"{c} int" for c in MONTH_KEYS), "batch_id bigint"])
        try:
            if touched.isEmpty():
                return
            index = _read_folders(spark, index_path, [f"{index_path}/batch_id={v}" for v in earlier[-1:]], index_kind).select(*DAY_KEYS, "version")
            known = index.join(touched, _same_day(index, touched), "left_semi")
            # One row per touched month and version in it.
            places = known.select(*MONTH_KEYS, "version").distinct().collect()
            stored = _read_folders(spark, days_path, [f"{month_folder(r)}/batch_id={r['version']}" for r in places], kind)
            wanted = known.select(*[F.col(c).alias(f"wanted_{c}") for c in (*DAY_KEYS, "version")])
            same = reduce(Column.__and__, [stored[c].eqNullSafe(wanted[f"wanted_{c}"]) for c in DAY_KEYS])
            before = stored.join(wanted, same & (stored["batch_id"] == wanted["wanted_version"]), "left_semi").select(*added.columns)
            (
                sales.invoice_rollup(added.unionByName(before))
                .withColumn("batch_id", F.lit(batch_id))
                .hint("rebalance", *MONTH_KEYS)
                .sortWithinPartitions(*DAY_KEYS)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*MONTH_KEYS, "batch_id")
                .parquet(days_path)
            )
            rest = index.join(touched, _same_day(index, touched), "left_anti")
            rest.unionByName(touched.withColumn("version", F.lit(batch_id).cast("bigint"))).coalesce(1).write.mode("overwrite").parquet(
                f"{index_path}/batch_id={batch_id}"
            )
            months = touched.select(*MONTH_KEYS).distinct().collect()
            fresh = sales.daily_sales(_read_folders(spark, days_path, [f"{month_folder(r)}/batch_id={batch_id}" for r in months], kind).drop("batch_id"))
            if table_exists(spark, daily_path):
                found = [r for r in months if table_exists(spark, month_folder(r).replace(days_path, daily_path))]
                types = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh.drop(*MONTH_KEYS).schema), *(f"{c} int" for c in MONTH_KEYS)])
                old = _read_folders(spark, daily_path, [month_folder(r).replace(days_path, daily_path) for r in found], types)
                fresh = fresh.unionByName(old.join(touched, _same_day(old, touched), "left_anti"))
            (
                fresh.hint("rebalance", *MONTH_KEYS)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*MONTH_KEYS)
                .parquet(daily_path)
            )
            named = _read_folders(spark, index_path, [f"{index_path}/batch_id={v}" for v in (*earlier[-1:], batch_id)], index_kind)
            used = {(month_folder(r), r["version"]) for r in named.select(*MONTH_KEYS, "version").distinct().collect()}
            folders = [month_folder(r) for r in months]
            remove(spark, [f"{m}/batch_id={v}" for m in folders for v in versions(spark, m) if v <= batch_id and (m, v) not in used])
            remove(spark, [f"{index_path}/batch_id={v}" for v in earlier[:-1]])
        finally:
            touched.unpersist()
            added.unpersist()

    return work
