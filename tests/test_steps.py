"""Jobs and streams work a step out once and hand it over as a table."""

import os

import pytest
from conftest import SMALL, records
from pyspark.sql import functions as F

from tillwise.operators import customers, features, sales, silver
from tillwise.plans import catalog, jobs, modelling
from tillwise.sources.invoice_adapter import invoice_lines
from tillwise.sources.tables import GOLD, SILVER, Lakehouse
from tillwise.streaming import pipelines


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.fixture
def read_by(monkeypatch):
    """The tables that each written table was read from."""
    found, write = {}, Lakehouse.write

    def noted(lake, df, layer, name, *args, **options):
        found[name] = {file.split("/")[-2] for file in df.inputFiles()}
        return write(lake, df, layer, name, *args, **options)

    monkeypatch.setattr(Lakehouse, "write", noted)
    return found


def test_redelivered_lines_are_cleaned_by_a_stream_without_state(spark, monkeypatch):
    runs, run = [], pipelines.run_available

    def noted(stream, *args, **options):
        runs.append(run(stream, *args, **options))
        return runs[-1]

    monkeypatch.setattr(pipelines, "run_available", noted)
    cleaned = catalog.QUERIES["stream_redelivery"](spark, SMALL)
    known, clean = ([len(batch["stateOperators"]) for batch in progress] for progress in runs)
    assert set(known) == {1} and len(known) >= 4
    assert set(clean) == {0} and len(clean) == 1
    assert rows(cleaned) == rows(catalog.zoneless(silver.silver_detailed(invoice_lines(spark, SMALL))))


def shuffle_files(spark):
    """Names of the shuffle files on disk."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {name for name in names if name.startswith("shuffle_")}


def test_redelivered_lines_leave_no_files_that_nothing_reads(spark, monkeypatch):
    folders, found, run = [], [], pipelines.run_available

    def noted(stream, path, *args, **options):
        folders.append(os.path.dirname(path.removeprefix("file:")))
        lines, shuffled = f"{folders[0]}/lines", shuffle_files(spark)
        found.append(sorted(os.listdir(folders[0])))
        arrived = len(os.listdir(lines)) if os.path.exists(lines) else 0
        progress = run(stream, path, *args, **options)
        assert shuffle_files(spark) - shuffled == set()
        assert arrived == 0 or len(os.listdir(lines)) < arrived
        return progress

    monkeypatch.setattr(pipelines, "run_available", noted)
    cleaned = catalog.QUERIES["stream_redelivery"](spark, SMALL)
    assert found == [["lines"], ["known"]]
    assert rows(cleaned) == rows(catalog.zoneless(silver.silver_detailed(invoice_lines(spark, SMALL))))


def test_state_of_redelivered_lines_is_not_kept_in_memory(spark, monkeypatch):
    runs, run = [], pipelines.run_available
    before = {key: spark.conf.get(key, None) for key in (*pipelines.FRUGAL, pipelines.PARTITIONS_SETTING)}
    monkeypatch.setattr(pipelines, "STATE_BYTES", 4096)
    monkeypatch.setattr(pipelines, "run_available", lambda *args, **options: runs.append(run(*args, **options)) or runs[-1])
    catalog.QUERIES["stream_redelivery"](spark, SMALL)
    states = [state for batch in runs[0] for state in batch["stateOperators"]]
    # Partitions follow the size of the deliveries, and each batch reads their state again.
    partitions = {state["numShufflePartitions"] for state in states}
    assert len(partitions) == 1 and min(partitions) > int(before[pipelines.PARTITIONS_SETTING])
    assert {state["customMetrics"]["loadedMapCacheMissCount"] for state in states[1:]} == partitions
    assert before == {key: spark.conf.get(key, None) for key in before}


def test_settings_come_back_after_a_failure(spark):
    key = pipelines.PARTITIONS_SETTING
    before = spark.conf.get(key)
    with pytest.raises(ValueError), pipelines.with_settings(spark, {key: "3"}):
        assert spark.conf.get(key) == "3"
        raise ValueError
    assert spark.conf.get(key) == before


def test_inference_reads_stored_customer_features(spark, tmp_path, read_by):
    lake = Lakehouse(str(tmp_path / "lake"))
    lines = silver.silver_detailed(invoice_lines(spark, SMALL))
    lake.write(lines, SILVER, jobs.CLEANED)
    for result in (
        modelling.train(spark, lake, str(tmp_path / "models"), k=3),
        modelling.infer(spark, lake, str(tmp_path / "models"), days=3),
    ):
        assert result.status == "success", result.details
    assert read_by["customer_segments"] == {"inference_customers"}
    assert rows(lake.read(spark, GOLD, "inference_customers")) == rows(features.customer_features(lines))


def test_a_batch_is_worked_out_once_and_not_kept(spark, tmp_path, monkeypatch):
    evaluated = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(country):
        evaluated.add(1)
        return country

    lines = silver.silver_detailed(invoice_lines(spark, SMALL))
    lines = spark.createDataFrame(lines.collect(), lines.schema)
    batch = lines.withColumn("Country", counted("Country"))

    def kept(*_):
        raise AssertionError("a copy of the batch is kept")

    monkeypatch.setattr(type(batch), "persist", kept)
    work = pipelines.refresh_daily_sales(str(tmp_path / "silver"), str(tmp_path / "daily"))
    work(batch.limit(0), 0)
    work(batch, 1)
    assert evaluated.value == lines.count()
    assert rows(spark.read.parquet(str(tmp_path / "daily"))) == rows(sales.daily_sales(lines))


def test_simple_job_sums_the_lines_once(spark, tmp_path, read_by):
    folder = str(tmp_path)
    lake = Lakehouse(f"{folder}/lake")
    jobs.run_simple(spark, catalog._as_csv(spark, SMALL, folder), lake)
    for name in ("simple_daily_sales", "simple_rfm_table"):
        assert read_by[name] == {"simple_rollup"}
    lines = lake.read(spark, SILVER, "simple_online_retail_cleaned")
    assert rows(lake.read(spark, GOLD, "simple_country_sales")) == rows(sales.country_sales_simple(lines))


def test_simple_tables_from_a_rollup_are_those_from_lines(spark, simple_lines):
    """With lines without a country, a customer, a time, a number of units or an invoice."""
    lines = simple_lines
    for name, value in (("Country", "KENYA"), ("CustomerID", "c5"), ("InvoiceNo", "m-3")):
        holes = simple_lines.withColumn(name, F.when(F.col(name) != value, F.col(name)))
        lines = lines.unionByName(holes.withColumn("Quantity", F.col("Quantity") * 3))
    lines = lines.unionByName(simple_lines.withColumn("InvoiceDate", F.lit(None).cast("timestamp")))
    lines = lines.unionByName(simple_lines.withColumn("Quantity", F.lit(None).cast("int")).withColumn("CustomerID", F.lit("c9")))
    rollup = sales.rollup_simple(lines)
    assert rollup.count() < lines.count()
    for table in (sales.daily_sales_simple, customers.rfm_simple):
        assert table(rollup).schema == table(lines).schema
        assert records(table(rollup).orderBy(F.col(table(rollup).columns[0]))) == records(table(lines).orderBy(F.col(table(lines).columns[0])))
    assert records(sales.country_sales_simple(lines, rollup)) == records(sales.country_sales_simple(lines))
    assert lines.filter("Country is null").count() > 0


def test_times_are_written_once_for_each_order(spark):
    plan = invoice_lines(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(plan) if "Join" in line and "l_orderkey" in line)
    assert [i > join for i, line in enumerate(plan) if "date_format" in line] == [True]
