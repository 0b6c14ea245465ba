import math
import os
import random
import shutil
from pathlib import Path

import pytest
from conftest import SMALL, keyed, records
from pyspark.sql import functions as F

from tillwise import schemas
from tillwise.operators import sales, silver
from tillwise.sources.invoice_adapter import invoice_lines
from tillwise.streaming import pipelines


@pytest.fixture(scope="module")
def csv(spark, tmp_path_factory):
    """Lines in four files that arrive in four batches."""
    path = str(tmp_path_factory.mktemp("arriving") / "csv")
    (
        invoice_lines(spark, SMALL)
        .repartition(4, "StockCode")
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_streamed_cleaning_equals_the_batch(spark, csv, tmp_path):
    arriving = pipelines.csv_stream(spark, csv, files_per_batch=1).select(*spark.createDataFrame([], schemas.RAW_LINES).columns)
    pipelines.run_available(pipelines.cleaned(arriving), str(tmp_path / "t"), str(tmp_path / "s"))
    batch = silver.silver_detailed(invoice_lines(spark, SMALL))
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == rows(batch)


def test_rerun_without_new_files_adds_nothing(spark, csv, tmp_path):
    for _ in range(2):
        pipelines.run_available(pipelines.csv_stream(spark, csv), str(tmp_path / "t"), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == invoice_lines(spark, SMALL).count()


def test_unreadable_lines_go_to_quarantine(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        "1,A,LAMP,2,12/1/2010 8:26,1.5,7,UK\n"
        "2,B,LAMP,two,12/1/2010 8:26,1.5,7,UK\n"
        ",C,LAMP,2,12/1/2010 8:26,1.5,7,UK\n"
    )
    checked = pipelines.validated(pipelines.csv_stream(spark, str(tmp_path / "in")))
    pipelines.run_available(checked, str(tmp_path / "t"), str(tmp_path / "s"), partition_by=["check"])
    found = keyed(spark.read.parquet(str(tmp_path / "t")), "StockCode")
    assert {k: r["check"] for k, r in found.items()} == {"A": "valid", "B": "quarantine", "C": "quarantine"}
    assert found["B"]["_corrupt_record"].startswith("2,B,LAMP,two")


def test_closed_windows_equal_the_batch(spark, tmp_path):
    stream = pipelines.table_stream(spark, f"{SMALL}/events.parquet*")
    totals = pipelines.window_totals(stream, "ts", "value", ["event_type"], distinct="user_id")
    pipelines.run_available(totals, str(tmp_path / "t"), str(tmp_path / "s"))
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    last = events.agg(F.max("ts").cast("timestamp")).first()[0]
    batch = (
        events.groupBy(F.window(F.col("ts").cast("timestamp"), "1 day").alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
        .filter(F.col("w.end") <= F.lit(last) - F.expr("interval 1 hour"))
        .selectExpr("w.start as window_start", "event_type", "n", "total")
    )
    found = spark.read.parquet(str(tmp_path / "t"))
    assert found.count() > 100
    assert rows(found.select("window_start", "event_type", "n", F.round("total", 4).alias("total"))) == rows(batch)
    assert found.filter("distinct_user_id < 1 or distinct_user_id > n").count() == 0


def test_window_alerts_name_the_peaks(spark):
    windows = spark.createDataFrame(
        [("2024-01-01 00:00:00", "a", 10.0, 1.0, 99.0), ("2024-01-01 00:00:00", "b", 10.0, 1.0, 12.0), ("2024-01-02 00:00:00", "a", 7.0, None, 7.0)],
        "s string, k string, mean double, deviation double, high double",
    ).withColumn("window_start", F.to_timestamp("s"))
    metrics = keyed(pipelines.window_anomalies(windows, "till", ["k"]), "name", "timestamp")
    assert len(metrics) == 3
    raised = records(pipelines.window_alerts(windows, "till", ["k"]))
    assert [(r["metric_name"], r["current_value"], r["threshold"]) for r in raised] == [("till_a_peak", 99.0, 13.0)]


def test_quality_of_every_batch(spark, csv, tmp_path):
    stream = pipelines.csv_stream(spark, csv, files_per_batch=1).drop(schemas.CORRUPT_COLUMN, "source_file")
    work = pipelines.quality_per_batch("lines", str(tmp_path / "m"))
    pipelines.run_batches(stream, work, str(tmp_path / "s"))
    found = spark.read.parquet(str(tmp_path / "m"))
    assert found.count() == 4
    assert found.filter("value > 0.95 and value < 1 and status = 'healthy'").count() == 4


def test_daily_sales_follow_the_stream(spark, csv, tmp_path):
    stream = pipelines.cleaned(
        pipelines.csv_stream(spark, csv, files_per_batch=2).drop(schemas.CORRUPT_COLUMN, "source_file")
    )
    work = pipelines.refresh_daily_sales(str(tmp_path / "silver"), str(tmp_path / "daily"))
    pipelines.run_batches(stream, work, str(tmp_path / "s"))
    expected = sales.daily_sales(silver.silver_detailed(invoice_lines(spark, SMALL)))
    assert rows(spark.read.parquet(str(tmp_path / "daily"))) == rows(expected)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    undated = "case when StockCode like '%7' then 'some day' else InvoiceDate end"
    lines = silver.silver_detailed(invoice_lines(spark, SMALL).withColumn("InvoiceDate", F.expr(undated)))
    work = pipelines.refresh_daily_sales(str(tmp_path / "silver"), str(tmp_path / "daily"))
    assert lines.filter("Year is null").count() > 10
    parts = [lines.filter("Year < 1998 or Year is null and Quantity < 9"), lines.filter("Year >= 1998 or Year is null and Quantity >= 9")]
    for batch, part in ((0, parts[0]), (1, parts[1]), (1, parts[1]), (2, lines.limit(0))):
        work(part, batch)
    assert rows(spark.read.parquet(str(tmp_path / "daily"))) == rows(sales.daily_sales(lines))


LINE = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]


def deliver(source, folder, name, day):
    """Copy a file as one that arrived on the given day."""
    folder.mkdir(exist_ok=True)
    shutil.copy(source, folder / name)
    os.utime(folder / name, (day * 86_400, day * 86_400))


def test_files_delivered_twice_count_once(spark, csv, tmp_path):
    """All at once, and file by file, with nulls in the identity."""
    files = sorted(Path(csv).glob("part-*.csv"))
    for turn in range(2):
        for i, file in enumerate(files):
            deliver(file, tmp_path / "in", f"{turn}-{i}.csv", 19_000)
    batch = invoice_lines(spark, SMALL).distinct()
    for files_per_batch in (None, 1):
        stream = pipelines.csv_stream(spark, str(tmp_path / "in"), files_per_batch=files_per_batch, arrival="arrival")
        known = pipelines.once(stream, LINE, "arrival").select(LINE)
        out = tmp_path / f"t{files_per_batch}"
        pipelines.run_available(known, str(out), str(tmp_path / f"s{files_per_batch}"))
        assert rows(spark.read.parquet(str(out))) == rows(batch)
    assert batch.filter("CustomerID is null").count() > 100


def test_state_of_known_lines_stays_bounded(spark, csv, tmp_path):
    """A file a day: only the identities of the last days are kept; a copy within the span is dropped, a later one is new."""
    files = sorted(Path(csv).glob("part-*.csv"))
    n = {f: spark.read.csv(str(f), header=True).distinct().count() for f in files}
    order = [files[i] for i in (0, 1, 2, 2, 3, 0, 1, 2, 3, 0, 1)]
    for day, file in enumerate(order):
        deliver(file, tmp_path / "in", f"{day:02}.csv", 19_000 + 2 * day - (day == 3))
    stream = pipelines.csv_stream(spark, str(tmp_path / "in"), files_per_batch=1, arrival="arrival")
    known = pipelines.once(stream, LINE, "arrival", within="36 hours").select(LINE)
    progress = pipelines.run_available(known, str(tmp_path / "t"), str(tmp_path / "s"))
    lines = sum(n[f] for f in order)
    assert spark.read.parquet(str(tmp_path / "t")).count() == lines - n[files[2]]
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    # The last file, and two more until the watermark has passed them.
    assert max(kept) <= 3 * max(n.values()) < lines / 2 and len(kept) >= len(order)


def moments_by_hand(values):
    mean = sum(values) / len(values)
    return mean, math.sqrt(sum((v - mean) ** 2 for v in values) / (len(values) - 1)) if len(values) > 1 else None


@pytest.mark.parametrize("cuts", [(), (3,), (1, 2, 5, 8)])
def test_windows_are_judged_by_their_past(spark, tmp_path, cuts):
    """However the windows come in batches; large values, null keys, a key that starts late, a batch that is repeated."""
    rng = random.Random(len(cuts))
    values = {}
    for key, first in (("a", 0), ("b", 4), (None, 0)):
        for day in range(first, 10):
            level = 1e6 if key == "a" else 10.0
            values[key, day] = [level + rng.gauss(0, 1) for _ in range(rng.choice([1, 2, 6]))] + ([level + 60] if (key, day) == ("a", 7) else [])
    table = []
    for (key, day), own in values.items():
        mean, deviation = moments_by_hand(own)
        table.append((key, day, len(own), mean, deviation, max(own)))
    windows = spark.createDataFrame(table, "k string, day int, n bigint, mean double, deviation double, high double")
    windows = windows.selectExpr("timestamp_seconds(day * 86400) as window_start", "k", "n", "mean", "deviation", "high", "day")
    work = pipelines.judge_by_past(str(tmp_path / "past"), ["k"])
    edges = [0, *cuts, 10]
    for batch, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
        for _ in range(2):
            work(windows.filter(f"day >= {low} and day < {high}").drop("day"), batch)
    work(windows.limit(0).drop("day"), len(edges))
    judged = spark.read.parquet(str(tmp_path / "past" / "judged")).withColumn("day", F.expr("unix_seconds(window_start) div 86400"))
    found = keyed(judged, "k", "day")
    assert len(found) == len(values)
    for (key, day), row in found.items():
        past = [v for d in range(day) for v in values.get((key, d), [])]
        assert row["past_n"] == len(past)
        if past:
            mean, deviation = moments_by_hand(past)
            assert row["past_mean"] == pytest.approx(mean, rel=1e-12)
            assert row["past_deviation"] == (None if deviation is None else pytest.approx(deviation, rel=1e-6))
    raised = records(pipelines.past_anomalies(judged, "till", ["k"]).filter("status = 'unhealthy'"))
    assert ("till_a_past_peak", values["a", 7][-1]) in {(r["name"], r["value"]) for r in raised}
    kept = [p for p in (tmp_path / "past" / "history").iterdir() if p.is_dir()]
    assert len(kept) <= 2


def test_daily_rollup_follows_the_stream(spark, tmp_path):
    """Batches share days, one is repeated after a later batch was lost, one brings nothing, some lines have no date."""
    undated = "case when StockCode like '%7' then 'some day' else InvoiceDate end"
    lines = silver.silver_detailed(invoice_lines(spark, SMALL).withColumn("InvoiceDate", F.expr(undated))).filter("Year is null or Month < 4")
    work = pipelines.refresh_daily_rollup(str(tmp_path / "kept"), str(tmp_path / "daily"))
    part = F.pmod(F.xxhash64("InvoiceNo"), F.lit(3))
    for batch, n in ((0, 0), (1, 1), (1, 1), (2, 2), (2, 2), (3, None)):
        work(lines.limit(0) if n is None else lines.filter(part == n), batch)
        if n is not None:
            assert rows(spark.read.parquet(str(tmp_path / "daily"))) == rows(sales.daily_sales(lines.filter(part <= n)))
    assert lines.filter("Year is null").count() > 10


def test_a_batch_reads_only_the_days_it_touches(spark, tmp_path):
    """The month holds ever more lines on other days; what a batch of one day reads stays the same."""
    lines = silver.silver_detailed(invoice_lines(spark, SMALL))
    day = lines.filter("Year = 1995 and Month = 3").agg(F.min("Day")).first()[0]
    one = lines.filter(f"Year = 1995 and Month = 3 and Day = {day}")
    read = []
    for copies in (1, 40):
        others = lines.filter(f"Year = 1995 and Month = 3 and Day <> {day}").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        others = others.withColumn("InvoiceNo", F.concat_ws("-", "InvoiceNo", "copy")).drop("copy")
        work = pipelines.refresh_daily_rollup(str(tmp_path / f"kept{copies}"), str(tmp_path / f"daily{copies}"))
        work(one, 0)
        work(others, 1)
        work(one.withColumn("InvoiceNo", F.concat(F.lit("x"), "InvoiceNo")), 2)
        version = tmp_path / f"kept{copies}" / "days" / "Year=1995" / "Month=3"
        read.append(sum(f.stat().st_size for f in (version / "batch_id=2").glob("*.parquet")))
        assert {p.name for p in version.iterdir()} >= {"batch_id=1", "batch_id=2"}
        assert (version / "batch_id=0").exists(), "the index before still names it"
    assert read[0] == pytest.approx(read[1], rel=0.1)
