import pytest
from conftest import keyed, records
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tillwise.operators import bronze, quality
from tillwise.plans import jobs
from tillwise.sources import tables
from tillwise.sources.tables import BRONZE, Lakehouse, read_csv, write_table


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "retail.csv"
    path.write_text(
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        '9001,q-1,"SIGN, ""OPEN""",40,3/9/2023 17:45,0.8,r2,Oman\n'
        "9002,q-2,LADDER,few,3/9/2023 18:00,31.5,,Fiji\n"
    )
    return str(path)


def test_csv_keeps_explicit_types_and_quotes(spark, csv):
    rows = keyed(read_csv(spark, csv), "InvoiceNo")
    assert rows["9001"]["Description"] == 'SIGN, "OPEN"'
    assert rows["9001"]["Quantity"] == 40
    assert rows["9002"]["CustomerID"] is None


def test_unreadable_value_keeps_the_line(spark, csv):
    rows = keyed(read_csv(spark, csv), "InvoiceNo")
    assert rows["9001"]["_corrupt_record"] is None
    assert rows["9002"]["Quantity"] is None
    assert rows["9002"]["_corrupt_record"].startswith("9002,q-2")


def test_source_file_is_the_scanned_file(spark, csv):
    annotated = bronze.annotate(read_csv(spark, csv), "2024-01-01 00:00:00")
    assert {r["source_file"].rsplit("/", 1)[-1] for r in annotated.collect()} == {"retail.csv"}


def test_manual_rows_have_a_default_source(bronze_lines):
    row = bronze.annotate(bronze_lines, "2024-01-01 00:00:00").first()
    assert row["source_file"] == "manual_input"
    assert str(row["ingestion_timestamp"]) == "2024-01-01 00:00:00"
    assert bronze.annotate(bronze_lines).first()["ingestion_timestamp"] is not None


def test_null_profile(bronze_lines):
    holes = bronze_lines.withColumn(
        "CustomerID", F.when(F.col("CustomerID") != "k1", F.col("CustomerID"))
    )
    rows = keyed(quality.null_profile(holes), "column_name")
    assert rows["CustomerID"]["null_count"] == 2
    assert rows["Country"]["null_count"] == 0
    assert rows["Country"]["total_rows"] == 7
    assert rows["Country"]["completeness_score"] == pytest.approx(54 / 56)


def test_null_profile_of_an_empty_table(bronze_lines):
    rows = records(quality.null_profile(bronze_lines.limit(0)))
    assert len(rows) == 8
    assert all(r["total_rows"] == 0 and r["completeness_score"] is None for r in rows)


def test_job_counts_rows_and_nulls_while_writing(spark, csv, tmp_path):
    lake = Lakehouse(str(tmp_path / "lake"))
    seen = jobs.run_bronze(spark, csv, lake)
    assert seen["rows"] == 2
    assert seen["null_CustomerID"] == 1
    assert seen["null_Quantity"] == 1
    assert lake.read(spark, BRONZE, "online_retail").count() == 2


def test_append_and_overwrite(spark, bronze_lines, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(bronze_lines, path)["rows"] == 7
    write_table(bronze_lines, path, "append")
    assert spark.read.parquet(path).count() == 14
    write_table(bronze_lines.select("InvoiceNo"), path)
    assert spark.read.parquet(path).columns == ["InvoiceNo"]


def test_append_of_another_schema_is_refused(spark, bronze_lines, tmp_path):
    path = str(tmp_path / "t")
    write_table(bronze_lines, path)
    with pytest.raises(ValueError, match="Quantity"):
        write_table(bronze_lines.withColumn("Quantity", F.col("Quantity").cast("string")), path, "append")
    assert spark.read.parquet(path).count() == 7


def test_enforced_overwrite(spark, bronze_lines, tmp_path):
    path = str(tmp_path / "t")
    write_table(bronze_lines, path, enforce_schema=True)
    with pytest.raises(ValueError, match="Country"):
        write_table(bronze_lines.drop("Country"), path, enforce_schema=True)
    write_table(bronze_lines.limit(1), path, enforce_schema=True)
    assert spark.read.parquet(path).count() == 1


def test_missing_table_fails(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        Lakehouse(str(tmp_path)).read(spark, BRONZE, "nothing")


def test_a_table_is_rewritten_from_itself(spark, bronze_lines, tmp_path):
    path = str(tmp_path / "t")
    write_table(bronze_lines, path)
    write_table(spark.read.parquet(path).filter("CustomerID = 'k0'"), path)
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_failed_overwrite_leaves_the_table(spark, bronze_lines, tmp_path):
    path = str(tmp_path / "t")
    write_table(bronze_lines, path)
    broken = bronze_lines.withColumn("Quantity", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        write_table(broken, path)
    assert spark.read.parquet(path).count() == 7


def test_a_failed_swap_puts_the_old_table_back(spark, bronze_lines, tmp_path, monkeypatch):
    """The second of the two renames fails; the table is as before and the new one lies where it was written."""
    path = str(tmp_path / "t")
    write_table(bronze_lines, path)
    real = tables._file_system

    class Files:
        def __init__(self, files):
            self.files, self.renames = files, 0

        def __getattr__(self, name):
            return getattr(self.files, name)

        def rename(self, one, other):
            self.renames += 1
            return self.renames != 2 and self.files.rename(one, other)

    def failing(session, place):
        files, at = real(session, place)
        return Files(files), at

    monkeypatch.setattr(tables, "_file_system", failing)
    with pytest.raises(OSError, match="could not replace"):
        write_table(bronze_lines.limit(1), path)
    assert spark.read.parquet(path).count() == 7
    staged = [p for p in tmp_path.iterdir() if p.name.startswith("_t-")]
    assert len(staged) == 1 and spark.read.parquet(str(staged[0])).count() == 1


def test_partitioned_write(spark, silver_lines, tmp_path):
    path = str(tmp_path / "t")
    write_table(silver_lines, path, partition_by=["Year", "Month"])
    assert all((tmp_path / "t" / "Year=2022" / f"Month={m}").is_dir() for m in (6, 7))
