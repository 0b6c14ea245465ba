from datetime import datetime

from conftest import keyed, records
from pyspark.sql import functions as F

from tillwise.operators import quality, silver

DATE = "12/1/2010 8:26"


def line(invoice="1", stock="a1", text="lamp", quantity=1, date=DATE, price=1.0, customer="7", country="UK"):
    return (invoice, stock, text, quantity, date, price, customer, country)


def test_invalid_lines_are_removed(raw):
    lines = raw(
        line("1"), line(None), line(""), line("4", quantity=0), line("5", quantity=-2), line("6", quantity=None),
        line("7", price=0.0), line("8", price=-1.0), line("9", price=None),
    )
    assert [r["InvoiceNo"] for r in silver.clean_lines(lines).collect()] == ["1"]


def test_text_is_trimmed_and_upper_case(raw):
    row = silver.clean_lines(raw(line(stock=" a1 ", text="  red Lamp ", country=" France "))).first()
    assert (row["StockCode"], row["Description"], row["Country"]) == ("A1", "RED LAMP", "FRANCE")


def test_both_time_formats_and_nonsense(raw):
    lines = raw(line("1"), line("2", date="2010-12-01 08:26:00"), line("3", date="soon"), line("4", date=None))
    rows = keyed(silver.clean_lines(lines), "InvoiceNo")
    assert rows["1"]["InvoiceTimestamp"] == rows["2"]["InvoiceTimestamp"] == datetime(2010, 12, 1, 8, 26)
    assert rows["3"]["InvoiceTimestamp"] is None and rows["4"]["Year"] is None


def test_calendar_and_amount(raw):
    row = silver.clean_lines(raw(line(quantity=3, price=2.5))).first()
    assert (row["Year"], row["Month"], row["Day"], row["DayOfWeek"]) == (2010, 12, 1, 4)
    assert row["TotalAmount"] == 7.5


def test_business_rules(raw):
    lines = raw(
        line("1"), line("C2"), line("3", text="test lamp"), line("4", text="a Sample"), line("5", text="adjustment"),
        line("6", text=None), line("c7"),
    )
    kept = {r["InvoiceNo"] for r in silver.silver_detailed(lines).collect()}
    assert kept == {"1", "c7"}, "a line without description does not pass, a lower-case c does"


def test_country_names(raw):
    names = ["eire", "Ireland", " European Community", "Unspecified", "Spain"]
    lines = raw(*[line(str(i), country=c) for i, c in enumerate(names)], line("9", country=None))
    rows = keyed(silver.silver_detailed(lines), "InvoiceNo")
    assert [rows[str(i)]["Country"] for i in range(5)] == ["IRELAND", "IRELAND", "EUROPE", "UNKNOWN", "SPAIN"]
    assert rows["9"]["Country"] is None


def test_customer_type(raw):
    rows = keyed(silver.silver_detailed(raw(line("1"), line("2", customer=None))), "InvoiceNo")
    assert (rows["1"]["CustomerType"], rows["2"]["CustomerType"]) == ("REGISTERED", "GUEST")


def test_cleaning_twice_changes_nothing(raw):
    lines = raw(line("1", text=" lamp ", country="eire"), line("2", customer=None, quantity=4))
    once = silver.silver_detailed(lines)
    columns = lines.columns
    twice = silver.silver_detailed(once.select(*columns))
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_simple_variant(raw):
    lines = raw(
        line("1", text="  lamp "), line("C2"), line("3", customer=None), line("4", text=None), line("5", date=None),
        line("6", quantity=-1), line("7", price=0.0),
    )
    rows = keyed(silver.silver_simple(lines), "InvoiceNo")
    assert set(rows) == {"1", "C2"}, "credit notes stay, guests go"
    assert rows["1"]["Description"] == "lamp"
    assert rows["1"]["InvoiceDate"] == datetime(2010, 12, 1, 8, 26)


def test_simple_variant_recasts_text_columns(raw):
    text = raw(line("1"), line("2")).select(
        *[F.col(c).cast("string") for c in ("InvoiceNo", "StockCode", "Description")],
        F.when(F.col("InvoiceNo") == "1", "5").otherwise("many").alias("Quantity"),
        "InvoiceDate",
        F.lit("2.5").alias("UnitPrice"),
        F.lit(17850).alias("CustomerID"),
        "Country",
    )
    rows = records(silver.silver_simple(text))
    assert [(r["Quantity"], r["UnitPrice"], r["CustomerID"]) for r in rows] == [(5, 2.5, "17850")]


def test_retention_counts_match_the_filters(raw):
    lines = raw(line("1"), line("C2"), line("3", text=None), line("4", quantity=0), line(None), line("6", text="TEST"))
    row = silver.retention(lines).first()
    assert row["rows_in"] == lines.count()
    assert row["rows_cleaned"] == silver.clean_lines(lines).count()
    assert row["rows_sold"] == silver.silver_detailed(lines).count()
    assert row["retention_rate"] == 66.67 and row["filtered_percentage"] == 25.0


def test_retention_of_nothing(raw):
    row = silver.retention(raw(line()).limit(0)).first()
    assert (row["rows_in"], row["retention_rate"], row["filtered_percentage"]) == (0, None, None)


def test_completeness_leaves_customers_out(silver_lines):
    row = quality.silver_completeness(silver_lines).first()
    assert (row["total_rows"], row["null_cells"], row["completeness_score"]) == (8, 0, 100.0)


def test_outliers_on_the_fixture(silver_lines):
    row = quality.quantity_outliers(silver_lines).first()
    assert (row["outlier_count"], row["mean_quantity"], row["stddev_quantity"]) == (0, 15.0, 33.67)


def test_outliers_against_a_direct_count(spark):
    values = [5] * 200 + [6] * 150 + [7] * 3 + [400, 900, None, None]
    df = spark.createDataFrame([(v,) for v in values], "Quantity int").repartition(7)
    mean, deviation = df.selectExpr("avg(Quantity)", "stddev_samp(Quantity)").first()
    high, low = mean + 3 * deviation, max(0.0, mean - 3 * deviation)
    expected = sum(1 for v in values if v is not None and (v > high or v < low))
    row = quality.quantity_outliers(df).first()
    assert (row["total_rows"], row["outlier_count"]) == (len(values), expected)
    assert row["mean_quantity"] == round(mean, 2) and row["stddev_quantity"] == round(deviation, 2)


def test_outliers_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([(4,)], "Quantity int")
    row = quality.quantity_outliers(one).first()
    assert (row["total_rows"], row["outlier_count"], row["stddev_quantity"]) == (1, 0, None)
    row = quality.quantity_outliers(one.limit(0)).first()
    assert (row["total_rows"], row["outlier_count"], row["outlier_percentage"]) == (0, 0, None)
