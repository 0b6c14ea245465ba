import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillwise import schemas  # noqa: E402
from tillwise.operators import silver  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Build raw invoice lines from tuples."""
    return lambda *rows: spark.createDataFrame(list(rows), schemas.RAW_LINES)


@pytest.fixture(scope="session")
def bronze_lines(spark):
    """Seven raw lines of three customers, made by rule."""
    return spark.range(7).selectExpr(
        "'b-' || id div 3 as InvoiceNo", "'item' || id as StockCode", "'thing ' || id as Description", "cast(id + 1 as int) as Quantity",
        "'2/' || (id + 1) || '/2023 15:30' as InvoiceDate", "id / 4 + 1 as UnitPrice", "'k' || id % 3 as CustomerID", "'Malta' as Country",
    )


@pytest.fixture(scope="session")
def silver_lines(spark):
    """A garden shop: a country of guests only, three customers, three days, ties in revenue and in units."""
    items = {"seed": ("poppy seed", 0.5), "pot": ("clay pot", 12.25), "hose": ("garden hose", 49.0), "rake": ("leaf rake", 20.0)}
    invoices = [
        ("g-9", "6/10/2022 14:05", None, "Peru", {"seed": 10, "pot": 1}),
        ("m-1", "6/12/2022 9:30", "c5", "Kenya", {"pot": 3}),
        ("m-2", "6/12/2022 16:00", "c2", "Kenya", {"hose": 1}),
        ("m-3", "7/1/2022 8:00", "c2", "Kenya", {"seed": 98, "rake": 2}),
        ("m-4", "7/1/2022 11:15", "c8", "Iceland", {"pot": 4, "hose": 1}),
    ]
    rows = [
        (invoice, item, items[item][0], quantity, time, items[item][1], customer, country)
        for invoice, time, customer, country, basket in invoices
        for item, quantity in basket.items()
    ]
    return silver.silver_detailed(spark.createDataFrame(rows, schemas.RAW_LINES))


@pytest.fixture(scope="session")
def simple_lines(silver_lines):
    return silver_lines.filter("CustomerID is not null").selectExpr(
        "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceTimestamp as InvoiceDate",
        "UnitPrice", "CustomerID", "Country",
    )


@pytest.fixture(scope="session")
def now():
    return datetime(2024, 1, 2, 12, 0, 0)


def records(df):
    return [row.asDict() for row in df.collect()]


def keyed(df, *keys):
    rows = records(df)
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}
