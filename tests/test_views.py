from datetime import date

import numpy as np
import pytest
from conftest import keyed, records

from tillwise.operators import views


@pytest.fixture
def people(spark):
    draw = np.random.default_rng(5)
    rows = [(str(i), float(v), int(n)) for i, (v, n) in enumerate(zip(draw.gamma(2, 50, 500), draw.integers(0, 9, 500)))]
    return spark.createDataFrame(rows, "CustomerID string, Monetary double, Frequency bigint")


def test_histogram_equals_numpy(people):
    found = keyed(views.histograms(people, ["Monetary", "Frequency"]), "measure", "bin")
    local = people.toPandas()
    for measure in ("Monetary", "Frequency"):
        counts, edges = np.histogram(local[measure], bins=50)
        assert [found[measure, b]["n"] for b in range(50)] == list(counts)
        assert [found[measure, b]["bin_start"] for b in range(50)] == pytest.approx(list(edges[:-1]))
        assert [found[measure, b]["bin_end"] for b in range(50)] == pytest.approx(list(edges[1:]))


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(4.0,)] * 3, "v double")
    counts, edges = np.histogram([4.0] * 3, bins=50)
    rows = records(views.histograms(df, ["v"]).orderBy("bin"))
    assert [r["n"] for r in rows] == list(counts)
    assert rows[0]["bin_start"] == edges[0]


def test_histogram_leaves_nulls_out(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "v double")
    assert sum(r["n"] for r in views.histograms(df, ["v"], 10).collect()) == 2


def test_key_figures(spark):
    df = spark.createDataFrame([(10.0, 1, 4), (20.5, 2, 5)], "Monetary double, Frequency bigint, Recency int")
    assert records(views.customer_kpis(df)) == [
        {"customers": 2, "mean_monetary": 15.25, "mean_frequency": 1.5, "mean_recency": 4.5}
    ]


def test_series_and_totals(spark):
    days = spark.createDataFrame([(date(2024, 1, 2), 2.5), (date(2024, 1, 1), 1.25)], "SaleDate date, TotalRevenue double")
    assert [r["TotalRevenue"] for r in views.revenue_series(days).collect()] == [1.25, 2.5]
    assert records(views.revenue_totals(days)) == [{"days": 2, "total_revenue": 3.75}]


def test_shares_are_among_the_listed_countries(spark):
    rows = [("A", 60.0), ("B", 30.0), ("C", 10.0), ("D", 5.0)]
    found = records(views.country_share(spark.createDataFrame(rows, "Country string, CountryRevenue double"), 3))
    assert {r["Country"]: r["share_pct"] for r in found} == {"A": 60.0, "B": 30.0, "C": 10.0}
