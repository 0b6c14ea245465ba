import random
from datetime import date

import pytest
from conftest import keyed, records
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwise import constants as K
from tillwise.functions import money
from tillwise.functions.distribution import quantiles, value_positions, with_ranks
from tillwise.functions.scoring import rfm_segment
from tillwise.operators import customers, sales


def test_daily_sales(silver_lines):
    rows = keyed(sales.daily_sales(silver_lines), "Day")
    names = (
        "daily_revenue", "transaction_count", "customer_interactions", "unique_customers",
        "avg_order_value", "max_order_value", "min_order_value",
    )
    assert [rows[10][n] for n in names] == pytest.approx([17.25, 1, 0, 0, 8.63, 12.25, 5.0])
    assert [rows[12][n] for n in names] == pytest.approx([85.75, 2, 2, 2, 42.88, 49.0, 36.75])
    assert [rows[1][n] for n in names] == pytest.approx([187.0, 2, 4, 2, 46.75, 49.0, 40.0])


def test_country_sales_with_a_guest_only_country(silver_lines):
    rows = keyed(sales.country_sales(silver_lines), "Country")
    names = (
        "total_revenue", "total_orders", "unique_customers", "avg_order_value", "total_quantity_sold",
        "revenue_per_customer",
    )
    assert [rows["PERU"][n] for n in names] == [17.25, 1, 0, 8.63, 11, None]
    assert [rows["KENYA"][n] for n in names] == [174.75, 3, 2, 43.69, 104, 87.38]
    assert [rows["ICELAND"][n] for n in names] == [98.0, 1, 1, 49.0, 5, 98.0]


@pytest.mark.parametrize("table", [sales.daily_sales, sales.country_sales, customers.customer_base])
def test_rollup_gives_the_same_tables(silver_lines, table):
    assert records(table(silver_lines)) == records(table(sales.invoice_rollup(silver_lines)))


def test_approximate_distinct_counts(silver_lines):
    exact, near = sales.country_sales(silver_lines), sales.country_sales(silver_lines, approx=True)
    assert records(exact) == records(near), "sketches are exact for a handful of values"


def test_product_ranking(silver_lines):
    rows = keyed(sales.product_ranking(silver_lines), "StockCode")
    found = {
        stock: (r["total_revenue"], r["total_quantity_sold"], r["revenue_rank"], r["quantity_rank"])
        for stock, r in rows.items()
    }
    assert found == {"POT": (98.0, 8, 1, 2), "HOSE": (98.0, 2, 1, 3), "SEED": (54.0, 108, 3, 1), "RAKE": (40.0, 2, 4, 3)}
    ranks = [r["revenue_rank"] for r in sales.product_ranking(silver_lines).collect()]
    assert ranks == sorted(ranks)


def test_rfm_detailed(silver_lines):
    rows = keyed(customers.rfm_detailed(silver_lines), "CustomerID")
    names = (
        "recency", "frequency", "monetary_value", "recency_score", "frequency_score", "monetary_score",
        "customer_segment",
    )
    assert [rows["c5"][n] for n in names] == [19, 1, 36.75, 2, 4, 2, "At Risk"]
    assert [rows["c2"][n] for n in names] == [0, 2, 138.0, 5, 5, 5, "Champions"]
    assert [rows["c8"][n] for n in names] == [0, 1, 98.0, 5, 4, 4, "Champions"]
    assert len(rows) == 3, "guests have no score"


def test_rfm_thresholds(silver_lines):
    row = customers.rfm_thresholds(silver_lines).first().asDict()
    assert [row[f"recency_{p}"] for p in (20, 40, 60, 80)] == [0, 0, 0, 19]
    assert [row[f"frequency_{p}"] for p in (20, 40, 60, 80)] == [1, 1, 1, 2]
    assert [row[f"monetary_{p}"] for p in (20, 40, 60, 80)] == [36.75, 98.0, 98.0, 138.0]


@pytest.mark.parametrize("operator", [customers.rfm_detailed, customers.cltv_detailed, customers.rfm_thresholds])
def test_sketched_cut_points_agree_on_few_customers(silver_lines, operator):
    assert records(operator(silver_lines)) == records(operator(silver_lines, sketch=True))


def test_cltv_detailed(silver_lines):
    rows = keyed(customers.cltv_detailed(silver_lines), "CustomerID")
    names = (
        "customer_lifespan_days", "total_orders", "total_transactions", "total_spent", "avg_order_value",
        "purchase_frequency", "predicted_cltv", "cltv_segment",
    )
    numbers = {name: [r[n] for n in names[:-1]] for name, r in rows.items()}
    assert numbers == {
        "c2": [20, 2, 3, 138.0, 46.0, 0.1, 1679.0], "c5": [1, 1, 1, 36.75, 36.75, 1.0, 13413.75], "c8": [1, 1, 2, 98.0, 49.0, 1.0, 17885.0]
    }
    bands = [rows[name]["cltv_segment"] for name in ("c2", "c5", "c8")]
    assert bands == [K.CLTV_BANDS[i] for i in (1, 3, 4)], "one of five cuts, three, all"


def test_customer_tables_of_nothing(silver_lines):
    nothing = silver_lines.limit(0)
    assert customers.rfm_detailed(nothing).collect() == []
    assert customers.cltv_detailed(nothing).collect() == []
    assert sales.product_ranking(nothing).collect() == []


def test_simple_customer_tables(simple_lines):
    rows = keyed(
        customers.projection(customers.cltv_simple(customers.rfm_simple(simple_lines))), "CustomerID"
    )
    found = {k: (r["Recency"], r["Frequency"], r["Monetary"], r["CLTV"]) for k, r in rows.items()}
    assert found == {"c2": (0, 3, 138.0, 414.0), "c8": (0, 2, 98.0, 196.0), "c5": (19, 1, 36.75, pytest.approx(36.75 / 20))}
    assert rows["c8"]["ExpectedRevenue_12M"] == pytest.approx(196.0 * 12)


def test_simple_rfm_with_guests_measures_from_their_latest_line(simple_lines):
    late = simple_lines.filter("CustomerID = 'c5'").selectExpr(
        "InvoiceNo", "StockCode", "Description", "Quantity", "timestamp'2022-07-20 00:00:00' as InvoiceDate",
        "UnitPrice", "cast(null as string) as CustomerID", "Country",
    )
    rows = keyed(customers.rfm_simple(simple_lines.unionByName(late)), "CustomerID")
    assert {k: r["Recency"] for k, r in rows.items()} == {"c2": 19, "c5": 38, "c8": 19}


def test_simple_sales_tables(simple_lines):
    days = keyed(sales.daily_sales_simple(simple_lines), "SaleDate")
    assert set(days) == {date(2022, 6, 12), date(2022, 7, 1)}
    last = days[date(2022, 7, 1)]
    assert (last["TotalQuantity"], last["UniqueCustomers"], last["TotalTransactions"]) == (105, 2, 4)
    assert last["TotalRevenue"] == pytest.approx(187.0)
    country = records(sales.country_sales_simple(simple_lines))
    assert [(c["Country"], c["UniqueProducts"], c["TotalQuantity"]) for c in country] == [("KENYA", 4, 104), ("ICELAND", 2, 5)]


def test_top_products_settle_ties_by_code(simple_lines):
    top = sales.top_products(simple_lines, 4).collect()
    assert [r["StockCode"] for r in top] == ["SEED", "POT", "HOSE", "RAKE"]
    assert [r["TotalSold"] for r in sales.top_descriptions(simple_lines, 2).collect()] == [98, 7]


def test_totals_agree_between_tables(silver_lines):
    by_day = sales.daily_sales(silver_lines).agg(F.sum("daily_revenue")).first()[0]
    by_country = sales.country_sales(silver_lines).agg(F.sum("total_revenue")).first()[0]
    by_product = sales.product_sales(silver_lines).agg(F.sum("total_revenue")).first()[0]
    assert by_day == pytest.approx(by_country) == pytest.approx(by_product)


def test_every_score_combination_has_one_segment(spark):
    scores = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    df = spark.createDataFrame(scores, "r int, f int, m int")
    found = df.select("r", "f", "m", rfm_segment(F.col("r"), F.col("f"), F.col("m")).alias("s")).collect()

    def expected(r, f, m):
        if min(r, f, m) >= 4:
            return "Champions"
        if min(r, f, m) >= 3:
            return "Loyal Customers"
        if r >= 4 and f <= 2:
            return "New Customers"
        if r <= 2:
            return "At Risk" if f >= 3 else "Can't Lose Them" if m >= 3 else "Lost"
        return "Potential Loyalists"

    assert [row["s"] for row in found] == [expected(*s) for s in scores]


def rank_by_hand(values):
    known = [v for v in values if v is not None]
    return [1 + sum(o > v for o in known) if v is not None else len(known) + 1 for v in values]


def quantile_by_hand(values, share):
    ordered = sorted(v for v in values if v is not None)
    needed = max(1, -(-round(share * 100) * len(ordered) // 100))
    return ordered[needed - 1] if ordered else None


numbers = st.one_of(st.none(), st.integers(-5, 5), st.sampled_from([7] * 5), st.integers(-(10**9), 10**9))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(numbers, min_size=1, max_size=60))
def test_ranks_and_quantiles_against_brute_force(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v bigint").repartition(5)
    ranks = {r["id"]: r["place"] for r in with_ranks(df, {"place": "v"}).collect()}
    assert [ranks[i] for i in range(len(values))] == rank_by_hand(values)
    cuts = spark.range(1).select(quantiles(df, ["v"]).alias("c")).first()["c"]["v"]
    assert cuts == [quantile_by_hand(values, p) for p in K.QUINTILES]


def test_many_values_and_one_that_holds_a_third(spark):
    draw = random.Random(3)
    values = [1000] * 4000 + [draw.randrange(100_000) for _ in range(8000)]
    draw.shuffle(values)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v bigint").repartition(8)
    ordered = sorted(values)
    places = {r["value"]: (r["before"], r["n"]) for r in value_positions(df, ["v"]).collect()}
    position = 0
    for value in sorted(set(values)):
        n = values.count(value) if value == 1000 else places[value][1]
        assert places[value] == (position, n)
        position += n
    cuts = spark.range(1).select(quantiles(df, ["v"]).alias("c")).first()["c"]["v"]
    assert cuts == [ordered[-(-len(values) * p // 100) - 1] for p in (20, 40, 60, 80)]


def test_segment_counts(silver_lines):
    rfm = customers.rfm_detailed(silver_lines)
    assert keyed(customers.segment_counts(rfm), "customer_segment")["Champions"]["customers"] == 2
    assert customers.distinct_segments(rfm, "customer_segment").first()["segments"] == 2


def test_small_and_large_amounts_add_up(spark):
    cents = spark.range(10_000).selectExpr("0.00004D as TotalAmount").agg(money.as_double(money.total(F.col("TotalAmount"))))
    assert cents.first()[0] == 0.4
    large = spark.createDataFrame([(1.2e17,), (3.0e16,)], "ExpectedRevenue_12M double")
    assert customers.projection_total(large).first()[0] == 1.5e17


def test_whole_numbers_that_are_one_double_have_their_own_ranks(spark):
    df = spark.createDataFrame([(2**53,), (2**53 + 1,), (None,), (5,)], "v bigint")
    assert {r["v"]: r["place"] for r in with_ranks(df, {"place": "v"}).collect()} == {2**53 + 1: 1, 2**53: 2, 5: 3, None: 4}
    cuts = spark.range(1).select(quantiles(df, ["v"], (0.5, 1.0)).alias("c")).first()["c"]["v"]
    assert cuts == [2**53, 2**53 + 1]


def test_bounds_are_sorted_once(spark):
    """Not for every element of a lambda that reads them."""
    df = spark.range(40).selectExpr("cast(id % 7 as double) as v")
    plan = value_positions(df, ["v"], descending=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array(" in plan
    assert "lambdafunction(element_at(sort_array(" not in plan


@pytest.mark.parametrize("limit", [0, 1, 1_000])
def test_products_of_many_and_of_few_lines(silver_lines, limit):
    """The same table whether all products, some or none are spread by their values."""
    more = silver_lines.filter("StockCode = 'SEED'").withColumns({"InvoiceNo": F.lit("m-9"), "CustomerID": F.lit("c9")})
    lines = silver_lines.unionByName(more).unionByName(silver_lines.withColumn("Description", F.lit(None).cast("string")))
    crowded = [row["slot"] for row in sales.crowded_slots(lines, limit).collect()]
    assert bool(crowded) == (limit < 1_000)
    found = sales.product_sales(lines, crowded=crowded)
    assert sorted(map(str, found.collect())) == sorted(map(str, sales.product_sales(lines).collect()))
    assert ("Expand" in found._jdf.queryExecution().optimizedPlan().toString()) == bool(crowded)
