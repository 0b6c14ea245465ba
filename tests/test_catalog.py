"""Every catalog query against its SQL, and the shape of the plans."""

import pytest
from conftest import SMALL
from parity import connect, differences, types_of

import __spark_entry__ as entry
from tillwise.plans.catalog import QUERIES
from tillwise.plans.oracle import oracle_sql

SQL = oracle_sql()
ROWS_ONLY = {"sales_forecast", "customer_clusters", "job_models"}
PAIR_JOINS = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_all_queries_but_the_models_have_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) - set(entry.oracle_sql()) == ROWS_ONLY
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_values_and_types(spark, duck, name):
    """Also: no join of all pairs and no Python in the plan."""
    df = QUERIES[name](spark, SMALL)
    plan = plan_of(df)
    assert not [operator for operator in PAIR_JOINS + PYTHON if operator in plan]
    relation = duck.sql(SQL[name])
    assert differences(df.toPandas(), relation.df()) is None
    assert types_of(df.schema, relation) == {}


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_model_queries_give_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_filters_and_columns_reach_the_scan(spark, silver_lines, tmp_path):
    path = str(tmp_path / "silver")
    silver_lines.write.parquet(path)
    from tillwise.operators import customers, sales

    stored = spark.read.parquet(path)
    country = plan_of(sales.country_sales(stored))
    assert "ReadSchema: struct<InvoiceNo:string,Quantity:int,CustomerID:string,Country:string,TotalAmount:double>" in country
    assert "IsNotNull(CustomerID)" in plan_of(customers.customer_base(stored))


def scanned_rows(spark, action) -> int:
    store = spark._jsc.sc().statusStore()
    none = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)

    def stages():
        found = store.stageList(None, False, False, none, None)
        return {found.apply(i).stageId(): found.apply(i).inputRecords() for i in range(found.size())}

    last = max(stages(), default=-1)
    action()
    return sum(rows for stage, rows in stages().items() if stage > last)


@pytest.mark.parametrize("name", ["rfm_simple", "value_histogram", "customer_kpis", "outliers_raw", "customer_features"])
def test_lines_are_scanned_once(spark, name):
    """Table-wide values come from the same shuffle as the table."""
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    read = scanned_rows(spark, QUERIES[name](spark, SMALL).collect)
    assert lines <= read < 2 * lines
