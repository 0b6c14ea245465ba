"""Sketches kept in tables against exact values, and rules kept in a table."""

import random

import pytest
from conftest import SMALL, records
from pyspark.sql import functions as F

from tillwise.functions import distribution, sketches
from tillwise.operators import aliases, monitor
from tillwise.sources.invoice_adapter import read_table


@pytest.fixture(scope="module")
def numbers(spark):
    """Whole numbers and doubles of four keys, one with two thirds of all rows; ties, nulls, a key without values."""
    rng = random.Random(8)
    rows = [("hot" if i % 3 else f"k{i % 2}", rng.randrange(40) if i % 7 else rng.randrange(2**60), rng.gauss(0, 1) if i % 11 else None) for i in range(30_000)]
    return spark.createDataFrame([*rows, ("none", None, None)], "key string, whole bigint, real double").repartition(9)


def test_quantiles_merged_from_parts_keep_their_promise(spark, numbers):
    measures = {"whole": "bigint", "real": "double"}
    shares = (0.01, 0.2, 0.5, 0.8, 0.999)
    table = sketches.quantile_table(numbers, list(measures), ["key"], k=400)
    cuts = sketches.merged_quantiles(table, measures, shares).select(F.struct(*measures).alias("cuts")).scalar()
    found = records(sketches.rank_errors(numbers, list(measures), cuts, shares))
    assert [(r["measure"], r["share"]) for r in found] == [(m, p) for m in measures for p in shares]
    assert all(r["error"] <= sketches.rank_error(400) for r in found)
    assert {r["n"] for r in found} == {numbers.filter("whole is not null").count(), numbers.filter("real is not null").count()}
    empty = sketches.merged_quantiles(table.filter("key = 'none'"), measures, shares).first()
    assert empty["whole"] is None and empty["real"] is None


@pytest.mark.parametrize("margin", [None, 0.0, 0.9])
def test_sketched_cut_points_are_the_exact_ones(spark, numbers, monkeypatch, margin):
    """Also where the cut point is not between the bounds that the sketch gave."""
    if margin is not None:
        monkeypatch.setattr(distribution, "rank_error", lambda: margin)
    shares = (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)
    made = [distribution.quantiles(numbers, ["whole", "real"], shares, sketch=sketch) for sketch in (False, True)]
    row = spark.range(1).select(made[0].alias("exact"), made[1].alias("sketched")).first()
    assert row["exact"] == row["sketched"]
    empty = distribution.quantiles(numbers.limit(0), ["whole", "real"], shares, sketch=True)
    assert spark.range(1).select(empty["whole"][1].alias("cut")).first()["cut"] is None


def test_rank_errors_count_ties_on_both_sides(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (2,), (9,), (None,)], "v int")
    cuts = spark.range(1).select(F.struct(F.array(F.lit(2), F.lit(1), F.lit(9)).alias("v")).alias("cuts")).select("cuts").scalar()
    found = [r["error"] for r in records(sketches.rank_errors(df, ["v"], cuts, (0.5, 0.5, 0.5)))]
    assert found == [0.0, pytest.approx(0.3), pytest.approx(0.3)]


def test_distinct_counts_and_meetings_of_sets(spark):
    rows = [(day, key, f"c{(i * 7 + day * 300) % 5000}") for day in range(6) for key in ("a", "b", None) for i in range(2500 if key == "a" else 30)]
    df = spark.createDataFrame([*rows, (2, "b", None)], "day int, key string, who string")
    table = sketches.distinct_table(df, ["who"], ["day", "key"])
    exact = {r["key"]: r["n"] for r in records(df.groupBy("key").agg(F.count_distinct(F.col("who")).alias("n")))}
    for r in records(sketches.merged_distinct(table, ["who"], ["key"])):
        assert abs(r["who"] - exact[r["key"]]) <= 1 + sketches.distinct_error() * exact[r["key"]]
    sets = {(k, d // 2): {w for day, key, w in rows if key == k and day // 2 == d // 2} for k in ("a", "b", None) for d in range(6)}
    found = records(sketches.returning(table, "who", F.expr("day div 2"), ["key"]))
    assert {(r["key"], r["period"]) for r in found} == {(k, p) for k in ("a", "b", None) for p in (1, 2)}
    for r in found:
        now, was = sets[r["key"], r["period"]], sets[r["key"], r["period"] - 1]
        assert abs(r["returning"] - len(now & was)) <= 1 + sketches.distinct_error() * len(now | was)


def ks_by_hand(one, other):
    places = sorted({*one, *other})
    return max(abs(sum(v <= x for v in one) / len(one) - sum(v <= x for v in other) / len(other)) for x in places)


@pytest.mark.parametrize("shift, spread", [(0, 1), (0.4, 1), (0, 2.5), (3, 0.2)])
def test_distance_of_distributions(spark, shift, spread):
    """Shifts of the mean and of the spread alone both show."""
    rng = random.Random(4)
    one, other = [rng.gauss(0, 1) for _ in range(1500)], [rng.gauss(shift, spread) for _ in range(900)]
    tables = [spark.createDataFrame([(v,) for v in side], "v double") for side in (one, other)]
    made = [t.agg(sketches.quantile_sketch(t, "v").alias("s")).scalar() for t in tables]
    both = spark.range(1).select(made[0].alias("one"), made[1].alias("other"))
    found = both.select(sketches.ks_distance(F.col("one"), F.col("other")).alias("d")).first()["d"]
    assert found == pytest.approx(ks_by_hand(one, other), abs=0.011)


def test_drift_of_distributions_is_told(spark):
    """A feature with the same mean and another spread, one that did not move, one without values now."""
    was = spark.range(1000).selectExpr("cast(id % 100 as double) as same", "cast(id % 2 as double) as wide", "id as gone")
    now = spark.range(700).selectExpr("cast(id % 100 as double) as same", "0.5D as wide", "cast(null as bigint) as gone")
    found = {r["name"]: r for r in records(monitor.distribution_drift(now, monitor.feature_sketches(was, was.columns), "m"))}
    assert {n.split("_")[1]: (r["status"], r["alert_level"]) for n, r in found.items()} == {
        "same": ("healthy", None), "wide": ("unhealthy", "warning"), "gone": ("unhealthy", "critical")
    }


def test_aliases_from_a_table(spark):
    rules = spark.createDataFrame([("GB", "UK"), ("GB", "UK"), ("ENG", "UK"), (None, "x"), ("DE", None)], "found string, wanted string")
    df = spark.createDataFrame([(1, "GB"), (2, "ENG"), (3, "DE"), (4, None), (5, "FR")], "id int, country string")
    got = {r["id"]: r["country"] for r in records(aliases.with_aliases(df, "country", rules))}
    assert got == {1: "UK", 2: "UK", 3: "DE", 4: None, 5: "FR"}
    by_key = aliases.with_aliases(df, "country", rules, F.upper(F.col("country")))
    assert by_key.columns == ["id", "country"] and by_key.filter("country = 'UK'").count() == 2


def test_an_alias_with_two_targets_fails(spark):
    rules = spark.createDataFrame([("GB", "UK"), ("GB", "Britain")], "found string, wanted string")
    df = spark.createDataFrame([(1, "GB")], "id int, country string")
    with pytest.raises(Exception, match="several targets for GB: Britain, UK"):
        aliases.with_aliases(df, "country", rules).collect()


def test_ten_thousand_rules_meet_by_shuffle_when_they_are_large(spark):
    """No side is forced to be broadcast, and no join of all pairs."""
    rules = spark.range(10_000).selectExpr("'s' || id as found", "'t' || id % 7 as wanted")
    lines = read_table(spark, SMALL, "lineitem").selectExpr("'s' || l_partkey as code")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = aliases.with_aliases(lines, "code", rules)
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.filter("code not like 't%'").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
