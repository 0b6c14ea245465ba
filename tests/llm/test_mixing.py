import pytest
from pyspark.sql import functions as F

from tillwise.llm import mixing


def levels(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        gain = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += gain[s]
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


def test_targets_are_those_of_resharing(spark):
    sizes = {"a": 100, "b": 900, "c": 50, "d": 400, "e": 10, None: 30}
    slim = spark.createDataFrame([(s, n, 1.0) for s, n in sizes.items()], "mix_source string, mix_size long, mix_key double")
    found = {r.mix_source: r.target for r in mixing.source_targets(slim).collect()}
    assert found == {s: pytest.approx(t) for s, t in levels(sizes).items()}


def test_epochs_come_before_the_weighted_rest(documents):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "abc"[i % 3] if i % 3 else "a") for i in range(600)]
    taken = mixing.mix_amounts(documents(rows)).collect()
    assert len(taken) == 600
    by_source = {}
    for r in taken:
        assert r.taken in (r.size * r.epochs, r.size * (r.epochs + 1)) and r.taken <= 2 * r.size
        got, goal = by_source.get(r.source, (0, r.target))
        by_source[r.source] = (got + r.taken, goal)
    assert all(abs(got - goal) <= 4 for got, goal in by_source.values())


def test_reruns_agree_and_ranges_do_not_matter(documents, monkeypatch):
    docs = documents([(i, "x " * (i % 11 + 1), "s") for i in range(500)] + [(1000 + i, "y z", "t") for i in range(50)])
    first = sorted(mixing.mix_amounts(docs).collect())
    monkeypatch.setattr(mixing, "SORTED_ROWS", 3)
    monkeypatch.setattr(mixing, "PARTS", 4)
    assert sorted(mixing.mix_amounts(docs.repartition(5)).collect()) == first


def test_repeated_rows_are_taken_one_by_one(documents, monkeypatch):
    """A row that is 400 times in a source of 1,000 is taken as often as the budget asks, not always or never."""
    monkeypatch.setattr(mixing, "SORTED_ROWS", 50)
    rows = [(i, f"words of number {i}", "s") for i in range(600)] + [(9999, "again and again", "s")] * 400 + [(None, None, "s")] * 5
    docs = documents(rows)
    taken = mixing.mix_amounts(docs, share=0.5).collect()
    size = sum(r.size for r in taken)
    assert len(taken) == 1005 and abs(sum(r.taken for r in taken) - size / 2) <= 4
    again = [r.copies for r in taken if r.doc_id == 9999]
    assert 100 < sum(again) < 300 and set(again) == {0, 1}
    assert sorted(mixing.mix_amounts(docs.repartition(7), share=0.5).collect(), key=str) == sorted(taken, key=str)
    mixed = mixing.mix_documents(docs.repartition(3), share=0.5)
    found = dict(mixed.groupBy("doc_id").count().collect())
    assert found[9999] == sum(again) and sum(found.values()) == sum(r.copies for r in taken)


def test_unlike_weights_do_not_crowd_the_edge(spark, documents, monkeypatch):
    """Half of the rows have a weight sixteen times lower; what is sorted at the edge stays short."""
    monkeypatch.setattr(mixing, "SORTED_ROWS", 40)
    docs = documents([(i, "a b c", "s") for i in range(4000)])
    slim, _ = mixing.keyed(docs, F.when(F.col("doc_id") % 2 == 0, 0.05).otherwise(0.8))
    plan = mixing.mixing_plan(slim, share=0.9).first()
    assert 0 < plan.rows <= 40
    assert slim.filter(f"mix_key between {plan.low} and {plan.high}").count() == plan.rows


def test_heavier_documents_are_taken_more_often(documents):
    rows = [(i, "abcde" if i % 2 else "1234 " + "5678 ", "s") for i in range(2000)]
    slim = mixing.mix_amounts(documents(rows), F.when(F.col("doc_id") % 2 == 1, 4.0).otherwise(1.0), share=0.5)
    share = {r.odd: r.n for r in slim.groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.avg("copies").alias("n")).collect()}
    assert share[1] > 1.5 * share[0]


def test_odd_rows_and_clashing_columns(documents, odd_rows, spark):
    docs = documents(odd_rows, clash=True)
    amounts = mixing.mix_amounts(docs).collect()
    assert len(amounts) == len(odd_rows)
    assert [r.size for r in amounts if r.doc_id == 6] == [0]
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    total = sum(r.copies for r in amounts)
    assert mixed.count() == total
    assert mixing.mix_amounts(docs.limit(0)).count() == 0
    assert mixing.mix_documents(docs.limit(0)).count() == 0
