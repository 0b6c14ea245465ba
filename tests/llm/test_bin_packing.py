import zlib
from collections import Counter

import numpy as np
import pytest

from tillwise.llm import bin_packing
from tillwise.sources.workspace import stored


def checked(rows, out):
    assert len(out) == len(rows)
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    found = Counter((r.doc_id, r.size, r.text_crc32) for r in out)
    raw = [(i, (t or "").encode()) for i, t, _ in rows]
    assert found == Counter((i, len(t) + 1, zlib.crc32(t)) for i, t in raw)
    load = np.zeros(16)
    for r in out:
        load[r.shard] += r.size
    return load


def test_bytes_are_near_equal_and_groups_stay_together(documents):
    rng = np.random.default_rng(1)
    rows = [(i, f"{i} " + "w " * min(int(rng.pareto(1.5) * 20 + 1), 400), "s") for i in range(3000)]
    rows += [(5000 + i, "copied text " * 9, "s") for i in range(100)]
    out = bin_packing.pack_documents(documents(rows)).collect()
    load = checked(rows, out)
    assert load.max() - load.min() <= 0.02 * load.mean()
    text = {i: t for i, t, _ in rows}
    shards = {}
    for r in out:
        shards.setdefault(text[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_a_group_larger_than_a_shard_is_split(documents):
    rows = [(i, "the same text in a third of all rows", "s") for i in range(1500)] + [(5000 + i, f"own {i}" * 6, "s") for i in range(3000)]
    out = bin_packing.pack_documents(documents(rows)).collect()
    load = checked(rows, out)
    assert load.max() - load.min() <= 0.05 * load.mean()


@pytest.mark.parametrize("doc_id", [7, None])
def test_repeated_rows_of_one_id_are_split(documents, doc_id):
    """Half of all rows are one row again and again, or have one text and no id."""
    rows = [(doc_id, "one text in half of all rows", "s")] * 1500 + [(5000 + i, f"own {i}" * 4, "s") for i in range(1500)]
    docs = documents(rows).repartition(7)
    out = bin_packing.pack_documents(docs).collect()
    load = checked(rows, out)
    assert load.max() - load.min() <= 0.05 * load.mean()
    again = bin_packing.pack_documents(docs.repartition(3)).collect()
    assert Counter((r.doc_id, r.shard, r.slot) for r in out) == Counter((r.doc_id, r.shard, r.slot) for r in again)


def test_lots_of_a_hot_id_are_small(spark, documents, monkeypatch):
    """No lot, which one task sorts, has more than a few times its share."""
    monkeypatch.setattr(bin_packing, "LOTS", 64)
    docs = documents([(1, "hot", "s")] * 3000 + [(i, f"text {i}", "s") for i in range(3000)])
    assert dict(bin_packing.pack_documents(docs).dtypes)["slot"] == "bigint"
    plan = bin_packing.packed(stored(bin_packing.sized(docs), "sized"))
    assert plan.groupBy("item", "part").count().agg({"count": "max"}).first()[0] < 4 * 6000 / 64


def test_placing_prefers_the_largest_dot_product():
    sizes = np.array([[10, 1, 1]] * 16 + [[1, 10, 1]] * 16 + [[1, 1, 10]] * 16, float)
    shards = bin_packing.place(sizes)
    loads = np.array([sizes[shards == s].sum(axis=0) for s in range(16)])
    assert (loads == 12).all()


def test_odd_rows_and_empty_tables(documents, odd_rows):
    docs = documents(odd_rows, clash=True)
    checked(odd_rows, bin_packing.pack_documents(docs).collect())
    assert bin_packing.pack_documents(docs.limit(0)).count() == 0
