import random
import re

import numpy as np
import pytest
import xxhash

from tillwise.llm import simhash
from tillwise.llm.components import components


def slow_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, bits=4):
    """Smallest value of each component, by comparing all."""
    root = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for a in values:
            for b in values:
                if bin(a ^ b).count("1") <= bits and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "a B c", "x y z w", "Éa b\x0bc\x1cd e  f", "w " * 200_000])
def test_fingerprint(text):
    raw = None if text is None else text.encode()
    assert simhash.fingerprint(raw) % 2**64 == slow_fingerprint(text)


@pytest.mark.parametrize("block", [simhash.BLOCK, 3])
def test_links_connect_all_that_are_near(spark, block):
    rng = random.Random(5)
    values = {0, 2**64 - 1}
    for _ in range(60):
        base = rng.getrandbits(64)
        values.add(base)
        for _ in range(rng.choice([0, 1, 4])):
            values.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 4, 5]))))
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    table = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    found = {r.node: r.root for r in components(simhash.near_links(table, block)).collect()}
    groups = {}
    for v, s in zip(values, signed, strict=True):
        groups.setdefault(found.get(s, s), set()).add(v)
    expected = {}
    for v, r in roots(sorted(values)).items():
        expected.setdefault(r, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_every_pair_within_the_bits_passes_a_chain():
    rng = random.Random(1)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << p for p in rng.sample(range(64), 4))
        passes = [len(simhash._linked(np.uint64(a), np.array([b], np.uint64), s)) for s in range(simhash.SEGMENTS)]
        assert any(passes)
        far = b ^ (1 << next(p for p in range(64) if not (a ^ b) >> p & 1))
        assert not any(len(simhash._linked(np.uint64(a), np.array([far], np.uint64), s)) for s in range(simhash.SEGMENTS))


def test_components_of_long_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1040)] + [(5, 5), (7, None)]
    found = {r.node: r.root for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1040)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_classes_of_odd_rows(documents, odd_rows):
    found = simhash.classes(simhash.fingerprints(documents(odd_rows, clash=True))).collect()
    assert len(found) == len(odd_rows)
    component = {r.doc_id: r.component_id for r in found if r.doc_id is not None}
    assert component[2] == 1 and component[3] == 3
    assert component[4] == component[5] == component[6] == 4
    assert all(r.fingerprint % 2**64 == 0 for r in found if r.doc_id in (4, 5, 6))


def test_one_document_of_each_group_stays(documents, odd_rows):
    docs = documents(odd_rows, clash=True)
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 7, 8] and ids.count(None) == 1
    assert simhash.near_dedup(docs.limit(0)).count() == 0
