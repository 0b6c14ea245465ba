import random

import numpy as np
import pytest

import corpus_pipeline
from tillwise.llm import text_overlap


def shingles(text):
    words = text.lower().split()
    width = min(5, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def kept_of_all(rows):
    """The smallest id of each component, by comparing all."""
    sets = [shingles(t) for _, t, _ in rows]
    root = [i for i, *_ in rows]
    changed = True
    while changed:
        changed = False
        for x, one in enumerate(sets):
            for y, other in enumerate(sets):
                if root[x] != root[y] and 5 * len(one & other) >= 4 * len(one | other):
                    root[x] = root[y] = min(root[x], root[y])
                    changed = True
    return sorted(set(root))


@pytest.fixture(scope="module")
def edited():
    """Texts with copies of one to many changed words, and a star: copies like the first text, less like each other."""
    rng = random.Random(3)
    texts = []
    for k in range(25):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([12, 60, 200]))]
        texts.append(words)
        for changes in (1, 2, 3, 5, 8) if k % 2 else ():
            copy = list(words)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
            texts.append(copy)
    base = [f"star{i}" for i in range(200)]
    star = [base] + [[*base[: 20 * i + 3], *(f"ray{i}x{j}" for j in range(12)), *base[20 * i + 15 :]] for i in range(9)]
    rows = [(i, " ".join(w), "s") for i, w in enumerate(texts + star)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block, shingles", [(2, 100), (text_overlap.BLOCK, text_overlap.BLOCK_SHINGLES)])
def test_stage_equals_comparing_all(spark, documents, edited, monkeypatch, block, shingles):
    """Also with groups cut into many blocks."""
    monkeypatch.setattr(text_overlap.overlap_links, "__defaults__", (block, shingles))
    kept = corpus_pipeline.keep_one_of_each(spark, documents(edited), "")
    expected = kept_of_all(edited)
    assert sorted(r.doc_id for r in kept.collect()) == expected and len(expected) < len(edited) - 20


def random_sets(rng):
    """Sets about a few centres, near the limit and far from it, some inside others."""
    sets = []
    for _ in range(rng.randrange(1, 5)):
        centre = rng.sample(range(10**6), rng.choice([5, 20, 60, 200]))
        for _ in range(rng.randrange(1, 12)):
            gone = rng.randrange(0, len(centre) // 4 + 1)
            own = set(rng.sample(centre, len(centre) - gone)) | {rng.randrange(10**6) for _ in range(rng.choice([0, 1, gone]))}
            sets.append(np.array(sorted(own), np.uint64))
    return sets


def test_forest_connects_what_overlaps():
    rng = random.Random(9)
    for _ in range(150):
        sets = random_sets(rng)
        links = list(text_overlap.forest(sets))
        assert all(text_overlap.overlap(sets[a], sets[b]) for a, b in links) and len(links) < len(sets)
        root = list(range(len(sets)))
        for a, b in links:
            root = [root[a] if r == root[b] else r for r in root]
        for a, one in enumerate(sets):
            for b, other in enumerate(sets):
                assert root[a] == root[b] or not text_overlap.overlap(one, other)


@pytest.mark.parametrize("n", [200, 400, 800])
def test_shared_passage_makes_no_pairs(n, monkeypatch):
    """Texts that share 60 of about 85 shingles: none is compared with another."""
    rng = random.Random(n)
    compared, real = [], text_overlap._linked
    monkeypatch.setattr(text_overlap, "_linked", lambda s, one, others: compared.extend(others) or real(s, one, others))
    sets = [np.array(sorted({*range(60), *(rng.randrange(100, 10**9) for _ in range(25))}), np.uint64) for _ in range(n)]
    assert list(text_overlap.forest(sets)) == [] and len(compared) < n // 10


def test_dense_group_costs_its_rows(monkeypatch):
    """Near copies of one text, all alike: about one comparison for each."""
    rng = random.Random(2)
    compared, real = [], text_overlap._linked
    monkeypatch.setattr(text_overlap, "_linked", lambda s, one, others: compared.extend(others) or real(s, one, others))
    sets = [np.array(sorted({*range(200)} - {rng.randrange(200)} | {rng.randrange(10**6, 10**9)}), np.uint64) for _ in range(600)]
    assert len(list(text_overlap.forest(sets))) == 599 and len(compared) < 1200


def test_passage_of_many_texts(spark, documents, monkeypatch):
    """The stage over 300 texts with one passage sends no link; repeated texts do not change that."""
    rng = random.Random(4)
    passage = " ".join(f"shared{i}" for i in range(64))
    rows = [(i, passage + " " + " ".join(f"own{rng.randrange(10**6)}" for _ in range(26)), "s") for i in range(300)]
    docs = documents([*rows, *[(500 + i, rows[0][1], "s") for i in range(100)]])
    prints = text_overlap.sketches(docs).cache()
    assert text_overlap.overlap_links(docs, prints).count() == 0
    assert text_overlap.overlap_dedup(docs).count() == 300


def test_exact_limit():
    one = np.arange(100, dtype=np.uint64)
    assert text_overlap.overlap(one[:80], one) and not text_overlap.overlap(one[:79], one)
    assert list(text_overlap.forest([one[:80], one])) and not list(text_overlap.forest([one[:79], one]))


def test_odd_rows(documents, odd_rows):
    docs = documents(odd_rows, clash=True)
    kept = text_overlap.overlap_dedup(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 7, 8] and ids.count(None) == 1
    assert text_overlap.overlap_dedup(docs.limit(0)).count() == 0


def test_columns_that_have_no_order(spark, documents, odd_rows):
    """Maps and binaries are kept; of rows repeated with other values one stays."""
    docs = documents(odd_rows).selectExpr("*", "map('k', doc_id) as tags", "cast(text as binary) as raw")
    docs = docs.unionByName(docs.filter("doc_id = 3").selectExpr("doc_id", "text", "lang", "source", "n_chars", "map('a', 1L) as tags", "raw"))
    kept = text_overlap.overlap_dedup(docs).collect()
    assert [r.tags for r in kept if r.doc_id == 3] == [{"a": 1}] and len(kept) == 6


def test_simhash_finds_links_of_the_stage(spark, documents, monkeypatch):
    """Long texts with one word changed are linked by their fingerprints alone; unlike sets of one fingerprint are not."""
    rng = random.Random(11)
    rows = []
    for k in range(30):
        words = [f"w{rng.randrange(9000)}" for _ in range(900)]
        rows.append((2 * k, " ".join(words), "s"))
        words[0] = "changed"
        rows.append((2 * k + 1, " ".join(words), "s"))
    docs = documents(rows)
    prints = text_overlap.sketches(docs).cache()
    node = {r.doc_id: r.fingerprint for r in prints.collect()}
    links = {frozenset((r.a, r.b)) for r in text_overlap.fingerprint_links(docs, prints).collect()}
    alike = {frozenset((node[2 * k], node[2 * k + 1])) for k in range(30)}
    assert links <= alike and len(links) > 24
    clash = prints.withColumn("simhash", prints["simhash"] * 0)
    assert {frozenset((r.a, r.b)) for r in text_overlap.fingerprint_links(docs, clash).collect()} <= alike
    # Without the other search the stage still drops what SimHash links.
    monkeypatch.setattr(text_overlap, "overlap_links", lambda docs, prints: spark.createDataFrame([], "a long, b long"))
    assert corpus_pipeline.keep_one_of_each(spark, docs, "").count() == 60 - len(links)
