import hashlib
import random
import re

import numpy as np
import pytest

from tillwise.llm import benchmark_search, queries
from tillwise.llm.benchmark_search import WINDOW

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORDS.findall(lowered)


def by_hand(docs, benchmark):
    """doc index -> number of words, hit places, items, comparing every window with every place."""
    windows = {}
    for item, text in benchmark:
        words = words_of(text)
        size = min(WINDOW, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    out = []
    for _, text in docs:
        words = words_of(text)
        hit, items = set(), set()
        for i in range(len(words)):
            for size in range(1, WINDOW + 1):
                own = windows.get(tuple(words[i : i + size])) if i + size <= len(words) else None
                if own:
                    hit |= set(range(i, i + size))
                    items |= own
        out.append((len(words), hit, items))
    return out


@pytest.fixture(scope="module")
def tables():
    """Items that share passages, short items, awkward signs; documents with whole, cut and changed passages."""
    rng = random.Random(5)
    word = lambda: rng.choice(["The", "of", "and", "Über", "naïve", "日本", "x1", "7", f"w{rng.randrange(60)}"])
    shared = [word() for _ in range(14)]
    benchmark = []
    for i in range(40):
        words = [word() for _ in range(rng.choice([4, 9, 10, 11, 25]))]
        benchmark.append((i, ", ".join(shared + words if i % 5 == 0 else words)))
    benchmark += [(3, "another row of item three with many words that nobody else has in it"), (50, None), (51, " .;! "), (None, "null id item words here")]
    docs = []
    for i in range(200):
        words = [word() for _ in range(rng.randrange(0, 300))]
        for _ in range(rng.randrange(3)):
            passage = words_of(rng.choice(benchmark)[1])
            at = rng.randrange(len(words) + 1)
            cut = rng.randrange(3)
            words[at:at] = [w.upper() if rng.random() < 0.2 and w.isascii() else w for w in passage[cut:]]
        docs.append((i, rng.choice([" ", "\n", "-", ". "]).join(words)))
    docs += [(900, None), (901, ""), (902, "--- ..."), (None, ", ".join(shared)), (903, benchmark[0][1]), (903, benchmark[0][1])]
    return docs, benchmark


@pytest.mark.parametrize("most", [benchmark_search.MOST_WINDOWS, 100])
def test_equals_comparing_everything(spark, tables, most):
    """Once with all windows at a time, once in several groups that are put together."""
    docs, benchmark = tables
    frames = [spark.createDataFrame(t, s) for t, s in ((docs, "doc_id long, text string"), (benchmark, "item_id long, text string"))]
    rows = benchmark_search.occurrences(*frames, most_windows=most).collect()
    found = sorted((repr(r.doc_id), r.n_words, sorted(x for s in r.spans for x in range(s.begin, s.end)), [repr(i) for i in r.items]) for r in rows)
    order = lambda s: [repr(i) for i in sorted(i for i in s if i is not None)] + ["None"] * (None in s)
    expected = sorted((repr(i), n, sorted(hit), order(items)) for (i, _), (n, hit, items) in zip(docs, by_hand(docs, benchmark), strict=True))
    assert found == expected
    assert all(a.end < b.begin for r in rows for a, b in zip(r.spans, r.spans[1:], strict=False))
    assert sum(bool(e[2]) for e in expected) > 50


def test_query_digests(spark, tables, tmp_path):
    docs, benchmark = tables
    for name, rows, kind in (("documents", docs, "doc_id long, text string"), ("benchmark", benchmark, "item_id long, text string")):
        spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    found = sorted(tuple(r) for r in queries.op13_benchmark(spark, str(tmp_path)).collect() if r.doc_id is not None)
    expected = []
    for (i, _), (n, hit, items) in zip(docs, by_hand(docs, benchmark), strict=True):
        ids = ",".join(sorted("" if x is None else str(x) for x in items))
        expected.append((i, n, len(hit), len(items), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    assert found == sorted(e for e in expected if e[0] is not None)


def test_shifts_skip_most_places():
    """In text without the windows' words a cursor reads one place of nine."""
    patterns = benchmark_search.Patterns(np.arange(1, 1001).reshape(100, 10))
    seen, real = [], benchmark_search._block_hash
    benchmark_search._block_hash = lambda words, ends, *a: seen.append(len(ends)) or real(words, ends, *a)
    try:
        assert len(patterns.search(np.zeros(100_000, np.int32))[0]) == 0
    finally:
        benchmark_search._block_hash = real
    assert sum(seen) < 100_000 / 9 * 1.2


def test_a_full_bucket_is_compared_whole():
    """Windows that share their first and last words all lie in one bucket."""
    words = np.array([[1, 2, *[3 + (k >> b & 1) for b in range(6)], 5, 6] for k in range(64)])
    begins, rows = benchmark_search.Patterns(words).search(words.reshape(-1))
    assert len(begins) == 64
    assert sorted(zip(begins.tolist(), rows.tolist(), strict=True)) == [(10 * k, k) for k in range(64)]


def test_odd_rows(spark, documents, odd_rows):
    benchmark = spark.createDataFrame([(1, "Alpha beta, GAMMA"), (2, "日本語")], "item_id long, text string")
    docs = documents(odd_rows, clash=True)
    rows = benchmark_search.occurrences(docs, benchmark).collect()
    assert len(rows) == len(odd_rows)
    hits = {r.doc_id: ([tuple(s) for s in r.spans], r.items) for r in rows if r.spans}
    assert hits == {1: ([(0, 3)], [1]), 2: ([(0, 3)], [1]), 8: ([(2, 3)], [2])}
    assert {r.n_words for r in rows if r.doc_id in (4, 5, 6)} == {0} and {r.n_words for r in rows if r.doc_id == 7} == {120_000}
    none = benchmark_search.occurrences(docs, benchmark.limit(0)).collect()
    assert len(none) == len(odd_rows) and not any(r.spans or r.items for r in none)
    assert benchmark_search.occurrences(docs.limit(0), benchmark).count() == 0
