import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tillwise.llm import periodic_runs, queries


def runs_of_all(words):
    """(start, length, period) by looking at every lag and every stretch."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        at = 0
        while at < n - q:
            end = at
            while end < n - q and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            if end > at and length >= max(6, 4 * q):
                stretch = words[at : at + length]
                if not any(all(stretch[t] == stretch[t + r] for t in range(length - r)) for r in range(1, q)):
                    found.append((at, length, q))
            at = max(end, at + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rng):
    """A text of a few letters with repeats inside repeats."""
    letters, words = rng.choice([1, 2, 3, 8]), []
    for _ in range(rng.randrange(0, 6)):
        part = [f"w{rng.randrange(letters)}" for _ in range(rng.randrange(1, 14))]
        words += (part * rng.randrange(1, 8))[: rng.randrange(1, 90)]
    return words * rng.randrange(1, 5) if rng.random() < 0.3 else words


def test_equals_looking_at_every_lag():
    rng = random.Random(1)
    for _ in range(400):
        texts = [repetitive(rng) for _ in range(rng.randrange(1, 6))]
        texts.append(texts[0])
        found = list(periodic_runs._results([" ".join(t).encode() for t in texts]))
        for words, (n, runs, top, text) in zip(texts, found, strict=True):
            assert n == len(words) and runs == runs_of_all(words) and text.decode() == collapsed(words, runs)
            best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
            assert top == best


def test_levels_leave_no_lag_out():
    lags = [q for low, high, _ in periodic_runs.levels(100_000) for q in range(low, high + 1)]
    assert lags[:25_000] == list(range(1, 25_001))
    for low, high, size in periodic_runs.levels(100_000):
        assert size >= 2 * high and all(periodic_runs.overlap(q) >= size for q in (low, high))


def test_long_periods_and_structured_words():
    """A period of thousands of words, and words without repeats of exponent three (Thue-Morse)."""
    period = [f"p{i}" for i in range(3000)]
    morse = ["ab"[bin(i).count("1") % 2] for i in range(4096)]
    text = " ".join(["x", *period * 4, "y", *morse, *["z"] * 9]).encode()
    runs = list(periodic_runs._results([text]))[0][1]
    assert runs == [(1, 12_000, 3000), (1 + 12_000 + 1 + 4096, 9, 1)]


def test_seeds_are_not_extended_again(monkeypatch):
    """One long run costs a constant number of extensions, however many seeds it has."""
    calls, real = [], periodic_runs._agreeing
    monkeypatch.setattr(periodic_runs, "_agreeing", lambda *a: calls.append(a) or real(*a))
    list(periodic_runs._results([b"a b c " * 20_000]))
    assert len(calls) <= 4


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_digests(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, " ".join(f"v{rng.randrange(500)}" for _ in range(rng.randrange(0, 300)))) for i in range(300)]
    rows += [(i, " \t".join(repetitive(rng))) for i in range(300, 400)] + [(400, None), (401, ""), (402, " \n"), (None, "a a a a a a b")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op12_runs(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    several = 0
    for i, text in rows:
        words = (text or "").split()
        words = planted(i, words) if i is not None else words
        runs, r = runs_of_all(words), found[i]
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r.n_runs == len(runs) and r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        several += len(runs) > 1
    assert several > 20


@pytest.mark.parametrize("size", [1, 1 << 20])
def test_odd_rows(documents, odd_rows, monkeypatch, size):
    monkeypatch.setattr(periodic_runs, "SLICE_BYTES", size)
    docs = documents([*odd_rows, (9, "no no no no no no yes", "a")], clash=True)
    found = periodic_runs.without_repeats(docs)
    assert found.columns == [*docs.columns, "n_words", "runs", "strongest", "collapsed"]
    rows = found.collect()
    assert len(rows) == len(odd_rows) + 1
    by_id = {r.doc_id: r for r in rows}
    assert by_id[9].collapsed == "no yes" and [tuple(x) for x in by_id[9].runs] == [(0, 6, 1)]
    assert by_id[4].collapsed == "" and by_id[4].n_words == 0 and by_id[4].strongest is None
    # The long text's 977 words repeat 122 times.
    assert by_id[7].n_words == 120_000 and [tuple(x) for x in by_id[7].runs] == [(0, 120_000, 977)]
    assert len(by_id[7].collapsed.split()) == 977
    assert periodic_runs.without_repeats(docs.limit(0)).count() == 0
    empty = periodic_runs.with_planted_repeats(docs.limit(0))
    assert empty.columns == docs.columns and empty.count() == 0


def test_documents_do_not_mix():
    """Equal passages of other documents never stand between the occurrences of one."""
    texts = [b"a b c d e f " * 5, b"a b c d e f " * 2, b"a b c d e f " * 5]
    found = list(periodic_runs._results(texts))
    assert [f[1] for f in found] == [[(0, 30, 6)], [], [(0, 30, 6)]]
    assert np.prod([len(f[3].split()) for f in found]) == 6 * 12 * 6
