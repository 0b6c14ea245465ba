"""Runs of repeated words: maximal stretches with a period, found by seed and extend on diagonals.

A run of smallest period q has at least ``max(LEAST_WORDS, LEAST_EXPONENT * q)`` words.  On the diagonal of lag q
(word i beside word i + q) it is an unbroken stretch of matches that many less q.  Lags are dealt into levels; a
level's k-grams are as long as the stretch that its smallest lag guarantees, so every run has one, at both ends of
its lag.  Levels are so narrow that k is twice their largest lag at least: then no third occurrence of the k-gram lies
between i and i + q (it would give the run a smaller period), and neighbouring occurrences inside a document are all the
pairs that are needed.  Their number is linear in the text however often a word comes again.

A seed (i, i + q) is extended both ways by comparing words; a table with the furthest position that is covered on
each lag suppresses seeds of a stretch already extended.  Grams that do not come again inside their document end
there: a longer gram can only come again where its parts do, so each level looks at what the level before left.

Words are those of ``tables.WORD``.  The grams' names are 64-bit mixes, only for finding seeds; the seeds are compared.

Cases: null and empty texts, and texts of white space, have no words and no runs; the collapsed text of a null is
empty; very long texts are worked on alone, whole; repeated rows get equal results; an empty table gives an empty
result; other columns are kept, those named like a result are replaced.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tillwise.llm.tables import WORD

LEAST_WORDS = 6
LEAST_EXPONENT = 4
#: Bytes of text that are worked on at once (a longer text alone).
SLICE_BYTES = 2 << 20
#: What one run is; the column ``runs`` has them by start, then period.
RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])
RESULT = StructType().add("n_words", LongType()).add("runs", ArrayType(RUN)).add("strongest", RUN).add("collapsed", StringType())

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def overlap(lag: int) -> int:
    """Matches in a row that a run of this smallest period has on its diagonal at least."""
    return max(LEAST_WORDS, LEAST_EXPONENT * lag) - lag


def levels(n_words: int) -> Iterator[tuple[int, int, int]]:
    """Smallest lag, largest lag and gram length of each level that a text of ``n_words`` can need."""
    low = 1
    while LEAST_EXPONENT * low <= n_words and low + overlap(low) <= n_words:
        size = overlap(low)
        high = max(low, size // 2)
        yield low, high, size
        low = high + 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


def _gram_names(letters: np.ndarray, size: int) -> np.ndarray:
    """A name for each gram of ``size`` letters; a name of twice the length is a mix of two."""
    names, width = letters, 1
    while width * 2 <= size:
        names = _mixed(names[:-width] * _ODD[0] + (names[width:] ^ (names[width:] >> np.uint64(31))) * _ODD[2])
        width *= 2
    rest = size - width
    return _mixed(names[: len(names) - rest] * _ODD[0] + names[rest:] * _ODD[2]) if rest else names


def _agreeing(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from ``at`` on, forwards or backwards (``step`` 1 or -1), equal those ``lag`` further."""
    found, size = 0, 32
    while True:
        if step > 0:
            one, other = words[at + found : at + found + size], words[at + found + lag : at + found + lag + size]
            one = one[: len(other)]
        else:
            end = at + 1 - found
            begin = max(end - size, 0)
            one, other = words[begin:end][::-1], words[begin + lag : end + lag][::-1]
        differ = one != other
        if not len(differ):
            return found
        first = int(differ.argmax())
        if differ[first]:
            return found + first
        found, size = found + len(differ), size * 2


def find_runs(words: np.ndarray, owner: np.ndarray) -> list[tuple[int, int, int]]:
    """(first word, length, period) of all runs, by first word, then period.

    ``words`` holds numbers that stand for the words of several documents, each document closed by a number of its
    own that nothing equals; ``owner`` is the document of each place, ascending.
    """
    if not len(words):
        return []
    longest = int(np.bincount(owner).max()) - 1
    # Equal words of two documents get different names, so occurrences in others never come between.
    letters = _mixed((words.astype(np.uint64) + np.uint64(1)) * _ODD[0] + _mixed((owner.astype(np.uint64) + np.uint64(1)) * _ODD[2]))
    place = np.arange(len(words))
    found, covered = [], {}
    for low, high, size in levels(longest):
        if len(place) < size:
            break
        names = _gram_names(letters, size)
        whole = np.flatnonzero(place[size - 1 :] - place[: len(place) - size + 1] == size - 1)
        order = whole[np.argsort(names[whole], kind="stable")]
        named = names[order]
        same = named[1:] == named[:-1]
        lag = place[order[1:]] - place[order[:-1]]
        seeds = np.flatnonzero(same & (lag >= low) & (lag <= high))
        lags, starts = lag[seeds], place[order[seeds]]
        in_turn = np.lexsort((starts, lags))
        lags, starts = lags[in_turn], starts[in_turn]
        # Seeds one after another on a lag are one stretch; its first is enough.
        first = np.ones(len(lags), bool)
        first[1:] = (np.diff(lags) != 0) | (np.diff(starts) != 1)
        for q, i in zip(lags[first].tolist(), starts[first].tolist(), strict=True):
            if i < covered.get(q, 0):
                continue
            begin = i - _agreeing(words, i - 1, q, -1) if i else 0
            end = i + _agreeing(words, i, q, 1)
            covered[q] = max(end, i + 1)
            length = end - begin + q
            if end > i and length >= max(LEAST_WORDS, LEAST_EXPONENT * q):
                found.append((begin, length, q))
        # Only where this gram comes again can a longer one.
        again = np.zeros(len(order), bool)
        again[1:] |= same
        again[:-1] |= same
        edges = np.zeros(len(place) + 1, np.int32)
        edges[order[again]] = 1
        ends = np.zeros(len(place) + 1, np.int32)
        ends[order[again] + size] = 1
        kept = np.cumsum(edges[:-1] - ends[:-1]) > 0
        letters, place = letters[kept], place[kept]
    return in_order(found)


def in_order(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    return sorted(runs, key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; of equals the first start, then the smallest period."""
    best = None
    for run in in_order(runs):
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_BYTES)) + 1
    yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)], strict=True)


def _results(texts: list[bytes | None]) -> Iterator[tuple[int, list, tuple | None, bytes]]:
    """Number of words, runs, strongest run and collapsed text of each text."""
    split = [(t or b"").split() for t in texts]
    flat: list[bytes | None] = []
    for words in split:
        flat += words
        flat.append(None)
    coded = pa.array(flat, pa.binary()).dictionary_encode()
    numbers = coded.indices.fill_null(-1).to_numpy().astype(np.int64)
    del flat, coded
    sizes = np.array([len(w) + 1 for w in split])
    begins = np.cumsum(sizes) - sizes
    ends = begins + sizes - 1
    numbers[ends] = numbers.max(initial=0) + 1 + np.arange(len(split))
    runs = find_runs(numbers, np.repeat(np.arange(len(split)), sizes))
    edges = np.zeros(len(numbers) + 1, np.int64)
    for begin, length, period in runs:
        edges[begin + period] += 1
        edges[begin + length] -= 1
    dropped = np.cumsum(edges) > 0
    owners = np.searchsorted(begins, [r[0] for r in runs], side="right") - 1
    by_text: dict[int, list] = {}
    for own, (begin, length, period) in zip(owners.tolist(), runs, strict=True):
        by_text.setdefault(own, []).append((begin - int(begins[own]), length, period))
    for k, words in enumerate(split):
        own = in_order(by_text.get(k, []))
        if own:
            gone = dropped[begins[k] : ends[k]]
            words = [words[i] for i in np.flatnonzero(~gone).tolist()]
        yield int(sizes[k]) - 1, own, strongest(own), b" ".join(words)


def runs_of(text: Column) -> Column:
    """Struct of n_words, runs, strongest and collapsed of a text."""
    return _runs(text.cast("binary"))


@F.arrow_udf(RESULT)
def _runs(texts: pa.Array) -> pa.Array:
    kind = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
    parts = []
    for i, j in _slices(texts):
        sizes, counts, flat, best, collapsed = [], [], [], [], []
        for n, runs, top, text in _results(texts.slice(i, j - i).to_pylist()):
            sizes.append(n)
            counts.append(len(runs))
            flat += runs
            best.append(top and dict(zip(("start", "length", "period"), top, strict=True)))
            collapsed.append(text)
        columns = [pa.array(c, pa.int64()) for c in zip(*flat, strict=True)] or [pa.array([], pa.int64())] * 3
        offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, fields=list(kind)))
        texts_out = pa.array(collapsed, pa.binary()).cast(pa.string())
        columns = [pa.array(sizes, pa.int64()), lists, pa.array(best, kind), texts_out]
        parts.append(pa.StructArray.from_arrays(columns, ["n_words", "runs", "strongest", "collapsed"]))
    return pa.concat_arrays(parts)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, runs, strongest (run) and collapsed (the text without the words that repeat)."""
    # The document travels as one struct, so no name of its columns can clash.
    rows = docs.select(F.struct("*").alias("doc"), runs_of(F.col("text")).alias("found"))
    names = ("n_words", "runs", "strongest", "collapsed")
    own = [F.col("doc")[c].alias(c) for c in docs.columns if c.lower() not in names]
    return rows.select(*own, *[F.col(f"found.{n}").alias(n) for n in names])


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with texts in which the documents that a checksum of the id chooses repeat some of their words.

    With h the crc32 of the decimal id, g = h div 10, n words and h mod 10 = 0: from word a = g mod n on, the first
    p = 1 + (n - a) div (3 + g mod 8) words from there repeat.  Null ids and texts without words stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    packed = docs.select(
        F.struct("*").alias("doc"),
        F.when(chosen, F.regexp_extract_all("text", F.lit(f"({WORD})"), 1)).alias("words"),
        F.floor(h / 10).alias("g"),
    )
    n, a, p = F.size("words"), F.col("a"), F.col("p")
    rows = packed.withColumn("a", (F.col("g") % F.greatest(n, F.lit(1))).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int"))
    part = F.slice("words", a + 1, p)
    repeats = F.flatten(F.array_repeat(part, F.ceil((n - a) / p).cast("int")))
    repeated = F.slice(F.concat(F.slice("words", F.lit(1), a), repeats), F.lit(1), n)
    text = F.when(F.coalesce(n > 0, F.lit(False)), F.array_join(repeated, " ")).otherwise(F.col("doc.text"))
    return rows.select(*[(text if c.lower() == "text" else F.col("doc")[c]).alias(c) for c in docs.columns])
