"""Benchmark passages in documents by Wu-Manber multi-pattern search on words.

Test strings are windows of ``WINDOW`` consecutive words of a benchmark item; an item of fewer words is one window.
Words are numbered by the windows' vocabulary (0 for all others) and windows of one length are searched together.  A
table by the hash of a block of ``BLOCK`` words tells how far a window's end may be shifted from here without missing
one; where the shift is 0, the buckets of the last block (suffix) and first block (prefix) select windows, and
comparing all words confirms them.  The cursors of many stretches of text move in step, as numpy arrays.

Windows are made on Spark and kept once for each item.  Groups of at most about ``MOST_WINDOWS`` are searched at a
time: each is all that comes to the driver and is broadcast at once.  A larger benchmark has more groups, every one
searched in all documents, and a document's spans and items are put together again on its id and text.

Cases: null texts have no words; null and repeated item ids: rows with one id are one item, null is an id like any
other; texts without words have no window and are never hit; empty tables give no hits or no rows; repeated rows of
``docs`` are rows of their own; other columns are not part of the result.
"""

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tillwise.llm.tables import text_key
from tillwise.sources.workspace import stored

WINDOW = 10
BLOCK = 2
MOST_WINDOWS = 250_000
#: Words that one cursor goes over.
STRETCH = 128
#: Bytes of text that are worked on at once (a longer text alone).
SLICE_BYTES = 4 << 20
SPAN = StructType([StructField("begin", LongType()), StructField("end", LongType())])
FOUND = "doc_id long, doc_key string, n_words long, spans array<struct<begin:bigint,end:bigint>>, items array<bigint>"

#: Letters A-Z in lower case; digits, a-z and all bytes of other scripts as they are; the rest separates words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD_BYTES).split()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = words_of(text)
            size = min(WINDOW, len(words))
            for at in range(0, len(words) - size + 1 if words else 0, 8192):
                last = min(at + 8192, len(words) - size + 1)
                joined = [b" ".join(words[i : i + size]).decode() for i in range(at, last)]
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(joined), pa.int64()), pa.array(joined)], ["item_id", "window"])


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id and window, each pair once."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_windows, "item_id long, window string").distinct()


def _block_hash(words: np.ndarray, ends: np.ndarray, width: int, bits: int) -> np.ndarray:
    """A number below 2^bits for the ``width`` words that end at each of ``ends``."""
    mixed = np.zeros(len(ends), np.uint64)
    for k in range(width):
        mixed += words[ends - k].astype(np.uint64) * _FACTORS[k]
    return ((mixed * _FACTORS[0]) >> np.uint64(64 - bits)).astype(np.int64)


class Patterns:
    """Windows of one length: shifts, buckets and the windows' words and items."""

    def __init__(self, words: np.ndarray) -> None:
        """``words``: a row of word numbers for each window."""
        n, self.length = words.shape
        self.width = min(BLOCK, self.length)
        self.bits = max(12, int(n * self.length).bit_length() + 2)
        flat = words.reshape(-1)
        row = np.arange(n) * self.length
        self.shift = np.full(1 << self.bits, self.length - self.width + 1, np.int16)
        for end in range(self.length - 1, self.width - 2, -1):
            np.minimum.at(self.shift, _block_hash(flat, row + end, self.width, self.bits), self.length - 1 - end)
        keys = self._bucket(flat, row + self.length - 1)
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.words = keys[self.order], words[self.order]

    def _bucket(self, words: np.ndarray, ends: np.ndarray) -> np.ndarray:
        prefix = _block_hash(words, ends - self.length + self.width, self.width, self.bits)
        return _block_hash(words, ends, self.width, self.bits) << self.bits | prefix

    def search(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and window of every occurrence."""
        at = np.arange(self.length - 1, len(words), STRETCH)
        stop = np.minimum(at + STRETCH, len(words))
        ends = []
        while len(at):
            shift = self.shift[_block_hash(words, at, self.width, self.bits)]
            ends.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            inside = at < stop
            at, stop = at[inside], stop[inside]
        ends = np.concatenate(ends) if ends else np.empty(0, np.int64)
        keys = self._bucket(words, ends)
        low, high = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, side="right")
        begins, rows = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        # A few thousand candidates at a time, however full a bucket is.
        left = np.flatnonzero(high > low)
        while len(left):
            for i in range(0, len(left), 4096):
                some = left[i : i + 4096]
                begin = ends[some] - self.length + 1
                same = np.ones(len(some), bool)
                for k in range(self.length):
                    same &= words[begin + k] == self.words[low[some], k]
                begins.append(begin[same])
                rows.append(self.order[low[some][same]])
            low[left] += 1
            left = left[low[left] < high[left]]
        return np.concatenate(begins), np.concatenate(rows)


def tables(pairs: pd.DataFrame) -> dict:
    """What to broadcast for rows of item_id and window."""
    vocabulary: dict[bytes, int] = {}
    lengths: dict[int, dict] = {}
    items: dict[str, list] = {}
    for item, window in zip(pairs["item_id"], pairs["window"], strict=True):
        items.setdefault(window, []).append(None if pd.isna(item) else int(item))
    for window, own in sorted(items.items()):
        numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in window.encode().split(b" ")]
        group = lengths.setdefault(len(numbers), {"words": [], "items": []})
        group["words"].append(numbers)
        group["items"].append(own)
    groups = []
    for _, group in sorted(lengths.items()):
        groups.append((vars(Patterns(np.array(group["words"], np.int32))), group["items"]))
    return {"vocabulary": vocabulary, "groups": groups}


def _restored(values: dict) -> Patterns:
    made = Patterns.__new__(Patterns)
    vars(made).update(values)
    return made


def find(texts: list[bytes | None], known: dict) -> Iterator[tuple[int, list[tuple[int, int]], list]]:
    """Number of words, hit spans (merged) and items of each text."""
    numbers, sizes = [], []
    lookup = known["vocabulary"].get
    for text in texts:
        words = words_of(text)
        sizes.append(len(words))
        numbers.append(np.fromiter(map(lookup, words, repeat(0)), np.int32, len(words)))
        # No window reaches over a word that it does not hold.
        numbers.append(np.zeros(1, np.int32))
    flat = np.concatenate(numbers) if numbers else np.empty(0, np.int32)
    begins = np.concatenate(([0], np.cumsum(np.array(sizes, np.int64) + 1)))
    edges = np.zeros(len(flat) + 1, np.int64)
    items: dict[int, set] = {}
    for values, owners in known["groups"]:
        at, window = _restored(values).search(flat)
        edges += np.bincount(at, minlength=len(edges)) - np.bincount(at + values["length"], minlength=len(edges))
        text = np.searchsorted(begins, at, side="right") - 1
        for t, w in sorted(set(zip(text.tolist(), window.tolist(), strict=True))):
            items.setdefault(t, set()).update(owners[w])
    hit = np.concatenate(([0], (np.cumsum(edges) > 0).astype(np.int8)))
    turns = np.flatnonzero(np.diff(hit))
    firsts, lasts = turns[::2], turns[1::2]
    own = np.searchsorted(firsts, begins)
    for k, size in enumerate(sizes):
        i, j, b = own[k], own[k + 1], int(begins[k])
        spans = [(x - b, y - b) for x, y in zip(firsts[i:j].tolist(), lasts[i:j].tolist(), strict=True)]
        found = items.get(k, ())
        yield size, spans, sorted(x for x in found if x is not None) + [None] * (None in found)


def _lists(values: list[list], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array([x for v in values for x in v], kind))


def _group_found(docs: DataFrame, known: Broadcast) -> DataFrame:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = np.flatnonzero(np.diff(sizes // SLICE_BYTES)) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)], strict=True):
                if j == i:
                    continue
                part = batch.slice(i, j - i)
                n, spans, items = zip(*find(part.column(2).to_pylist(), known.value), strict=True)
                spans = _lists([[{"begin": b, "end": e} for b, e in s] for s in spans], span)
                columns = [part.column(0), part.column(1), pa.array(n, pa.int64()), spans, _lists(list(items), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "doc_key", "n_words", "spans", "items"])

    rows = docs.select(F.col("doc_id").cast("long"), text_key(F.col("text")).alias("doc_key"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(found, FOUND)


@F.arrow_udf(ArrayType(SPAN))
def _united(spans: pa.Array) -> pa.Array:
    """Spans that overlap or touch become one."""
    out = []
    for row in spans.to_pylist():
        own: list[dict] = []
        for span in sorted(row, key=lambda s: (s["begin"], s["end"])):
            if own and span["begin"] <= own[-1]["end"]:
                own[-1]["end"] = max(own[-1]["end"], span["end"])
            else:
                own.append(dict(span))
        out.append(own)
    return pa.array(out, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))


def occurrences(docs: DataFrame, benchmark: DataFrame, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """doc_id, n_words, spans (begin and end of hit words, ascending, apart) and items (ascending, null last) of every document."""
    windows = stored(item_windows(benchmark), "benchmark-windows")
    n_groups = max(1, -(-windows.count() // most_windows))
    group = F.pmod(F.xxhash64("item_id", "window"), F.lit(n_groups))
    context, found = docs.sparkSession.sparkContext, []
    for k in range(n_groups):
        # About ``most_windows`` rows: pairs are distinct and the hash deals them evenly.
        pairs = windows.filter(group == k).toPandas()
        rows = _group_found(docs, context.broadcast(tables(pairs)))
        found.append(rows if n_groups == 1 else stored(rows, "benchmark-hits"))
    if n_groups == 1:
        return found[0].drop("doc_key")
    document = ["doc_id", "doc_key", "n_words"]
    # Equal rows have equal results in each group; they are counted, so that all come back.
    once = [r.groupBy(*document).agg(F.count(F.lit(1)).alias("n"), F.first("spans").alias("spans"), F.first("items").alias("items")) for r in found]
    each = once[0]
    for other in once[1:]:
        each = each.unionByName(other)
    whole = each.groupBy(*document).agg(
        F.max("n").alias("n"), F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items")
    )
    items = F.sort_array(F.array_distinct(F.filter("items", lambda i: i.isNotNull())))
    lost = F.when(F.exists("items", lambda i: i.isNull()), F.array(F.lit(None).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    whole = whole.select("doc_id", "n_words", _united("spans").alias("spans"), F.concat(items, lost).alias("items"), "n")
    repeated = whole.select("*", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy"))
    return repeated.select("doc_id", "n_words", "spans", "items")
