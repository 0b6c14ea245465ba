"""Quality by ordinal cumulative-link regression.

Grades are ordered ratings.  All thresholds share one vector of weights over hashed text features:
P(grade >= k) = sigmoid(score + b_k) with b_1 > b_2 > ..., so the probabilities of the tails never
cross.  The expected grade and a tail probability select documents.

Features of a whole text: its words, the last three bytes of its words, and a few binned shares
(repetition, characters other than letters, word length), hashed to ``SLOTS`` weights.  The model
is fitted on at most ``TRAIN_ROWS`` labelled documents, taken by a hash of the id (one row of an id); only their
sparse features come to the driver, and only the weights (half a MB) go to the tasks.

Cases: a null text counts as empty and gets a score like any other; without labels the expected
grade is null and the tail probability 1, so that nothing is rejected; with one grade only, that
is the expected grade and the tail probability is 1; repeated rows get equal results; an
empty table gives an empty result; other columns are kept, those named like a result are replaced.
"""

import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tillwise.llm.labelled import one_text_each, sampled

SLOTS = 1 << 16
TRAIN_ROWS = 6_000
ROUNDS = 120
RATE = 0.08
RIDGE = 1e-5
#: Documents whose chance of the second grade or better is below this are rejected.
LEAST_TAIL = 0.5

_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)) + b" \t\n\r\x0b\x0c"


def _binned(name: str, share: float) -> bytes:
    return f"{name}{min(int(share * 20), 20)}".encode()


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text's features; a slot may come more than once."""
    raw = text or b""
    words = raw.lower().split()
    n = max(len(words), 1)
    counts = Counter(words)
    endings = Counter([w[-3:] for w in words])
    odd = len(raw.translate(None, _LETTERS)) / max(len(raw), 1)
    shape = [
        _binned("odd", min(odd * 3, 1.0)),
        _binned("different", len(counts) / n),
        _binned("most", max(counts.values(), default=0) / n),
        _binned("long", min(len(raw) / n / 20, 1.0)),
        _binned("size", min(len(words).bit_length() / 20, 1.0)),
        _binned("lines", min(raw.count(b"\n") / n, 1.0)),
    ]
    slots, values = [], []
    for kind, found in ((b"w", counts), (b"e", endings)):
        size = np.log1p(np.fromiter(found.values(), np.float64, len(found)))
        values.append(size / max(np.sqrt((size * size).sum()), 1e-12))
        salt = zlib.crc32(kind)
        slots += [zlib.crc32(w, salt) for w in found]
    slots += [zlib.crc32(s) for s in shape]
    values.append(np.full(len(shape), 0.5))
    return np.array(slots, np.int64) % SLOTS, np.concatenate(values)


@dataclass
class OrdinalModel:
    """``grades`` ascending; ``weights`` shared; ``offsets`` b_1 > b_2 > ... of the tails."""

    grades: list[int]
    weights: np.ndarray = field(repr=False)
    offsets: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray) -> OrdinalModel:
    """Maximum likelihood with a small ridge, by Adam on all rows at once."""
    levels = sorted(set(grades.tolist()))
    weights, k = np.zeros(SLOTS), len(levels) - 1
    if k < 1:
        return OrdinalModel(levels, weights, np.zeros(0))
    y = np.searchsorted(levels, grades)
    slots, values = (np.concatenate([r[i] for r in rows]) for i in (0, 1))
    sizes = np.array([len(r[0]) for r in rows])
    begins, row = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(rows)), sizes)
    shares = np.array([(y >= j + 1).mean() for j in range(k)])
    start = np.log(shares / (1 - shares))
    # b_1 is free, each next one is lower by exp of its own parameter.
    free = np.concatenate((start[:1], np.log(np.maximum(start[:-1] - start[1:], 1e-3))))
    point, n = np.concatenate((weights, free)), len(rows)
    mean, square = np.zeros_like(point), np.zeros_like(point)
    for step in range(1, ROUNDS + 1):
        weights, free = point[:SLOTS], point[SLOTS:]
        offsets = free[0] - np.concatenate(([0.0], np.cumsum(np.exp(free[1:]))))
        score = np.add.reduceat(weights[slots] * values, begins)
        tails = np.column_stack([np.ones(n), _sigmoid(score[:, None] + offsets), np.zeros(n)])
        here, above = tails[np.arange(n), y], tails[np.arange(n), y + 1]
        slope = -(1 - here - above) / n
        chance = np.maximum(here - above, 1e-9)
        by_offset = np.zeros(k)
        np.add.at(by_offset, (y - 1)[y > 0], (-(here * (1 - here)) / chance)[y > 0])
        np.add.at(by_offset, y[y < k], ((above * (1 - above)) / chance)[y < k])
        by_free = np.concatenate(([by_offset.sum()], -np.exp(free[1:]) * np.cumsum(by_offset[::-1])[::-1][1:])) / n
        gradient = np.concatenate((np.bincount(slots, values * slope[row], SLOTS) + RIDGE * weights, by_free))
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        point = point - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    free = point[SLOTS:]
    offsets = free[0] - np.concatenate(([0.0], np.cumsum(np.exp(free[1:]))))
    return OrdinalModel(levels, point[:SLOTS], offsets)


@F.arrow_udf(StructType([StructField("slots", BinaryType()), StructField("values", BinaryType())]))
def _packed_features(texts: pa.Array) -> pa.Array:
    found = [features(t) for t in texts.to_pylist()]
    columns = [[s.astype("<i4").tobytes() for s, _ in found], [v.astype("<f4").tobytes() for _, v in found]]
    return pa.StructArray.from_arrays([pa.array(c, pa.binary()) for c in columns], ["slots", "values"])


def train(docs: DataFrame, labels: DataFrame, grade: str = "quality", most: int = TRAIN_ROWS) -> OrdinalModel:
    """Fit on at most ``most`` labelled documents."""
    # At most ``most`` ids, so they may go to every task.
    chosen = sampled(labels, grade, most)
    rows = one_text_each(docs, chosen)
    # The same rows in the same order on every run, so that sums agree to the last digit.
    rows = rows.select("doc_id", F.col(grade).alias("grade"), _packed_features(F.col("text").cast("binary")).alias("f")).toPandas()
    rows["slots"] = [f["slots"] for f in rows["f"]]
    rows = rows.sort_values(["doc_id", "slots"], kind="stable")
    sparse = [(np.frombuffer(f["slots"], "<i4"), np.frombuffer(f["values"], "<f4")) for f in rows["f"]]
    return fit(sparse, rows["grade"].to_numpy(np.int64))


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tail_probability`` (of the second grade or better)."""
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        weights = shared.value
        found = [features(t) for t in texts.to_pylist()]
        return pa.array([float(weights[slots] @ values) for slots, values in found], pa.float64())

    # The document travels as one struct, so no name of its columns can clash.
    rows = docs.select(F.struct("*").alias("doc"), scores(F.col("text").cast("binary")).alias("raw"))
    expected, first = F.lit(None).cast("double"), F.lit(1.0)
    if model.grades:
        tails = [1 / (1 + F.exp(-(F.col("raw") + float(b)))) for b in model.offsets]
        first = tails[0] if tails else first
        expected = F.lit(float(model.grades[0]))
        for low, high, tail in zip(model.grades, model.grades[1:], tails, strict=False):
            expected = expected + tail * float(high - low)
    results = {"expected_grade": expected, "tail_probability": first}
    own = [F.col("doc")[c].alias(c) for c in docs.columns if c.lower() not in results]
    return rows.select(*own, *[e.alias(n) for n, e in results.items()])


def accepted(docs: DataFrame, labels: DataFrame, least_tail: float = LEAST_TAIL) -> DataFrame:
    """The documents that are kept, with their own columns."""
    packed = docs.select(F.struct("*").alias("doc"), "text")
    kept = score(packed, train(docs, labels)).filter(F.col("tail_probability") >= least_tail)
    return kept.select("doc.*")
