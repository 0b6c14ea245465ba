"""Toxicity by a convolutional text classifier, trained in Spark tasks with numpy.

Words and their first ``STEM`` letters are hashed to ``SLOTS`` embeddings, which are added.  Filters of several widths slide over the whole text,
the largest response of each filter is kept (max pooling), and one linear layer gives the
logit.  As a filter is a sum over its words, each word's share of every filter is one table row,
so a long text is gathered rows, shifted sums and a maximum, in pieces of ``CHUNK`` words.

The model is fitted on all labelled documents (one row of an id).  They are dealt to replicas of about ``ROWS``; in
each pass every replica starts from the common model, and the changes of each parameter are averaged over the replicas that
changed it.  Every fifth labelled document is set aside to scale the logits (so that 0.5 fits the shares of the classes)
and to choose a threshold for each language.  Language, source and id are never inputs.

Cases: null and empty texts are scored as texts without words; without labels of both classes
every score is the share of the known class (0 without any labels); languages with fewer than
``LEAST_KNOWN`` toxic examples, null and unknown languages use 0.5; repeated rows get equal
results; an empty table gives an empty result; other columns are not returned.
"""

import zlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tillwise.llm.labelled import fold, one_text_each
from tillwise.sources.workspace import stored

SLOTS = 1 << 15
SIZE = 12
STEM = 4
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Documents of a replica, and the most replicas; beyond both a replica has more documents.
ROWS = 4_000
REPLICAS = 256
#: Passes over few documents, and the least for many; between them as many as make ``STEPS``.
EPOCHS = 8
LEAST_EPOCHS = 3
STEPS = 20_000
#: Slots whose changes are averaged in one group.
BLOCK = 1_024
#: Steps of the score at which thresholds may lie.
GRID = 4_096
RATE = 0.05
CHUNK = 200_000
HELD_FOLD = 0
LEAST_KNOWN = 20


def _slots(word: str) -> tuple[int, int]:
    """Of the word and of its beginning, which inflected and compound forms share."""
    if not word:
        return 0, 0
    half = SLOTS // 2
    return zlib.crc32(word.encode()) % (half - 1) + 1, half + zlib.crc32(word[:STEM].encode()) % half


def word_slots(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Slots (two rows) of the words of all texts one after another, and where each text begins.

    Words are runs of letters and digits.  Slot 0 stands for no word; each text ends with as many
    of them as a filter may reach beyond it.
    """
    plain = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts, "")), "[^\\pL\\pN]+", " ")
    words = pc.split_pattern(plain, " ")
    flat, offsets = words.flatten(), words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py()
    coded = flat.dictionary_encode()
    table = np.array([_slots(w) for w in coded.dictionary.to_pylist()], np.int32).reshape(-1, 2)
    known = table[coded.indices.to_numpy()] if len(flat) else table
    pad = max(WIDTHS)
    begins = offsets + pad * np.arange(len(offsets))
    padded = np.zeros((2, begins[-1]), np.int32)
    where = np.arange(len(known)) + pad * np.repeat(np.arange(len(texts)), np.diff(offsets))
    padded[:, where] = known.T
    return padded, begins


@dataclass
class ToxicModel:
    embedding: np.ndarray = field(repr=False)
    #: One matrix (width * SIZE, FILTERS) for each width.
    filters: list[np.ndarray] = field(repr=False)
    bias: np.ndarray = field(repr=False)
    top: np.ndarray = field(repr=False)
    intercept: float
    #: Score = sigmoid(scale[0] * logit + scale[1]).
    scale: tuple[float, float] = (1.0, 0.0)

    def shares(self) -> list[list[np.ndarray]]:
        """By width and place in the filter: every slot's contribution."""
        parts = [[w[i * SIZE : (i + 1) * SIZE] for i in range(len(w) // SIZE)] for w in self.filters]
        return [[np.ascontiguousarray(self.embedding @ p, np.float32) for p in own] for own in parts]

    def logits(self, padded: np.ndarray, begins: np.ndarray, shares: list[list[np.ndarray]]) -> np.ndarray:
        n, size = len(begins) - 1, padded.shape[1]
        pooled = np.full((n, FILTERS * len(WIDTHS)), -np.inf, np.float32)
        reach = max(WIDTHS) - 1
        # Windows start at every place but the last ``reach`` of a text, so none leaves its text.
        for low in range(0, size, CHUNK):
            high = min(low + CHUNK, size)
            part = padded[:, low : high + reach]
            part = np.pad(part, ((0, 0), (0, high - low + reach - part.shape[1])))
            first = np.searchsorted(begins, low, "right") - 1
            last = np.searchsorted(begins, high, "left")
            starts = np.maximum(begins[first:last], low) - low
            blocked = np.zeros(high - low, bool)
            for back in range(1, reach + 1):
                ends = begins[1:] - back
                blocked[ends[(ends >= low) & (ends < high)] - low] = True
            for k, own in enumerate(shares):
                response = np.zeros((high - low, FILTERS), np.float32)
                for i, share in enumerate(own):
                    for row in part:
                        response += share[row[i : i + high - low]]
                response[blocked] = -np.inf
                best = np.maximum.reduceat(response, starts, axis=0)
                columns = slice(k * FILTERS, (k + 1) * FILTERS)
                pooled[first:last, columns] = np.maximum(pooled[first:last, columns], best)
        return np.maximum(pooled + self.bias, 0) @ self.top + self.intercept

    def scores(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * logits + self.scale[1], -40, 40)))


def _windows(vectors: np.ndarray, width: int) -> np.ndarray:
    n = len(vectors) - max(WIDTHS) + 1
    return np.concatenate([vectors[i : i + n] for i in range(width)], axis=1)


@dataclass
class Fitting:
    """Parameters and their Adagrad sums: one row a slot, and all filters, biases and the last layer."""

    embedding: np.ndarray
    sums: np.ndarray
    dense: np.ndarray
    dense_sums: np.ndarray

    @classmethod
    def start(cls, seed: int = 7) -> "Fitting":
        rng = np.random.default_rng(seed)
        n_filters = FILTERS * len(WIDTHS)
        embedding = rng.normal(0, 0.1, (SLOTS, SIZE)).astype(np.float32)
        filters = [rng.normal(0, 0.3, w * SIZE * FILTERS) for w in WIDTHS]
        dense = np.concatenate([*filters, np.zeros(n_filters), rng.normal(0, 0.3, n_filters), [0.0]]).astype(np.float32)
        return cls(embedding, np.full_like(embedding, 1e-2), dense, np.full_like(dense, 1e-2))

    @staticmethod
    def views(dense: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """Filters by width, biases, last layer and intercept (one entry) inside ``dense``."""
        ends = np.cumsum([*(w * SIZE * FILTERS for w in WIDTHS), FILTERS * len(WIDTHS), FILTERS * len(WIDTHS), 1])
        *filters, bias, top, intercept = np.split(dense, ends[:-1])
        return [f.reshape(-1, FILTERS) for f in filters], bias, top, intercept

    def model(self) -> ToxicModel:
        filters, bias, top, intercept = self.views(self.dense)
        return ToxicModel(self.embedding, filters, bias, top, float(intercept[0]))

    def blocks(self) -> list[np.ndarray]:
        """Parameters beside their sums, ``BLOCK`` slots each; the last block is that of the dense ones, one row each."""
        rows = np.concatenate((self.embedding, self.sums), axis=1)
        return [*(rows[i : i + BLOCK] for i in range(0, SLOTS, BLOCK)), np.stack((self.dense, self.dense_sums), axis=1)]

    def moved(self, changes: dict[int, np.ndarray]) -> "Fitting":
        rows = [own + changes[i] if i in changes else own for i, own in enumerate(self.blocks())]
        slots, dense = np.concatenate(rows[:-1]), rows[-1]
        return Fitting(*(np.ascontiguousarray(x) for x in (slots[:, :SIZE], slots[:, SIZE:], dense[:, 0], dense[:, 1])))


def descend(at: Fitting, texts: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, order: Iterable[int]) -> None:
    """Adagrad on one text at a time, in place; only the places that win the pooling get gradients.

    ``texts``: padded slots of each.
    """
    n_filters = FILTERS * len(WIDTHS)
    embedding, sums = at.embedding, at.sums
    filters, bias, top, intercept = at.views(at.dense)
    filter_sums, sum_bias, sum_top, sum_intercept = at.views(at.dense_sums)
    for d in order:
        slots = texts[d]
        vectors = embedding[slots].sum(axis=0)
        pooled, wins = np.empty(n_filters, np.float32), []
        for k, w in enumerate(WIDTHS):
            response = _windows(vectors, w) @ filters[k]
            place = response.argmax(axis=0)
            wins.append(place)
            pooled[k * FILTERS : (k + 1) * FILTERS] = response[place, np.arange(FILTERS)]
        hidden = np.maximum(pooled + bias, 0)
        chance = 1 / (1 + np.exp(-np.clip(hidden @ top + intercept[0], -40, 40)))
        error = np.float32((chance - toxic[d]) * weight[d])
        if abs(error) < 1e-3:
            continue
        back = error * top * (hidden > 0)
        grad_top = error * hidden
        sum_top += grad_top**2
        top -= RATE * grad_top / np.sqrt(sum_top)
        sum_intercept += error**2
        intercept -= RATE * error / np.sqrt(sum_intercept)
        sum_bias += back**2
        bias -= RATE * back / np.sqrt(sum_bias)
        for k, w in enumerate(WIDTHS):
            own = back[k * FILTERS : (k + 1) * FILTERS]
            if not own.any():
                continue
            places = wins[k][:, None] + np.arange(w)
            grad_filter = vectors[places].reshape(FILTERS, w * SIZE).T * own
            grad_words = (filters[k].T * own[:, None]).reshape(FILTERS * w, SIZE)
            filter_sums[k] += grad_filter**2
            filters[k] -= RATE * grad_filter / np.sqrt(filter_sums[k])
            touched, which = np.unique(slots[:, places.ravel()], return_inverse=True)
            grad = np.zeros((len(touched), SIZE), np.float32)
            np.add.at(grad, which.ravel(), np.tile(grad_words, (2, 1)))
            sums[touched] += grad**2
            embedding[touched] -= RATE * grad / np.sqrt(sums[touched])


CHANGES = "block int, change binary"


def _replica(shared: Broadcast, epoch: int, share: float) -> Callable:
    def changed(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("slots", "ascending")])
        texts = [_unpacked(s) for s in table["slots"].to_pylist()]
        toxic = table["toxic"].to_numpy().astype(np.int64)
        own, before = Fitting(*(x.copy() for x in shared.value)), Fitting(*shared.value)
        weight = np.where(toxic == 1, 0.5 / share, 0.5 / (1 - share))
        descend(own, texts, toxic, weight, np.random.default_rng([key[0].as_py(), epoch]).permutation(len(texts)))
        changes = [(a - b).astype("<f4").tobytes() for a, b in zip(own.blocks(), before.blocks(), strict=True)]
        return pa.table({"block": pa.array(range(len(changes)), pa.int32()), "change": pa.array(changes, pa.binary())})

    return changed


def _averaged(key: tuple, table: pa.Table) -> pa.Table:
    """Mean change of each row of a block over the replicas that changed it."""
    total = changed = 0
    for packed in table["change"]:
        part = np.frombuffer(packed.as_py(), "<f4").reshape(-1, 2 * SIZE if key[0].as_py() < SLOTS // BLOCK else 2)
        total, changed = total + part.astype(np.float64), changed + part.any(axis=1)
    mean = (total / np.maximum(changed, 1)[:, None]).astype("<f4")
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "change": pa.array([mean.tobytes()], pa.binary())})


def fit(rows: DataFrame, n: int, share: float) -> ToxicModel:
    """Passes over all of ``rows`` (doc_id, toxic, slots), a stored table of ``n`` rows.  Classes weigh the same."""
    replicas = min(max(n // ROWS, 1), REPLICAS)
    dealt = rows.select(F.pmod(F.xxhash64("doc_id"), F.lit(replicas)).alias("replica"), "doc_id", "toxic", "slots")
    state = Fitting.start()
    for epoch in range(min(max(-(-STEPS // n), LEAST_EPOCHS), EPOCHS)):
        shared = rows.sparkSession.sparkContext.broadcast((state.embedding, state.sums, state.dense, state.dense_sums))
        changes = dealt.groupBy("replica").applyInArrow(_replica(shared, epoch, share), CHANGES)
        changes = changes.groupBy("block").applyInArrow(_averaged, CHANGES)
        found = {r["block"]: np.frombuffer(r["change"], np.float32) for r in changes.collect()}
        state = state.moved({i: c.reshape(-1, 2 * SIZE if i < SLOTS // BLOCK else 2) for i, c in found.items()})
        shared.destroy()
    return state.model()


def calibrated(rows: DataFrame) -> tuple[float, float]:
    """Scale and shift of the logits (``logit``, ``toxic``) of greatest likelihood, slightly ridged: a Newton step a pass."""
    scale, shift = 1.0, 0.0
    x = F.col("logit")
    for _ in range(30):
        chance = 1 / (1 + F.exp(-F.greatest(F.least(x * scale + shift, F.lit(30.0)), F.lit(-30.0))))
        off, curve = chance - F.col("toxic"), chance * (1 - chance)
        g0, g1, c0, c1, c2 = rows.agg(F.sum(off * x), F.sum(off), F.sum(curve * x * x), F.sum(curve * x), F.sum(curve)).first()
        gradient = np.array([g0 + 1e-2 * (scale - 1.0), g1 + 1e-2 * shift])
        step = np.linalg.solve(np.array([[c0, c1], [c1, c2]]) + 1e-2 * np.eye(2), gradient)
        scale, shift = float(scale - step[0]), float(shift - step[1])
        if np.abs(step).max() < 1e-6:
            break
    return (max(scale, 1e-3), shift)


def thresholds(scores: np.ndarray, toxic: np.ndarray, languages: np.ndarray, n: np.ndarray | None = None) -> dict[str, float]:
    """For each language with enough examples, the threshold of the best F1; each row stands for ``n`` documents."""
    n = np.ones(len(scores), np.int64) if n is None else n
    out = {}
    for language in sorted({x for x in languages if x is not None}):
        own = languages == language
        known = (toxic * n)[own]
        if known.sum() < LEAST_KNOWN:
            continue
        order = np.argsort(-scores[own], kind="stable")
        hits, ranked = np.cumsum(known[order]), scores[own][order]
        f1 = 2 * hits / (np.cumsum(n[own][order]) + known.sum())
        best = int(f1.argmax())
        lower = ranked[best + 1] if best + 1 < len(ranked) else 0.0
        out[language] = float((ranked[best] + lower) / 2)
    return out


@F.arrow_udf(BinaryType())
def _packed_slots(texts: pa.Array) -> pa.Array:
    padded, begins = word_slots(texts)
    rows = [padded[:, i:j].astype("<u2").tobytes() for i, j in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)]
    return pa.array(rows, pa.binary())


def _unpacked(slots: bytes) -> np.ndarray:
    return np.frombuffer(slots, "<u2").reshape(2, -1).astype(np.int32)


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> tuple[ToxicModel | None, dict[str, float], float]:
    """Model, thresholds by language and the share of toxic labels; only ``usable`` labels are read, and all of them."""
    labels = labels.filter(usable) if usable is not None else labels
    counts = dict(labels.filter("toxic in (0, 1)").groupBy("toxic").count().collect())
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    if len(counts) < 2:
        return None, {}, share
    # A document labelled more than once has its largest label.
    known = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    aside = F.crc32(F.concat(F.lit("aside"), F.col("doc_id").cast("string")).cast("binary")) % 5 == 0
    rows = one_text_each(docs, known, "lang", bounded=False)
    rows = stored(rows.select("doc_id", "lang", "toxic", aside.alias("aside"), _packed_slots("text").alias("slots")), "toxic-slots")
    sizes = {(r["aside"], r["toxic"]): r["n"] for r in rows.groupBy("aside", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    kept = [sizes.get((False, c), 0) for c in (0, 1)]
    if not all(kept):
        return None, {}, share
    model = fit(rows.filter("not aside"), sum(kept), kept[1] / sum(kept))
    if not any(a for a, _ in sizes):
        return model, {}, share
    shared = docs.sparkSession.sparkContext.broadcast((vars(model), model.shares()))

    @F.arrow_udf("double")
    def logits(slots: pa.Array) -> pa.Array:
        own = [_unpacked(s) for s in slots.to_pylist()]
        begins = np.concatenate(([0], np.cumsum([t.shape[1] for t in own])))
        found = ToxicModel(**shared.value[0]).logits(np.concatenate(own, axis=1), begins, shared.value[1]) if own else np.empty(0)
        return pa.array(found.astype(np.float64), pa.float64())

    held = stored(rows.filter("aside").select("lang", "toxic", logits("slots").alias("logit")), "toxic-logits")
    if all((True, c) in sizes for c in (0, 1)):
        model.scale = calibrated(held)
    scale, shift = model.scale
    score = 1 / (1 + F.exp(-F.greatest(F.least(F.col("logit") * scale + shift, F.lit(40.0)), F.lit(-40.0))))
    # At most ``2 * GRID`` rows of each language are left, whatever the number of documents.
    binned = held.filter("lang is not null").groupBy("lang", ((F.floor(score * GRID) + 0.5) / float(GRID)).alias("score"), "toxic").agg(F.count(F.lit(1)).alias("n"))

    def limit(table: pa.Table) -> pa.Table:
        columns = [table[c].to_numpy() for c in ("score", "toxic", "lang", "n")]
        found = thresholds(*columns)
        return pa.table({"lang": pa.array(list(found), pa.string()), "limit": pa.array(list(found.values()), pa.float64())})

    limits = binned.groupBy("lang").applyInArrow(limit, "lang string, limit double").collect()
    return model, {r["lang"]: r["limit"] for r in sorted(limits)}, share


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.5), threshold (of the language) and flagged.

    Labels are learned only from documents outside fold ``HELD_FOLD`` of their ids.
    """
    held = F.coalesce(fold(F.col("doc_id")) == HELD_FOLD, F.lit(False))
    model, limits, share = train(docs, labels, ~held)
    if model is None:
        score = F.lit(float(share))
    else:
        shared = docs.sparkSession.sparkContext.broadcast((vars(model), model.shares()))

        @F.arrow_udf("double")
        def scores(texts: pa.Array) -> pa.Array:
            own, shares = ToxicModel(**shared.value[0]), shared.value[1]
            padded, begins = word_slots(texts)
            return pa.array(own.scores(own.logits(padded, begins, shares).astype(np.float64)), pa.float64())

        score = scores("text")
    known = [F.when(F.col("lang") == name, F.lit(limit)) for name, limit in limits.items()]
    scored = docs.select("doc_id", held.alias("held_out"), score.alias("score"), F.coalesce(*known, F.lit(0.5)).alias("threshold"))
    return scored.select(
        "doc_id",
        "held_out",
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "threshold",
        (F.col("score") >= F.col("threshold")).cast("int").alias("flagged"),
    )
