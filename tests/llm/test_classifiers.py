import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tillwise.llm import ordinal_quality, toxic_cnn
from tillwise.llm.tables import read

LABELS = "doc_id long, quality int, toxic int"
SMALL = "/root/testdata/sf0.01"


def numeric_slope(f, point, i, step=1e-5):
    up, down = point.copy(), point.copy()
    up[i] += step
    down[i] -= step
    return (f(up) - f(down)) / (2 * step)


def test_ordinal_fit_separates_grades_and_orders_offsets():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 4, 600)
    texts = [b" ".join([b"good"] * g + [b"bad"] * (3 - g) + [b"w%d" % rng.integers(50)]) for g in grades]
    rows = [ordinal_quality.features(t) for t in texts]
    model = ordinal_quality.fit(rows, grades)
    assert model.grades == [0, 1, 2, 3] and (np.diff(model.offsets) < 0).all()
    score = np.array([model.weights[s] @ v for s, v in rows])
    assert np.corrcoef(score, grades)[0, 1] > 0.9
    expected = (1 / (1 + np.exp(-(score[:, None] + model.offsets)))).sum(axis=1)
    assert np.abs(expected - grades).mean() < 0.4


def test_ordinal_quality_on_labelled_documents(spark):
    docs, labels = read(spark, SMALL, "documents"), read(spark, SMALL, "labels")
    # Fitted without a fifth of the labels, judged on that fifth.
    model = ordinal_quality.train(docs, labels.filter("doc_id % 5 <> 0"))
    held = ordinal_quality.score(docs, model).join(labels.filter("doc_id % 5 = 0"), "doc_id").toPandas()
    right = (held.tail_probability >= ordinal_quality.LEAST_TAIL) == (held.quality == 1)
    assert len(held) > 50 and right.mean() > 0.9
    assert np.allclose(held.expected_grade, held.tail_probability)


def test_ordinal_quality_of_odd_rows(spark, documents, odd_rows):
    docs = documents(odd_rows, clash=True)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (3, 0, 0), (None, 1, 1), (8, None, None), (7, 1, 1)], LABELS)
    model = ordinal_quality.train(docs, labels)
    assert model.grades == [0, 1]
    scored = ordinal_quality.score(docs, model)
    assert scored.count() == len(odd_rows) and scored.filter("tail_probability is null or expected_grade is null").count() == 0
    assert set(docs.columns) - {"tail_probability"} <= set(scored.columns)
    kept = ordinal_quality.accepted(docs, labels)
    assert kept.columns == docs.columns
    none = ordinal_quality.score(docs, ordinal_quality.train(docs, labels.limit(0)))
    assert none.filter("tail_probability = 1 and expected_grade is null").count() == len(odd_rows)
    one = ordinal_quality.score(docs, ordinal_quality.train(docs, labels.filter("doc_id = 1")))
    assert one.filter("tail_probability = 1 and expected_grade = 1").count() == len(odd_rows)
    assert ordinal_quality.accepted(docs.limit(0), labels).count() == 0


def test_filters_slide_over_whole_texts_alone():
    rng = np.random.default_rng(0)
    texts = ["", "one", "two words here", " ".join(f"w{i % 91}" for i in range(5000)), None, "a b"]
    padded, begins = toxic_cnn.word_slots(pa.array(texts))
    model = toxic_cnn.ToxicModel(
        rng.normal(size=(toxic_cnn.SLOTS, toxic_cnn.SIZE)).astype(np.float32),
        [rng.normal(size=(w * toxic_cnn.SIZE, toxic_cnn.FILTERS)).astype(np.float32) for w in toxic_cnn.WIDTHS],
        rng.normal(size=toxic_cnn.FILTERS * 3).astype(np.float32),
        rng.normal(size=toxic_cnn.FILTERS * 3).astype(np.float32),
        0.3,
    )
    expected = []
    for i, j in zip(begins, begins[1:], strict=False):
        vectors = model.embedding[padded[:, i:j]].sum(axis=0)
        pooled = [(toxic_cnn._windows(vectors, w) @ f).max(axis=0) for w, f in zip(toxic_cnn.WIDTHS, model.filters, strict=True)]
        expected.append(np.maximum(np.concatenate(pooled) + model.bias, 0) @ model.top + model.intercept)
    whole = model.logits(padded, begins, model.shares())
    assert np.allclose(whole, expected, atol=1e-2)
    old = toxic_cnn.CHUNK
    try:
        toxic_cnn.CHUNK = 7
        assert np.allclose(model.logits(padded, begins, model.shares()), whole, atol=1e-3)
    finally:
        toxic_cnn.CHUNK = old


def test_toxic_words_are_found_in_long_texts(spark, documents):
    rng = np.random.default_rng(8)
    words = [f"plain{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(700):
        own = list(rng.choice(words, rng.integers(5, 300)))
        toxic = int(rng.random() < 0.3)
        if toxic:
            own.insert(int(rng.integers(len(own))), f"vile{rng.integers(40)},")
        rows.append((i, " ".join(own), "s"))
        labels.append((i, 1, toxic))
    table = spark.createDataFrame(labels, LABELS)
    found = toxic_cnn.score_documents(documents(rows), table).toPandas().set_index("doc_id")
    truth = np.array([t for *_, t in labels])
    held = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in range(700)])
    got = found.loc[range(700)]
    assert (got.held_out.to_numpy() == held).all()
    assert (got.predicted.to_numpy()[held] == truth[held]).mean() > 0.95
    assert ((got.score >= 0.5) == (got.predicted == 1)).all()


def test_thresholds_by_language():
    scores = np.array([0.1, 0.2, 0.6, 0.7] * 20)
    toxic = np.array([0, 1, 1, 1] * 20)
    languages = np.array(["x"] * 80, object)
    assert toxic_cnn.thresholds(scores, toxic, languages) == {"x": pytest.approx(0.15)}
    assert toxic_cnn.thresholds(scores, toxic, np.array([None] * 80, object)) == {}


def test_toxicity_of_odd_rows(spark, documents, odd_rows):
    docs = documents(odd_rows, clash=True)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 9)] + [(None, 1, 1), (2, None, None)], LABELS)
    found = toxic_cnn.score_documents(docs, labels).collect()
    assert len(found) == len(odd_rows) and all(0 <= r.score <= 1 for r in found)
    assert all(r.held_out is False for r in found if r.doc_id is None)
    none = toxic_cnn.score_documents(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0}
    assert toxic_cnn.score_documents(docs.limit(0), labels).count() == 0


def test_an_id_on_a_third_of_all_rows_is_one_row_of_the_sample(spark, documents):
    from tillwise.llm.labelled import one_text_each, sampled

    docs = documents([(i, f"text {i}", "s") for i in range(400)] + [(7, f"again {i % 5}", "s") for i in range(300)] + [(8, None, "s")] * 50)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(0, 400, 2)] + [(7, 1, 1)], "doc_id long, quality int, toxic int")
    chosen = sampled(labels, "quality", 50)
    found = one_text_each(docs, chosen, "lang").collect()
    assert sorted(r.doc_id for r in found) == sorted(r.doc_id for r in chosen.collect()) and len(found) == 50
    every = {r.doc_id: r.text for r in one_text_each(docs, labels.select("doc_id", "toxic")).collect()}
    texts = ["text 7", *(f"again {i}" for i in range(5))]
    assert every[7] == min(texts, key=lambda t: hashlib.md5(t.encode()).hexdigest()) and every[8] is None


def test_gradient_by_differences():
    """The fit lowers the negative log-likelihood to a point where no small step of any parameter lowers it further."""
    rng = np.random.default_rng(6)
    rows = [(rng.choice(20, 4, replace=False), rng.random(4)) for _ in range(300)]
    truth = rng.normal(size=20) * 3
    scores = np.array([truth[s] @ v for s, v in rows])
    grades = np.digitize(scores + rng.logistic(size=300), [-1.5, 1.5])
    model = ordinal_quality.fit(rows, grades)
    assert model.grades == [0, 1, 2] and model.offsets[0] > model.offsets[1]

    def loss(weights, offsets):
        score = np.array([weights[s] @ v for s, v in rows])
        tails = np.column_stack([np.ones(300), 1 / (1 + np.exp(-(score[:, None] + offsets))), np.zeros(300)])
        chance = tails[np.arange(300), grades] - tails[np.arange(300), grades + 1]
        return -np.log(chance).mean() + ordinal_quality.RIDGE / 2 * (weights**2).sum()

    best, start = loss(model.weights, model.offsets), loss(np.zeros(ordinal_quality.SLOTS), np.array([1.0, -1.0]))
    assert best < 0.8 * start
    for k in range(20):
        for step in (-0.5, 0.5):
            moved = model.weights.copy()
            moved[k] += step
            assert loss(moved, model.offsets) > best
    for step in (-0.3, 0.3):
        assert loss(model.weights, model.offsets + step) > best


def test_every_labelled_document_is_learned(spark, documents, monkeypatch):
    """No sample: all rows outside the held-out fold are fitted or set aside, whatever their number."""
    rows = [(i, "plain words" if i % 4 else "a vile word", "s") for i in range(9_000)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(9_000)], LABELS)
    seen = []

    def fit(rows, n, share):
        seen.append((rows.count(), n, share))
        return toxic_cnn.Fitting.start().model()

    monkeypatch.setattr(toxic_cnn, "fit", fit)
    usable = "crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0"
    toxic_cnn.train(documents(rows), labels.filter(usable))
    own = [i for i in range(9_000) if zlib.crc32(str(i).encode()) % 5 and zlib.crc32(b"aside%d" % i) % 5]
    assert seen == [(len(own), len(own), pytest.approx(sum(i % 4 == 0 for i in own) / len(own)))]


def test_replicas_agree_on_one_model(spark, documents, monkeypatch):
    """Many replicas of few documents find the words that one fit finds."""
    monkeypatch.setattr(toxic_cnn, "ROWS", 150)
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(1_200):
        own = [f"plain{w}" for w in rng.integers(300, size=rng.integers(5, 60))]
        toxic = int(rng.random() < 0.3)
        rows.append((i, " ".join([*own, f"vile{rng.integers(20)}"] if toxic else own), "s"))
        labels.append((i, 1, toxic))
    found = toxic_cnn.score_documents(documents(rows), spark.createDataFrame(labels, LABELS)).filter("held_out").toPandas()
    truth = np.array([labels[i][2] for i in found.doc_id])
    assert len(found) > 200 and (found.predicted.to_numpy() == truth).mean() > 0.95
