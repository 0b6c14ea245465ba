"""The registered queries over whole tables, against SQL or brute force."""

import hashlib
import sys
import zlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from tillwise.llm import byte_bpe, cover_tree, huffman, learned_partitions, oracle, queries, simhash, text_overlap  # noqa: E402
from tillwise.llm.tables import read  # noqa: E402
from tillwise.sources.workspace import stored  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return read(spark, SMALL, "documents").toPandas().sort_values("doc_id")


def test_all_are_registered():
    found = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(found)
    assert set(oracle.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_sql(spark, name):
    found = queries.QUERIES[name](spark, SMALL).toPandas()
    with duckdb.connect() as base:
        for table in ("documents", "benchmark"):
            base.sql(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
        expected = base.sql(oracle.SQL[name]).df()
    columns = sorted(expected.columns)
    assert sorted(found.columns) == columns
    sort = lambda x: x[columns].sort_values(columns).reset_index(drop=True)
    assert sort(found).equals(sort(expected).astype(found[columns].dtypes.to_dict()))


def test_byte_bpe(spark, docs):
    from tokenizers import Tokenizer

    known = Tokenizer.from_str(byte_bpe.definition())
    known.encode_special_tokens = True
    found = queries.op2_byte_bpe(spark, SMALL).toPandas().set_index("doc_id")
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        ids = known.encode(text, add_special_tokens=False).ids
        assert found.n_tokens[i] == len(ids)
        assert found.ids_sha256[i] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found.decoded_sha256[i] == hashlib.sha256(text.encode()).hexdigest()


def test_huffman(spark, docs):
    from tokenizers import Tokenizer

    known, start = Tokenizer.from_file(public_tokenizers.path(huffman.DEFINITION)), 0
    found = queries.op10_huffman(spark, SMALL).toPandas().set_index("doc_id")
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        ids = [*known.encode(text, add_special_tokens=False).ids, 1]
        assert (found.start[i], found.n_tokens[i]) == (start, len(ids))
        assert found.ids_crc32[i] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_simhash(spark, docs):
    prints = np.array([simhash.fingerprint(t.encode()) for t in docs.text]).view(np.uint64)
    root = docs.doc_id.to_numpy().copy()
    near = np.bitwise_count(prints[:, None] ^ prints) <= simhash.MOST_BITS
    while True:
        lower = np.where(near, root[None, :], 1 << 60).min(axis=1)
        if (lower == root).all():
            break
        root = lower
    found = queries.op9_simhash(spark, SMALL).toPandas().set_index("doc_id").loc[docs.doc_id]
    assert found.fingerprint.tolist() == [f"{p:016x}" for p in prints]
    assert found.component_id.tolist() == root.tolist()


def test_vectors(spark):
    rows = read(spark, SMALL, "embeddings").toPandas()
    vectors = np.stack(rows.embedding).astype(np.float64)
    unit, ids = vectors / np.linalg.norm(vectors, axis=1)[:, None], rows.vec_id.to_numpy()
    near = unit @ unit.T
    np.fill_diagonal(near, -2)
    linked = (near >= cover_tree.LEAST_COSINE) & (rows.label.to_numpy()[:, None] == rows.label.to_numpy())
    found = queries.op8_cover_tree(spark, SMALL).toPandas().set_index("vec_id").loc[ids]
    assert found.n_links.tolist() == linked.sum(axis=1).tolist()
    best = queries.op4_nearest(spark, SMALL).toPandas()
    asked = np.flatnonzero(ids % learned_partitions.EVERY == 0)
    assert sorted(best.query_id.unique()) == sorted(ids[asked]) and len(best) == 5 * len(asked)
    hits = sum(len(set(ids[np.argsort(-near[i])[:5]]) & set(best.vec_id[best.query_id == ids[i]])) for i in asked)
    assert hits >= 0.9 * len(best)


def test_whitening(spark):
    rows = read(spark, SMALL, "embeddings").toPandas()
    x = np.floor(np.stack(rows.embedding).astype(np.float64) * 256)
    fit = np.unique(x, axis=0)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True))
    found = queries.op11_whitening(spark, SMALL).toPandas()
    assert len(found) == 4 * len(rows) and set(found.n) == {len(fit)} and found.identity_error.max() < 1e-9
    for k in range(1, 5):
        own = found[found.component == k].set_index("vec_id").loc[rows.vec_id]
        expected = (x - fit.mean(axis=0)) @ vectors[:, -k] / np.sqrt(values[-k])
        sign = np.sign(expected[0] * own.whitened.iloc[0])
        assert np.allclose(own.whitened, sign * expected, atol=1e-8) and np.allclose(own.explained, values[-k] / values.sum())
        deviations = ((len(fit) * x - fit.sum(axis=0)) ** 2).sum(axis=1)
        assert own.deviation.tolist() == [int(d) for d in deviations]


def test_shards_and_classifiers(spark, docs):
    shards = queries.op6_shards(spark, SMALL).toPandas().set_index("doc_id").loc[docs.doc_id]
    assert shards.text_crc32.tolist() == [zlib.crc32(t.encode()) for t in docs.text]
    scores = queries.op7_toxicity(spark, SMALL).toPandas().set_index("doc_id").loc[docs.doc_id]
    assert scores.held_out.tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in docs.doc_id]
    grades = queries.op3_quality(spark, SMALL).toPandas()
    known = grades.merge(read(spark, SMALL, "labels").toPandas(), on="doc_id")
    assert sorted(grades.doc_id) == docs.doc_id.tolist() and (known.keep == (known.quality == 1)).mean() > 0.95


def test_pipeline(spark, docs):
    """Each stage against what its input demands."""
    steps, table = [], read(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES:
        table = stored(stage(spark, table, SMALL), "stage")
        steps.append(table.toPandas())
    good, lines, single, mixed, encoded = steps
    for step in steps[:4]:
        assert list(step.columns) == list(docs.columns)
    labels = read(spark, SMALL, "labels").toPandas()
    known = docs.merge(labels, on="doc_id")
    kept = known.doc_id.isin(good.doc_id)
    assert kept[known.quality == 1].mean() > 0.95 and kept[known.quality == 0].mean() < 0.2
    assert sorted(lines.doc_id) == sorted(good.doc_id)
    sets = {i: text_overlap.shingle_set(t.encode()) for i, t in zip(lines.doc_id, lines.text, strict=True)}
    stay = set(single.doc_id)
    assert stay < set(sets)
    for i, own in sets.items():
        near = [j for j, other in sets.items() if j != i and text_overlap.overlap(own, other)]
        # What stays is unlike all else that stays, what goes is like something.
        assert not stay & set(near) if i in stay else near
    assert set(mixed.doc_id) <= set(single.doc_id) and mixed.groupby("doc_id").size().max() <= 2
    text = dict(zip(mixed.doc_id, mixed.text, strict=True))
    assert sorted(encoded.doc_id) == sorted(mixed.doc_id)
    assert all(d == hashlib.sha256(text[i].encode()).hexdigest() for i, d in zip(encoded.doc_id, encoded.decoded_sha256, strict=True))
    final = corpus_pipeline.run(spark, SMALL).toPandas()
    assert sorted(zip(final.doc_id, final.ids_sha256, strict=True)) == sorted(zip(encoded.doc_id, encoded.ids_sha256, strict=True))
