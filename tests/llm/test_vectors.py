import numpy as np
import pytest

from tillwise.llm import cover_tree, learned_partitions

COLUMNS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def clustered():
    """Random vectors, copies, scaled copies and dense groups near the threshold; ids not in order."""
    rng = np.random.default_rng(6)
    rows, ids = [], rng.permutation(2000)
    for k in range(90):
        base, label = rng.normal(size=12), int(rng.integers(3))
        rows.append((base, label))
        for _ in range(int(rng.choice([0, 1, 6]))):
            rows.append((base + rng.normal(size=12) * rng.choice([0.0, 0.02, 0.2, 0.3]), label))
        if k % 10 == 0:
            rows += [(base * 2, label), (-base, label), (base, (label + 1) % 3)]
    return [(int(i), [float(x) for x in v.astype(np.float32)], y) for i, (v, y) in zip(ids, rows, strict=False)]


BAD = [
    (5000, None, 1),
    (5001, [0.0] * 12, 1),
    (5002, [None] + [1.0] * 11, 1),
    (5003, [float("nan")] + [1.0] * 11, 1),
    (5004, [float("inf")] + [1.0] * 11, 1),
    (5005, [1.0] * 12, None),
    (5006, [1.0, 2.0], 1),
    (5007, [], 1),
    (None, [1.0] * 12, 1),
]


def brute_force(rows, least=cover_tree.LEAST_COSINE):
    vectors = np.array([v for _, v, _ in rows], np.float64)
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    label = np.array([y for *_, y in rows])
    linked = (unit @ unit.T >= least) & (label[:, None] == label)
    np.fill_diagonal(linked, False)
    root = np.array([i for i, *_ in rows])
    while True:
        lower = np.minimum(root, np.where(linked, root[None, :], 1 << 60).min(axis=1))
        if (lower == root).all():
            return {i: (int(n), int(r)) for (i, *_), n, r in zip(rows, linked.sum(axis=1), root, strict=True)}
        root = lower


@pytest.mark.parametrize("block", [cover_tree.BLOCK, 40])
def test_cover_tree_equals_comparing_all(spark, clustered, monkeypatch, block):
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    monkeypatch.setattr(cover_tree, "LEAF", 4)
    found = cover_tree.near_duplicates(spark.createDataFrame(clustered + BAD, COLUMNS)).collect()
    assert len(found) == len(clustered) + len(BAD)
    expected = brute_force(clustered)
    for r in found:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, False)
        else:
            links, root = expected.get(r.vec_id, (0, r.vec_id))
            assert (r.n_links, r.component_id, r.kept) == (links, root, root == r.vec_id)


def test_cover_tree_of_copies_repeated_rows_and_empty_tables(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same, 1) for i in range(30)] + [(3, same, 1), (100, same, 2), (101, [9.0, -1.0, 0.0], 1)]
    table = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'x' as links", "'y' as root", "1 as size", "2 as rep_id")
    found = cover_tree.near_duplicates(table).collect()
    assert len(found) == 33
    assert all((r.n_links, r.component_id) == (30, 0) for r in found if r.vec_id < 30)
    assert all((r.n_links, r.component_id) == (0, r.vec_id) for r in found if r.vec_id >= 100)
    assert cover_tree.near_duplicates(table.limit(0)).count() == 0


def test_nets_cover_and_halve():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(300, 5))
    points /= np.linalg.norm(points, axis=1)[:, None]
    waiting = [cover_tree.tree(points)]
    while waiting:
        node = waiting.pop()
        away = cover_tree._distances(points[[node.centre]], points[node.members])[0]
        assert away.max() <= node.radius + 1e-7
        if len(node.members) > 8:
            children = cover_tree.opened(points, node)
            assert sorted(np.concatenate([c.members for c in children])) == sorted(node.members)
            assert max(c.radius for c in children) <= node.radius / 2 + 1e-9
            waiting += children


def nearest_of_all(rows, query, count=5):
    vectors = {i: np.array(v, np.float64) for i, v, _ in rows}
    own = vectors[query]
    score = {i: (own * v).sum() / (np.sqrt((own * own).sum()) * np.sqrt((v * v).sum())) for i, v in vectors.items() if i != query}
    return sorted(score.items(), key=lambda x: (-x[1], x[0]))[:count]


@pytest.mark.parametrize("block", [learned_partitions.BLOCK, 50])
def test_search_scores_and_recall(spark, monkeypatch, block):
    monkeypatch.setattr(learned_partitions, "BLOCK", block)
    monkeypatch.setattr(learned_partitions, "CHUNK", 7)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(20, 16)) * 2
    rows = [(i, [float(x) for x in (centres[i % 20] + rng.normal(size=16)).astype(np.float32)], 1) for i in range(1500)]
    found = {}
    for r in learned_partitions.search(spark.createDataFrame(rows, COLUMNS)).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = 0
    for q in range(0, 1500, 50):
        best = nearest_of_all(rows, q)
        got = [found[q][k] for k in range(1, 6)]
        hits += len({i for i, _ in best} & {i for i, _ in got})
        exact = dict(nearest_of_all(rows, q, 1500))
        assert all(s == pytest.approx(exact[i], abs=1e-15) for i, s in got)
        assert got == sorted(got, key=lambda x: (-x[1], x[0]))
    assert hits >= 0.9 * 150


def test_search_with_ties_bad_vectors_and_few_candidates(spark):
    rows = [(i, [1.0, 1.0], 1) for i in range(0, 400)] + [(400 + i, [1.0, 0.0], 1) for i in range(5)]
    bad = [(1000, None, 1), (1050, [0.0, 0.0], 1), (1100, [float("nan"), 1.0], 1), (None, [1.0, 1.0], 1)]
    table = spark.createDataFrame(rows + bad, COLUMNS).selectExpr("*", "1 as score", "'a' as part", "2 as size")
    found = {}
    for r in learned_partitions.search(table).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert sorted(found) == list(range(0, 401, 50))
    assert [v for _, v in sorted(found[0])] == [1, 2, 3, 4, 5]
    assert [v for _, v in sorted(found[50])] == [0, 1, 2, 3, 4]
    assert [v for _, v in sorted(found[400])][:4] == [401, 402, 403, 404]
    few = learned_partitions.search(spark.createDataFrame([(0, [1.0], 1), (7, [2.0], 1)], COLUMNS)).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in few] == [(0, 1, 7, 1.0)]
    assert learned_partitions.search(table.limit(0)).count() == 0


def test_repeated_query_rows_are_asked_once(spark):
    rows = [(i, [1.0, i / 100], 1) for i in range(1, 9)]
    query = (0, [1.0, 0.0], 1)

    def found(*queries):
        best = learned_partitions.search(spark.createDataFrame([*rows, rows[0], *queries], COLUMNS)).collect()
        return [r.vec_id for r in sorted(best, key=lambda r: r.rank)]

    # Row 1 is there twice and counts twice, however often the query is there.
    assert found(query) == found(query, query) == found(*[query] * 5) == [1, 1, 2, 3, 4]
    # A second vector finds the other end.
    assert found(query, query, (0, [1.0, 0.081], 1)) == [8, 1, 1, 7, 2]


def test_parts_are_balanced():
    rng = np.random.default_rng(4)
    points = rng.normal(size=(800, 8))
    points /= np.linalg.norm(points, axis=1)[:, None]
    graph = learned_partitions.neighbour_graph(points, 5)
    part = learned_partitions.balanced_parts(points, graph, 16)
    assert np.bincount(part, minlength=16).max() <= np.ceil(1.05 * 50) + 1
    near = points @ points.T
    np.fill_diagonal(near, -2)
    assert all(set(g) == set(np.argsort(-n)[:5]) for g, n in zip(graph, near, strict=True))
