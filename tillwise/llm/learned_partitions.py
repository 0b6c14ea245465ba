"""Approximate nearest neighbours by learned partitions.

On a bounded sample a graph of nearest neighbours is cut into ``PARTITIONS`` balanced parts: median
cuts along main directions first, then vectors move to the part that most of their neighbours are
in while it has room.  A small network learns the part from the vector.  It gives every row of the
table its partition, and every query its most probable ones, in which the rows are reranked
exactly.  How many are probed is the least number that finds ``AIM`` of the neighbours
of sample queries among the sample; where neighbours are far apart that is most of them.

Rows of a partition are dealt to blocks of about ``BLOCK`` by a hash, and queries to chunks of
about ``CHUNK``; each two meet in a task group that holds its queries and streams the rows, so no
partition, however large, is one task.  Of equal vectors in a batch only the smallest ids can be
among the nearest, so only those are compared.

Cases: vectors that are null, zero or hold null or non-finite components take no part, nor do
null ids; vectors of other lengths than most of the sample are searched only by queries of their length,
without partitions; repeated rows are candidates of their own, except for the query's own id; a query
on several rows is asked once, and if its vectors differ each is asked and a candidate has the best of its scores; fewer
candidates give fewer neighbours; an empty table gives an empty result; other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.vectors import comparable, cosines, matrix, units
from tillwise.sources.workspace import stored

PARTITIONS = 32
SAMPLE = 4096
NEIGHBOURS = 10
HIDDEN = 64
AIM = 0.97
BLOCK = 16_384
CHUNK = 4096
NEAREST = 5
EVERY = 50


def neighbour_graph(points: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """The ``k`` nearest other points of each."""
    k = min(k, len(points) - 1)
    out = np.zeros((len(points), k), np.int64)
    for low in range(0, len(points), 1024):
        near = points[low : low + 1024] @ points.T
        near[np.arange(len(near)), low + np.arange(len(near))] = -np.inf
        out[low : low + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else out[low : low + 1024]
    return out


def balanced_parts(points: np.ndarray, graph: np.ndarray, parts: int, room: float = 1.05, sweeps: int = 6) -> np.ndarray:
    """A part for each point; no part holds more than ``room`` times its share."""
    part = np.zeros(len(points), np.int64)
    width = 1
    while width < parts:
        for p in range(width):
            own = np.flatnonzero(part == p)
            if len(own) < 2:
                continue
            centred = points[own] - points[own].mean(axis=0)
            direction = np.linalg.svd(centred, full_matrices=False)[2][0]
            part[own[np.argsort(centred @ direction, kind="stable")[len(own) // 2 :]]] = p + width
        width *= 2
    both = [set(g) for g in graph.tolist()]
    for i, g in enumerate(graph.tolist()):
        for j in g:
            both[j].add(i)
    sizes, most = np.bincount(part, minlength=width), int(np.ceil(room * len(points) / width))
    for _ in range(sweeps):
        moved = 0
        for i, near in enumerate(both):
            votes = np.bincount(part[list(near)], minlength=width)
            best = int(votes.argmax())
            if votes[best] > votes[part[i]] and sizes[best] < most:
                sizes[part[i]] -= 1
                sizes[best] += 1
                part[i] = best
                moved += 1
        if not moved:
            break
    return part


class Router:
    """A network with one hidden layer that gives the logits of the partitions."""

    def __init__(self, layers: list[np.ndarray]) -> None:
        self.layers = layers

    def logits(self, points: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum(points @ w1 + b1, 0) @ w2 + b2


def fit_router(points: np.ndarray, part: np.ndarray, parts: int, rounds: int = 150, seed: int = 3) -> Router:
    """Cross-entropy by Adam on all points at once."""
    rng = np.random.default_rng(seed)
    n, size = points.shape
    layers = [rng.normal(0, (2 / size) ** 0.5, (size, HIDDEN)) * size**0.5, np.zeros(HIDDEN)]
    layers += [rng.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, parts)), np.zeros(parts)]
    means, squares = [np.zeros_like(x) for x in layers], [np.zeros_like(x) for x in layers]
    for step in range(1, rounds + 1):
        w1, b1, w2, b2 = layers
        hidden = np.maximum(points @ w1 + b1, 0)
        logits = hidden @ w2 + b2
        chance = np.exp(logits - logits.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        chance[np.arange(n), part] -= 1
        chance /= n
        back = (chance @ w2.T) * (hidden > 0)
        gradients = [points.T @ back + 1e-4 * w1, back.sum(axis=0), hidden.T @ chance + 1e-4 * w2, chance.sum(axis=0)]
        for i, g in enumerate(gradients):
            means[i] = 0.9 * means[i] + 0.1 * g
            squares[i] = 0.99 * squares[i] + 0.01 * g * g
            layers[i] = layers[i] - 0.02 * (means[i] / (1 - 0.9**step)) / (np.sqrt(squares[i] / (1 - 0.99**step)) + 1e-9)
    return Router(layers)


def least_probes(router: Router, points: np.ndarray, queries: np.ndarray, parts: int, aim: float = AIM) -> int:
    """Partitions to probe so that ``aim`` of the nearest neighbours of ``queries`` (positions) are found."""
    near = points[queries] @ points.T
    near[np.arange(len(queries)), queries] = -np.inf
    k = min(NEAREST, len(points) - 1)
    if k < 1:
        return parts
    nearest = np.argpartition(-near, k - 1, axis=1)[:, :k]
    logits = router.logits(points)
    home = logits.argmax(axis=1)
    place = (-logits[queries]).argsort(axis=1).argsort(axis=1)
    needed = np.take_along_axis(place, home[nearest], axis=1)
    found = np.array([(needed < p).mean() for p in range(1, parts + 1)])
    return int(np.argmax(found >= aim)) + 1


def fit(sample: np.ndarray, parts: int = PARTITIONS) -> tuple[Router, int]:
    """Router and number of probes from a sample of vectors."""
    points = units(sample)
    if len(points) < 4 * parts:
        layers = [np.zeros((points.shape[1], HIDDEN)), np.zeros(HIDDEN), np.zeros((HIDDEN, parts)), np.zeros(parts)]
        return Router(layers), 1
    part = balanced_parts(points, neighbour_graph(points), parts)
    # A fifth of the sample is not used for the router: its neighbours tell how many probes are needed.
    asked = np.arange(0, len(points), 5)
    learned = np.setdiff1d(np.arange(len(points)), asked)
    router = fit_router(points[learned], part[learned], parts)
    return router, least_probes(router, points, asked, parts)


def _closest(batch: tuple, queries: tuple, best: list[np.ndarray], count: int) -> list[np.ndarray]:
    """The best (query position, id, score) after another batch of rows."""
    ids, vectors, points = batch
    query_ids, query_vectors, query_points = queries
    near = query_points @ points.T
    near[query_ids[:, None] == ids[None, :]] = -np.inf
    k = min(count, len(ids))
    # Rounding may disorder equal cosines, so all near the k-th are scored exactly.
    limit = -np.partition(-near, k - 1, axis=1)[:, k - 1] - 1e-9
    q, r = np.nonzero((near >= limit[:, None]) & np.isfinite(near))
    place, found = np.concatenate((best[0], q)), np.concatenate((best[1], ids[r]))
    score = np.concatenate((best[2], cosines(query_vectors[q], vectors[r])))
    order = np.lexsort((found, -score, place))
    place, found, score = place[order], found[order], score[order]
    begins = np.searchsorted(place, place)
    top = np.arange(len(place)) - begins < count
    return [place[top], found[top], score[top]]


def _distinct(ids: np.ndarray, vectors: np.ndarray, count: int) -> np.ndarray:
    """Positions without those whose vector ``count`` smaller ids in the batch have."""
    order = np.lexsort((ids, *vectors.T[:4]))
    rows = vectors[order]
    new = np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1)))
    begins = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
    return order[np.arange(len(rows)) - begins < count]


def nearest(rows: DataFrame, queries: Column, count: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: the ``count`` nearest rows found for each row where ``queries`` holds."""
    spark = rows.sparkSession
    valid = rows.select("vec_id", F.col("embedding").alias("vector"), queries.alias("asks"))
    valid = valid.filter(F.col("vec_id").isNotNull() & comparable(F.col("vector")))
    sample = valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").toPandas()["vector"]
    sizes = sorted(len(v) for v in sample)
    size = sizes[len(sizes) // 2] if sizes else 1
    of_size = [v for v in sample if len(v) == size]
    router, probes = fit(np.array(of_size, np.float64).reshape(-1, size))
    shared = spark.sparkContext.broadcast((router.layers, size, probes))

    @F.arrow_udf("array<int>")
    def routed(vectors: pa.Array) -> pa.Array:
        """Partitions by falling chance: the first is a row's own, all are a query's probes."""
        layers, usual, most = shared.value
        own = vectors.value_lengths().to_numpy() == usual
        out = np.full((len(vectors), most), -1, np.int32)
        if own.any():
            logits = Router(layers).logits(units(matrix(vectors.filter(pa.array(own)))))
            out[own] = np.argsort(-logits, axis=1, kind="stable")[:, :most]
        return pa.array([r.tolist() if o else [-1] for r, o in zip(out, own, strict=True)], pa.list_(pa.int32()))

    indexed = valid.withColumn("size", F.size("vector")).withColumn("parts", routed("vector"))
    indexed = stored(indexed.withColumn("part", F.col("parts")[0]), "vector-partitions")
    place = F.xxhash64("vec_id")
    blocks = indexed.groupBy("size", "part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    once = indexed.filter("asks").groupBy("vec_id", "vector", "size").agg(F.first("parts").alias("parts"))
    asked = once.select("vec_id", "vector", "size", F.explode("parts").alias("part"))
    chunks = asked.groupBy("size", "part").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    plan = stored(blocks.join(chunks, ["size", "part"]), "partition-plan")
    each = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    group = ["size", "part", "block", "chunk"]
    row_side = indexed.join(plan, ["size", "part"]).withColumn("block", F.pmod(place, "blocks")).withColumn("chunk", each("chunks"))
    query_side = asked.join(plan, ["size", "part"]).withColumn("chunk", F.pmod(place, "chunks")).withColumn("block", each("blocks"))
    columns = ["hash", *group, "side", "vec_id", "asking", "vector"]
    # Tells the vectors of one query id apart.
    query_side = query_side.withColumn("asking", F.xxhash64("vector"))
    row_side = row_side.withColumn("asking", F.lit(0).cast("long"))
    met = query_side.withColumn("side", F.lit(0)).withColumn("hash", F.xxhash64(*group)).select(*columns)
    met = met.unionByName(row_side.withColumn("side", F.lit(1)).withColumn("hash", F.xxhash64(*group)).select(*columns))
    dealt = met.repartition("hash", *group).sortWithinPartitions("hash", *group, "side")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, asking, queries, prints, best = None, [], None, None, None

        def result() -> pa.RecordBatch:
            columns = (queries[0][best[0]], prints[best[0]], best[1], best[2])
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["query_id", "asking", "vec_id", "score"])

        for batch in batches:
            keys = np.column_stack([c.to_numpy().astype(np.int64) for c in batch.columns[:6]])
            cuts = [0, *(np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1).tolist(), len(keys)]
            for i, j in zip(cuts, cuts[1:], strict=False):
                if i == j:
                    continue
                if tuple(keys[i][:5]) != key:
                    if best is not None and len(best[0]):
                        yield result()
                    key, asking, queries, prints, best = tuple(keys[i][:5]), [], None, None, None
                ids = batch.column(6).slice(i, j - i).to_numpy()
                vectors = matrix(batch.column(8).slice(i, j - i))
                if keys[i][5] == 0:
                    asking.append((ids, vectors, batch.column(7).slice(i, j - i).to_numpy()))
                elif asking:
                    if queries is None:
                        query_ids, query_vectors, prints = (np.concatenate(x) for x in zip(*asking, strict=True))
                        queries = (query_ids, query_vectors, units(query_vectors))
                        best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
                    few = _distinct(ids, vectors, count + 1)
                    rows = (ids[few], vectors[few], units(vectors[few]))
                    for low in range(0, len(few), 2048):
                        part = tuple(x[low : low + 2048] for x in rows)
                        best = _closest(part, queries, best, count)
        if best is not None and len(best[0]):
            yield result()

    scored = dealt.mapInArrow(found, "query_id long, asking long, vec_id long, score double").repartition("query_id")
    # Rows of one query: at most ``count`` from each block of the partitions each of its vectors probes.
    copies = Window.partitionBy("query_id", "asking", "vec_id").orderBy(F.desc("score"))
    scored = scored.withColumn("copy", F.row_number().over(copies))
    scored = scored.groupBy("query_id", "vec_id", "copy").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)
    return ranked.select("query_id", "rank", "vec_id", "score")


def search(embeddings: DataFrame) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by ``EVERY``, against all other rows."""
    return nearest(embeddings, F.col("vec_id") % EVERY == 0)
