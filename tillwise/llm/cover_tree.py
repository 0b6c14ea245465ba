"""Embedding near-duplicates: exact cosine threshold pairs by cover-tree dual traversal.

On unit vectors a cosine of at least t is a distance of at most sqrt(2 - 2t).  Vectors of a label
are dealt to cells around centres of the tree's upper levels, and cells to blocks of about ``BLOCK``
vectors.  Two blocks meet, in a task group of their own, only if their cells' centres are no
further apart than both covering radii and the threshold.  Inside, each block is a tree of nested
levels whose radii halve, and both trees are walked together: pairs of nodes whose centres are too
far apart for their covering radii are dropped with all below them, pairs of nodes about as wide as the
threshold are compared vector by vector, and the rest are opened.

Equal vectors are one row with a weight before the search.  A group sends the number of links of
each vector and a spanning forest, never its pairs.  Centres come from a bounded sample of the
``LABELS`` largest labels; they only steer the work: distances and radii are those of all
vectors, and every vector is compared.

Cases: vectors that are null, zero or hold null or non-finite components link with nothing, nor
do those with a null label; vectors of different lengths never link; a null vec_id takes no part (no
links, null component, not kept); repeated rows count as vectors of their own; an id that comes
with several vectors is one node with the links of all; an empty table gives an empty result; other columns
are not part of the result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.components import components
from tillwise.llm.vectors import comparable, cosines, matrix, units
from tillwise.sources.workspace import stored

LEAST_COSINE = 0.93
BLOCK = 4096
#: Upper levels: so many centres at most, for so many labels at most, from so many vectors of each.
CENTRES, LABELS, SAMPLE = 24, 256, 192
LEAF = 32
#: Bounds give way by this much, so that rounding never drops a pair; leaves decide exactly.
SLACK = 1e-7


class Node:
    """A centre with its covering radius; either children or members (positions)."""

    __slots__ = ("centre", "children", "members", "radius")

    def __init__(self, centre: int, members: np.ndarray, radius: float) -> None:
        self.centre, self.members, self.radius, self.children = centre, members, radius, None


def _net(points: np.ndarray, members: np.ndarray, reach: float) -> list[tuple[int, np.ndarray, float]]:
    """Centres more than ``reach`` apart that cover ``members``, with those nearest to each and its radius."""
    nearest = np.full(len(members), np.inf)
    owner = np.zeros(len(members), np.int64)
    centres = []
    place = 0
    while True:
        centre = int(members[place])
        distance = _distances(points[centre : centre + 1], points[members])[0]
        distance[members == centre] = 0.0
        closer = distance < nearest
        nearest[closer], owner[closer] = distance[closer], len(centres)
        centres.append(centre)
        place = int(nearest.argmax())
        if nearest[place] <= reach:
            break
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(len(centres) + 1))
    out = []
    for k, centre in enumerate(centres):
        own = order[cuts[k] : cuts[k + 1]]
        out.append((centre, members[own], float(nearest[own].max())))
    return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between all rows of two sets of unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def opened(points: np.ndarray, node: Node) -> list[Node]:
    """The node's children on the next level, of half its radius; built when first asked for."""
    if node.children is None:
        node.children = [Node(*part) for part in _net(points, node.members, node.radius / 2)]
    return node.children


def tree(points: np.ndarray) -> Node:
    everyone = np.arange(len(points))
    return Node(0, everyone, float(_distances(points[:1], points).max()))


class Links:
    """Counts and connectivity of the links found among the vectors of one task group."""

    def __init__(self, weights: np.ndarray) -> None:
        self.weights, self.counts = weights, np.zeros(len(weights), np.int64)
        self.label = np.arange(len(weights))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        """Pairs of different positions, each pair once."""
        np.add.at(self.counts, i, self.weights[j])
        np.add.at(self.counts, j, self.weights[i])
        while True:
            a, b = self.label[i], self.label[j]
            apart = a != b
            if not apart.any():
                return
            low, high = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
            np.minimum.at(self.label, high, low)
            # Every label points at a smaller one until it is its own.
            while True:
                further = self.label[self.label]
                if (further == self.label).all():
                    break
                self.label = further


def traverse(vectors: np.ndarray, points: np.ndarray, trees: tuple[Node, Node], least: float, links: Links) -> None:
    """Add every pair of cosine >= ``least`` between two trees over ``points`` (one tree twice: within it)."""
    reach = float(np.sqrt(max(2 - 2 * least, 0)))
    waiting = [trees]
    while waiting:
        a, b = waiting.pop()
        small = len(a.members) <= LEAF and len(b.members) <= LEAF
        # Nodes no wider than a few times the threshold are compared; opening them prunes nothing.
        tight = a.radius + b.radius <= 2 * reach
        if small or tight:
            _compare(vectors, points, a, b, least, links)
            continue
        # The wider node is opened, or both if neither is small.
        parts_a = [a] if len(a.members) <= LEAF and a is not b else opened(points, a)
        parts_b = [b] if len(b.members) <= LEAF and a is not b else opened(points, b)
        centres_b, radii_b = points[[n.centre for n in parts_b]], np.array([n.radius for n in parts_b])
        for low in range(0, len(parts_a), 512):
            some = parts_a[low : low + 512]
            between = _distances(points[[n.centre for n in some]], centres_b)
            between -= np.array([n.radius for n in some])[:, None] + radii_b + (reach + SLACK)
            for i, j in zip(*(x.tolist() for x in np.nonzero(between <= 0)), strict=True):
                one, other = some[i], parts_b[j]
                # Within one tree each two children meet once, a child and itself too.
                if a is not b or low + i < j or (low + i == j and len(one.members) > 1):
                    waiting.append((one, other))


def _compare(vectors: np.ndarray, points: np.ndarray, a: Node, b: Node, least: float, links: Links) -> None:
    for low in range(0, len(a.members), 1024):
        own = a.members[low : low + 1024]
        cosine = points[own] @ points[b.members].T
        found = cosine >= least
        close = np.abs(cosine - least) < 1e-9
        if close.any():
            i, j = np.nonzero(close)
            found[i, j] = cosines(vectors[own[i]], vectors[b.members[j]]) >= least
        i, j = np.nonzero(found)
        i, j = own[i], b.members[j]
        if a is b:
            i, j = i[i < j], j[i < j]
        links.add(i, j)


def group_links(ids: np.ndarray, vectors: np.ndarray, weights: np.ndarray, first: int | None, least: float) -> tuple:
    """Links between the first ``first`` vectors and the others, or within all if ``first`` is None.

    Returns ids with links, their counts and the smallest id of their component in this group.
    """
    if first is not None and not 0 < first < len(ids):
        return ids[:0], weights[:0], ids[:0]  # a block without vectors
    points, links = units(vectors), Links(weights)
    if first is None:
        whole = tree(points)
        traverse(vectors, points, (whole, whole), least, links)
    else:
        sides = (np.arange(first), np.arange(first, len(ids)))
        made = [Node(int(s[0]), s, float(_distances(points[s[:1]], points[s]).max())) for s in sides]
        traverse(vectors, points, (made[0], made[1]), least, links)
    linked = np.flatnonzero(links.counts)
    roots = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(roots, links.label, ids)
    return ids[linked], links.counts[linked], roots[links.label[linked]]


def _centres(classes: DataFrame) -> dict[int, np.ndarray]:
    """Unit centres for the largest labels with more than one block, from a bounded sample of each."""
    crowded = classes.groupBy("label", "size").count().filter(F.col("count") > BLOCK)
    crowded = crowded.orderBy(F.desc("count"), "label", "size").limit(LABELS)
    order = Window.partitionBy("label", "size").orderBy("mix", "rep_id")
    # A hash below this bound keeps about four times the sample, so no window sorts a whole label.
    share = F.lit(float(2**62)) * (F.lit(4.0 * SAMPLE) / F.col("count"))
    chosen = (
        classes.withColumn("mix", F.shiftrightunsigned(F.xxhash64("rep_id"), 2))
        .join(F.broadcast(crowded), ["label", "size"])
        .filter(F.col("mix") < share)
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= SAMPLE)
        .select("label", "size", "vector", F.ceil(F.col("count") / BLOCK).alias("blocks"))
        .toPandas()
    )
    out = {}
    for key, rows in chosen.groupby(["label", "size"]):
        points = units(np.stack(rows["vector"].to_numpy()).astype(np.float64))
        # Centres come farthest first, so the first of them are the upper levels of the net;
        # more cells than a label has blocks would only send its vectors to more places.
        most = min(CENTRES, int(rows["blocks"].iloc[0]))
        out[key] = points[[c for c, *_ in _net(points, np.arange(len(points)), 1e-6)[:most]]]
    return out


def _cells(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes with cell (nearest centre; 0 without centres), the distance to it, and block inside the cell."""
    centres = _centres(classes)
    shared = classes.sparkSession.sparkContext.broadcast(centres)

    @F.arrow_udf("struct<cell:int,away:double>")
    def nearest(labels: pa.Array, sizes: pa.Array, vectors: pa.Array) -> pa.Array:
        cell, away = np.zeros(len(labels), np.int32), np.zeros(len(labels))
        keys = np.column_stack((labels.to_numpy().astype(np.int64), sizes.to_numpy().astype(np.int64)))
        for key, known in shared.value.items():
            own = np.flatnonzero((keys == np.array(key)).all(axis=1))
            if len(own):
                distance = _distances(units(matrix(vectors.take(pa.array(own)))), known)
                cell[own], away[own] = distance.argmin(axis=1), distance.min(axis=1)
        return pa.StructArray.from_arrays([pa.array(cell), pa.array(away)], ["cell", "away"])

    placed = classes.withColumn("at", nearest("label", "size", "vector"))
    placed = stored(placed.select("*", "at.cell", "at.away").drop("at"), "vector-cells")
    counts = placed.groupBy("label", "size", "cell").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"), F.max("away").alias("radius")
    )
    rows = [(int(k[0]), int(k[1]), i, [float(x) for x in c]) for k, m in centres.items() for i, c in enumerate(m)]
    known = classes.sparkSession.createDataFrame(rows, "label int, size int, cell int, centre array<double>")
    return placed, stored(counts.join(known, ["label", "size", "cell"], "left"), "cells")


def _meetings(cells: DataFrame, least: float) -> DataFrame:
    """One row per pair of blocks that must meet: label, size, and cell and block of both, in order."""
    reach = float(np.sqrt(max(2 - 2 * least, 0)))
    a = cells.select("label", "size", *[F.col(c).alias(f"{c}_a") for c in ("cell", "blocks", "radius", "centre")])
    b = cells.select("label", "size", *[F.col(c).alias(f"{c}_b") for c in ("cell", "blocks", "radius", "centre")])
    squares = F.zip_with("centre_a", "centre_b", lambda x, y: (x - y) * (x - y))
    apart = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))
    near = F.col("cell_a") == F.col("cell_b")
    near = near | (apart <= F.col("radius_a") + F.col("radius_b") + reach + SLACK)
    # Cells of one label: at most CENTRES.
    pairs = a.join(b, ["label", "size"]).filter((F.col("cell_a") <= F.col("cell_b")) & near)
    one = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks_a") - 1))
    two = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks_b") - 1))
    both = pairs.withColumn("block_a", one).withColumn("block_b", two)
    ordered = (F.col("cell_a") < F.col("cell_b")) | (F.col("block_a") <= F.col("block_b"))
    return both.filter(ordered).select("label", "size", "cell_a", "block_a", "cell_b", "block_b")


def links(classes: DataFrame, least: float) -> DataFrame:
    """rep_id, links and root, one row per class and task group in which it has links."""
    placed, cells = _cells(classes)
    where = placed.join(cells.select("label", "size", "cell", "blocks"), ["label", "size", "cell"])
    where = where.withColumn("block", F.pmod(F.xxhash64("rep_id"), "blocks"))
    meetings = stored(_meetings(cells, least), "block-pairs")
    alone = (F.col("cell_a") == F.col("cell_b")) & (F.col("block_a") == F.col("block_b"))
    pair = ["label", "size", "cell_a", "block_a", "cell_b", "block_b"]
    first = meetings.select(*pair, F.col("cell_a").alias("cell"), F.col("block_a").alias("block"), F.lit(0).alias("side"))
    second = meetings.filter(~alone).select(
        *pair, F.col("cell_b").alias("cell"), F.col("block_b").alias("block"), F.lit(1).alias("side")
    )
    met = where.join(first.unionByName(second), ["label", "size", "cell", "block"])
    met = met.withColumn("pair", F.struct(*pair)).select(
        F.xxhash64(*pair).alias("hash"), *pair, "side", "rep_id", "weight", "vector"
    )
    dealt = met.repartition("hash", *pair).sortWithinPartitions("hash", *pair, "side")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            side = table["side"].to_numpy()
            columns = [table[c].to_numpy().astype(np.int64) for c in ("rep_id", "weight")]
            vectors = matrix(table["vector"].combine_chunks())
            a, b = ([table[f"{x}_{y}"][0].as_py() for x in ("cell", "block")] for y in "ab")
            first = None if a == b else int((side == 0).sum())
            out = group_links(columns[0], vectors, columns[1], first, least)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["rep_id", "links", "root"])

        held, key = [], None
        for batch in batches:
            keys = np.column_stack([c.to_numpy().astype(np.int64) for c in batch.columns[: 1 + len(pair)]])
            cuts = [0, *(np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1).tolist(), len(keys)]
            for i, j in zip(cuts, cuts[1:], strict=False):
                if j > i:
                    if held and tuple(keys[i]) != key:
                        yield solved(pa.Table.from_batches(held))
                        held = []
                    key = tuple(keys[i])
                    held.append(batch.slice(i, j - i))
        if held:
            yield solved(pa.Table.from_batches(held))

    return dealt.mapInArrow(found, "rep_id long, links long, root long")


def near_duplicates(embeddings: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = embeddings.select("vec_id", F.col("label").cast("int").alias("label"), F.col("embedding").alias("vector"))
    usable = comparable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    keyed = rows.withColumn("key", F.when(usable, F.xxhash64("vector")))
    classes = (
        keyed.filter("key is not null")
        .groupBy("label", "key", "vector")
        .agg(F.min("vec_id").alias("rep_id"), F.count(F.lit(1)).alias("weight"))
        .withColumn("size", F.size("vector"))
    )
    classes = stored(classes, "vector-classes")
    partial = stored(links(classes, least), "vector-links")
    counts = partial.groupBy("rep_id").agg(F.sum("links").alias("links"))
    roots = components(partial.select("rep_id", "root"))
    known = (
        classes.select("label", "key", "vector", "rep_id", "weight")
        .join(counts, "rep_id", "left")
        .join(roots, F.col("rep_id") == F.col("node"), "left")
        .select(
            F.col("label").alias("of_label"),
            F.col("key").alias("of_key"),
            F.col("vector").alias("of_vector"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("root", "rep_id").alias("component_id"),
        )
    )
    same = (F.col("key") == F.col("of_key")) & (F.col("label") == F.col("of_label"))
    same = same & (F.col("vector") == F.col("of_vector"))
    joined = keyed.join(known, same, "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
