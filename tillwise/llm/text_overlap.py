"""Near copies by overlap: all pairs of texts whose sets of five-word shingles have a Jaccard index of 0.8 or more.

SimHash fingerprints of the sets are searched first, by pigeonring as in ``simhash``; each link is checked exactly on the
two sets.  A 64-bit SimHash cannot find all pairs by key: at 0.8 they differ in about ten bits, some in more than fifteen,
and chains with such a budget have keys that unrelated texts share.  So the links beyond its ``MOST_BITS`` come from
minhashes: ``BANDS`` keys of ``ROWS`` minima each, of which a pair at 0.8 misses all once in 38,000, nearer pairs less
often.  These candidates are checked exactly too.

Equal sets are one node before the search, and keys with the same members are one group.  A group's sets meet once, in
one task, where a spanning forest of the links is grown and only links are sent.  There a set is compared with those
that share one of its rarest shingles (prefix filter), are large enough and are not yet connected to it: what all
members share, a passage say, makes no candidates, and a dense group of near copies costs about as many comparisons as
it has rows.  Groups beyond ``BLOCK`` rows or ``BLOCK_SHINGLES`` are cut into blocks, and each two blocks meet in a task
group of their own.

Cases: null and empty texts, and texts of white space, have the empty set and are one class; fewer words than a
shingle give one shingle; the document that stays is chosen as in ``simhash``.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructField, StructType

from tillwise.llm.components import components
from tillwise.llm.simhash import classes, near_links, one_of_each
from tillwise.llm.tables import text_key
from tillwise.sources.workspace import stored

SHINGLE_WORDS = 5
HASH_SEED = 42
#: The least Jaccard index as a fraction, so that the check is one on whole numbers.
LEAST = (4, 5)
ROWS = 4
BANDS = 20
#: Rows, and shingles of all their sets, that one block of a group holds on average at most.
BLOCK = 4096
BLOCK_SHINGLES = 1 << 21
#: Shingles whose minima are taken at once, which bounds memory for very long texts.
CHUNK = 1024

_RANDOM = np.random.default_rng(5)
_FACTORS, _OFFSETS, _MIX = (_RANDOM.integers(0, 2**63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(3))


def shingle_set(text: bytes | None) -> np.ndarray:
    """Digests of the different shingles, ascending."""
    # For bytes, lower() changes A-Z only and split() cuts at 0x20 and 0x09 to 0x0D only.
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(SHINGLE_WORDS, len(words))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[i:j], HASH_SEED) for i, j in spans), np.uint64, len(words) - width + 1))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One key for each band; none for the empty set."""
    if not len(shingles):
        return np.empty(0, np.int64)
    least = np.full(ROWS * BANDS, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), CHUNK):
        least = np.minimum(least, (shingles[at : at + CHUNK, None] * _FACTORS + _OFFSETS).min(axis=0))
    # Minima of large sets are small numbers, so they are spread before they are summed up.
    spread = (least ^ (least << np.uint64(31))) * _MIX
    spread ^= spread >> np.uint64(29)
    return (spread * _FACTORS).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64).view(np.int64)


def set_fingerprint(shingles: np.ndarray) -> int:
    """SimHash of a set as a signed 64-bit number: the bits that over half of its digests have."""
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(shingles), CHUNK):
        part = shingles[at : at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(shingles), bitorder="little").view("<i8")[0])


def overlap(one: np.ndarray, other: np.ndarray) -> bool:
    """True if the Jaccard index of two sets (ascending) is at least ``LEAST``."""
    both = len(np.intersect1d(one, other, assume_unique=True))
    return LEAST[1] * both >= LEAST[0] * (len(one) + len(other) - both)


@F.arrow_udf(
    StructType([StructField("node", LongType()), StructField("size", LongType()), StructField("keys", ArrayType(LongType())), StructField("simhash", LongType())])
)
def _sketches(texts: pa.Array) -> pa.Array:
    nodes, sizes, keys, prints = [], [], [], []
    # One set at a time, so a batch of long texts needs little memory.
    for text in texts:
        found = shingle_set(text.as_py())
        nodes.append(xxhash.xxh3_64_intdigest(found.tobytes()))
        sizes.append(len(found))
        keys.append(band_keys(found))
        prints.append(set_fingerprint(found))
    columns = [np.array(nodes, np.uint64).view(np.int64), sizes, keys, prints]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["node", "size", "keys", "simhash"])


@F.arrow_udf(BinaryType())
def _sets(texts: pa.Array) -> pa.Array:
    return pa.array([shingle_set(t).astype("<u8").tobytes() for t in (x.as_py() for x in texts)], pa.binary())


@F.arrow_udf(BooleanType())
def _overlapping(ones: pa.Array, others: pa.Array) -> pa.Array:
    pairs = zip(ones.to_pylist(), others.to_pylist(), strict=True)
    return pa.array([overlap(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")) for a, b in pairs], pa.bool_())


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, doc_key (digest of the text), doc_row (of both), fingerprint (of the set), size, keys and simhash of every document."""
    found = docs.select("doc_id", text_key(F.col("text")).alias("doc_key"), _sketches(F.col("text").cast("binary")).alias("s"))
    row = _doc_row(F.col("doc_id"), F.col("doc_key")).alias("doc_row")
    return found.select("doc_id", "doc_key", row, F.col("s.node").alias("fingerprint"), "s.size", "s.keys", "s.simhash")


def _doc_row(doc_id: Column, doc_key: Column) -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("-")), F.coalesce(doc_key, F.lit("-"))))


def forest(sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links that connect all of the sets (ascending, not empty) which overlap enough, found with prefix and size filters."""
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, shingle, often = np.unique(flat, return_inverse=True, return_counts=True)
    # Two sets that overlap enough share one of each one's rarest: all but what the overlap must hold at least, and one.
    order = np.lexsort((shingle, often[shingle], owner))
    begins = np.cumsum(sizes) - sizes
    rank = np.empty(len(flat), np.int64)
    rank[order] = np.arange(len(flat)) - np.repeat(begins, sizes)
    rare = (rank < (sizes - -(-sizes * LEAST[0] // LEAST[1]) + 1)[owner]) & (often[shingle] > 1)
    posted = np.flatnonzero(rare)
    posted = posted[np.lexsort((owner[posted], shingle[posted], often[shingle[posted]]))]
    cuts = np.flatnonzero(np.diff(shingle[posted])) + 1
    root, compared = np.arange(len(sets)), set()
    for members in np.split(owner[posted], cuts):
        left = members
        while len(left) > 1:
            frontier, left = [int(left[0])], left[1:]
            while frontier and len(left):
                one = frontier.pop()
                # Those connected by now need no comparison and lead on from here.
                joined = root[left] == root[one]
                near = np.minimum(sizes[left], sizes[one]) * LEAST[1] >= np.maximum(sizes[left], sizes[one]) * LEAST[0]
                asked = [int(m) for m in left[near & ~joined] if (min(one, m), max(one, m)) not in compared]
                compared.update((min(one, m), max(one, m)) for m in asked)
                linked = []
                for at in range(0, len(asked), 64):
                    linked += _linked(sets, one, asked[at : at + 64])
                for other in linked:
                    if root[other] != root[one]:
                        yield one, other
                        root[root == root[other]] = root[one]
                reached = root[left] == root[one]
                frontier.extend(left[reached].tolist())
                left = left[~reached]


def _linked(sets: list[np.ndarray], one: int, others: list[int]) -> list[int]:
    """Those of the others whose Jaccard index with ``one`` is at least ``LEAST``."""
    sizes = np.array([len(sets[o]) for o in others])
    flat, own = np.concatenate([sets[o] for o in others]), sets[one]
    place = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    both = np.add.reduceat((own[place] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
    return [o for o, ok in zip(others, LEAST[1] * both >= LEAST[0] * (len(own) + sizes - both), strict=True) if ok]


def _group_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal (band, key, low, high); rows come sorted by these."""
    group, nodes, sets = None, [], []

    def links() -> pa.RecordBatch:
        found = list(forest(sets)) if len(sets) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([nodes[f[i]] for f in found], pa.int64()) for i in range(2)], ["a", "b"])

    for batch in batches:
        for *own, node, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != group:
                if len(nodes) > 1:
                    yield links()
                group, nodes, sets = own, [], []
            nodes.append(node)
            sets.append(np.frombuffer(packed, "<u8"))
    if len(nodes) > 1:
        yield links()


def _node_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node`` and ``set`` of the nodes of ``wanted`` (node, doc_row), each from one of its texts."""
    texts = docs.select(_doc_row(F.col("doc_id"), text_key(F.col("text"))).alias("doc_row"), F.col("text").cast("binary").alias("text"))
    # Rows repeated as a whole are dropped before their sets are made.
    return texts.join(wanted, "doc_row").dropDuplicates(["doc_row"]).select("node", _sets("text").alias("set"))


def fingerprint_links(docs: DataFrame, prints: DataFrame) -> DataFrame:
    """Links (a, b) between nodes of ``prints`` whose SimHash fingerprints are near and whose sets overlap.

    Sets of one fingerprint meet its first one, near fingerprints meet by their first ones, so checks are as many as links.
    """
    nodes = prints.filter("size > 0").groupBy("fingerprint", "simhash").agg(F.min("doc_row").alias("doc_row"))
    nodes = stored(nodes.withColumnRenamed("fingerprint", "node"), "simhash-nodes")
    first = stored(nodes.groupBy("simhash").agg(F.min("node").alias("first")), "simhash-first")
    same = nodes.join(first, "simhash").filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    ends = [first.select(F.col("simhash").alias(f"simhash_{c}"), F.col("first").alias(f"node_{c}")) for c in "ab"]
    near = near_links(first.select("simhash")).join(ends[0], F.col("a") == F.col("simhash_a")).join(ends[1], F.col("b") == F.col("simhash_b"))
    pairs = stored(same.unionByName(near.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))), "simhash-pairs")
    met = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = stored(_node_sets(docs, nodes.join(met, "node", "left_semi").select("node", "doc_row")), "simhash-sets")
    sides = [sets.select(F.col("node").alias(c), F.col("set").alias(f"set_{c}")) for c in "ab"]
    return pairs.join(sides[0], "a").join(sides[1], "b").filter(_overlapping("set_a", "set_b")).select("a", "b")


def overlap_links(docs: DataFrame, prints: DataFrame, block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Links (a, b) that connect all nodes of ``prints`` (stored ``sketches`` of ``docs``) whose sets overlap."""
    nodes = prints.groupBy("fingerprint", "size").agg(F.first("keys").alias("keys"), F.min("doc_row").alias("doc_row"))
    nodes = stored(nodes.withColumnRenamed("fingerprint", "node"), "overlap-nodes")
    by_key = ["band", "key"]
    keys = nodes.select("node", "size", F.posexplode("keys").alias(*by_key))
    members = [F.bit_xor(F.xxhash64(F.lit(seed), "node")).alias(f"members_{seed}") for seed in (1, 2)]
    groups = keys.groupBy(*by_key).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"), *members).filter("n > 1")
    # Near copies share many keys; keys with the same members are one group.
    groups = groups.groupBy("n", "shingles", "members_1", "members_2").agg(F.min(F.struct(*by_key)).alias("first"))
    parts = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("shingles") / block_shingles)).alias("parts")
    met = stored(keys.drop("size").join(groups.select("first.*", parts), by_key), "overlap-groups")

    wanted = nodes.join(met.select("node").distinct(), "node", "left_semi").select("node", "doc_row")
    sets = _node_sets(docs, wanted)
    own = F.pmod(F.xxhash64("node"), F.col("parts"))
    dealt = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    meetings = dealt.select(*by_key, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node")
    group = [*by_key, "low", "high"]
    full = meetings.join(stored(sets, "overlap-sets"), "node").repartition(*group).sortWithinPartitions(*group)
    return full.select(*group, "node", "set").mapInArrow(_group_links, "a long, b long").distinct()


def overlap_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class: the smallest doc_id, then the smallest digest of the text."""
    prints = stored(sketches(docs), "overlap-sketches")
    links = fingerprint_links(docs, prints).unionByName(overlap_links(docs, prints))
    links = stored(links, "overlap-links")
    return one_of_each(docs, classes(prints.select("doc_id", "doc_key", "fingerprint"), links))
