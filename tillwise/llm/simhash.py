"""SimHash near-duplicates by pigeonring filtering.

A fingerprint's 64 bits form a ring of ``SEGMENTS`` segments.  If two fingerprints differ in at
most ``MOST_BITS`` bits, then some segment starts a chain in which the first k segments together
differ in at most ``k * MOST_BITS / SEGMENTS`` bits, for every k.  With five segments and four
bits the budgets are 0, 1, 2, 3 and 4: the first segment of the chain is equal and the second
differs in one bit at most.  Both steps are an equality join key: the pair of segments with one
bit of the second left out, one key for each of the 64 bits.  About 25 bits must agree, so a key is
shared by few unrelated fingerprints at any size.  The later steps of the chain prune what shares
a key, and the last is the full Hamming check.

Equal fingerprints are one row before the search.  Within a key only a spanning forest of the
links is written, never all pairs; it is grown from one fingerprint at a time over those not yet
reached, so a dense group of near copies costs about as many comparisons as it has rows.  Keys
with more than ``BLOCK`` fingerprints are split into blocks, and each two blocks meet in a task
group of their own, so nothing depends on one task.

Cases: null and empty texts, and texts of white space, have fingerprint zero and link like any
other; fewer words than a shingle give one shingle; repeated rows are in one class; a null
doc_id has its class, whose id is the smallest id that is not null (null if there is none); an
empty table gives an empty result; other columns are kept by ``near_dedup``.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tillwise.llm.components import components
from tillwise.llm.tables import text_key
from tillwise.sources.workspace import stored

SHINGLE_WORDS = 4
HASH_SEED = 42
MOST_BITS = 4
SEGMENTS = MOST_BITS + 1
#: Fingerprints that one block of a key holds on average at most.
BLOCK = 4096
#: Shingles hashed at once, which bounds memory for very long texts.
CHUNK = 65_536

_EDGES = [round(64 * k / SEGMENTS) for k in range(SEGMENTS + 1)]
_MASKS = [np.uint64((1 << hi) - (1 << lo)) for lo, hi in zip(_EDGES, _EDGES[1:], strict=False)]
_BUDGETS = [(k + 1) * MOST_BITS // SEGMENTS for k in range(SEGMENTS)]


def fingerprint(text: bytes | None) -> int:
    """The fingerprint as a signed 64-bit number."""
    # For bytes, lower() changes A-Z only and split() cuts at 0x20 and 0x09 to 0x0D only.
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(SHINGLE_WORDS, len(words))
    first, last = starts[: len(words) - width + 1], ends[width - 1 :]
    set_bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), CHUNK):
        spans = zip(first[at : at + CHUNK].tolist(), last[at : at + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[i:j], HASH_SEED) for i, j in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * set_bits > len(first), bitorder="little")
    return int(majority.view("<i8")[0])


@F.arrow_udf(LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array([fingerprint(t) for t in texts.to_pylist()], pa.int64())


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, doc_key (digest of the text) and fingerprint of every document."""
    return docs.select(
        "doc_id",
        text_key(F.col("text")).alias("doc_key"),
        _fingerprints(F.col("text").cast("binary")).alias("fingerprint"),
    )


def _chain_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        keys = []
        for start in range(SEGMENTS):
            after = (start + 1) % SEGMENTS
            first = (values & _MASKS[start]) >> np.uint64(_EDGES[start])
            second = (values & _MASKS[after]) >> np.uint64(_EDGES[after])
            for bit in range(_EDGES[after + 1] - _EDGES[after]):
                left_out = second & ~np.uint64(1 << bit)
                keys.append(np.uint64(start << 48 | bit << 40) | first << np.uint64(16) | left_out)
        columns = [np.concatenate(keys).view(np.int64), np.tile(values.view(np.int64), len(keys))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["chain", "fingerprint"])


def _linked(one: np.uint64, others: np.ndarray, start: int) -> np.ndarray:
    """Positions of ``others`` that pass every step of the chain from ``start`` with ``one``."""
    alive = np.arange(len(others))
    differ = others ^ one
    used = np.zeros(len(others), np.uint8)
    for step, budget in enumerate(_BUDGETS):
        used = used + np.bitwise_count(differ & _MASKS[(start + step) % SEGMENTS])
        fits = used <= budget
        if not fits.all():
            alive, differ, used = alive[fits], differ[fits], used[fits]
    return alive


def _forest(values: np.ndarray, start: int) -> Iterator[tuple[int, np.ndarray]]:
    """A spanning forest of the links among ``values``: nodes with those first reached from them."""
    left = values
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            one = frontier.pop()
            reached = _linked(one, left, start)
            if len(reached):
                found = left[reached]
                yield one, found
                frontier.extend(found)
                left = np.delete(left, reached)


def _group_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal (chain, low, high); rows come sorted by these."""
    held = [np.empty(0, np.int64)] * 4

    def links(columns: list[np.ndarray]) -> pa.RecordBatch:
        chain, low, high, values = columns
        new = np.flatnonzero((np.diff(chain) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)) + 1
        starts, ends = np.concatenate(([0], new)), np.concatenate((new, [len(chain)]))
        a, b = [], []
        for i, j in zip(*(x[ends - starts > 1].tolist() for x in (starts, ends)), strict=True):
            for one, found in _forest(values[i:j].view(np.uint64), int(chain[i] >> 48)):
                a.append(np.full(len(found), one))
                b.append(found)
        sides = [np.concatenate(x).view(np.int64) if x else np.empty(0, np.int64) for x in (a, b)]
        return pa.RecordBatch.from_arrays([pa.array(s) for s in sides], ["a", "b"])

    for batch in batches:
        columns = [np.concatenate(x) for x in zip(held, (c.to_numpy() for c in batch.columns), strict=True)]
        if not len(columns[0]):
            continue
        same = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1]) & (columns[2] == columns[2][-1])
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        held = [c[cut:] for c in columns]
        if cut:
            yield links([c[:cut] for c in columns])
    if len(held[0]):
        yield links(held)


def near_links(distinct: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect all fingerprints within ``MOST_BITS`` of each other.

    ``distinct`` has one column of different fingerprints.  The links are a subset of all pairs
    with the same connected components.
    """
    keys = distinct.mapInArrow(_chain_keys, "chain long, fingerprint long")
    crowded = stored(
        keys.groupBy("chain").count().filter(F.col("count") > block).select(
            "chain", F.ceil(F.col("count") / block).alias("parts")
        ),
        "crowded-chains",
    )
    parts = F.coalesce(F.col("parts"), F.lit(1))
    own = F.pmod(F.xxhash64("fingerprint"), parts)
    met = (
        keys.join(crowded, "chain", "left")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        .select("chain", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fingerprint")
    )
    group = ["chain", "low", "high"]
    dealt = met.repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(_group_links, "a long, b long").distinct()


def classes(prints: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Rows of ``fingerprints`` with ``root`` (a fingerprint that names the class) and ``component_id``.

    ``links`` between fingerprints are those of ``near_links`` unless given.
    """
    distinct = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")), "distinct-prints")
    roots = components(near_links(distinct.select("fingerprint")) if links is None else links)
    named = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least_id", F.coalesce("root", "fingerprint").alias("root")
    )
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    found = stored(named.join(least, "root").select("fingerprint", "root", "component_id"), "print-classes")
    return prints.join(found, "fingerprint")


def near_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class: the smallest doc_id, then the smallest digest of the text."""
    return one_of_each(docs, classes(stored(fingerprints(docs), "fingerprints")))


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The document of each class of ``found`` that stays."""
    first = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    rows = first.groupBy("root", "doc_id", "doc_key").agg(F.count(F.lit(1)).alias("n"))
    keep = rows.groupBy("root").agg(F.min(F.struct("doc_id", "doc_key", "n")).alias("keep")).select("keep.*")
    text = F.col("doc.text")
    same = F.col("doc.doc_id").eqNullSafe(F.col("keep.doc_id")) & text_key(text).eqNullSafe(F.col("keep.doc_key"))
    kept = stored(docs.select(F.struct("*").alias("doc")).join(keep.alias("keep"), same).select("doc", "n"), "kept-rows")
    # Rows equal in id and text are one class; the first of them as JSON stays, which any column has.
    again = kept.filter("n > 1").withColumn("json", F.to_json("doc"))
    one = again.groupBy(F.col("doc.doc_id"), text_key(text)).agg(F.min_by("doc", "json").alias("doc"))
    return kept.filter("n = 1").select("doc.*").unionByName(one.select("doc.*"))
