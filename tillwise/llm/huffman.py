"""Token ids in files: canonical length-limited Huffman coding.

Ids are counted over all documents, code lengths come from package-merge under ``MOST_BITS``, and
codes are canonical, so the code book is just (id, bits).  Documents are sorted by id over range
partitions and written as blocks of about ``BLOCK_IDS`` ids.  A block stands alone: its bits start
anew, and checkpoints give the bit position of every ``STEP``-th id, so decoding goes through a
table of 2^``MOST_BITS`` entries from all checkpoints in step.

A folder holds two Parquet tables, written by Spark's committer: ``codebook`` (id, bits) and
``blocks`` (part, block, first, doc_ids, doc_tokens, n_ids, checkpoints, payload); first is the
number of ids in the part before the block.  Parts follow each other in doc_id order.

Cases: strings of special tokens in a text are those tokens, as the library has it; null and empty texts have the end id alone; null doc_ids come first; documents with one
doc_id stand together, ordered by a hash of their ids; repeated rows are written each; an empty
table gives files without blocks; other columns are not stored.
"""

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.pieces import PieceEncoder, encode_words, encoder_state, slices
from tillwise.sources.workspace import stored

DEFINITION = "word_bpe_49k.json"
#: Pieces of one word that the normalizer leaves as they are.
PLAIN = "[a-zß-öø-ÿ]+"
END_ID = 1
MOST_BITS = 18
BLOCK_IDS = 65_536
STEP = 128
BLOCKS = (
    "part int, block int, first long, doc_ids array<long>, doc_tokens array<int>, n_ids long, "
    "checkpoints binary, payload binary"
)


def token_ids(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """doc_id, n_tokens, tie and ids: packed numbers with the end id, as a zstd frame."""
    with open(path or public_tokenizers.path(DEFINITION), encoding="utf-8") as file:
        definition = file.read()
    largest = max([end_id, *json.loads(definition)["model"]["vocab"].values()])
    typecode = "H" if largest < 2**16 else "I"
    encoder = docs.sparkSession.sparkContext.broadcast(
        encoder_state(definition, PLAIN, typecode, special_as_text=False, word_end=json.loads(definition)["model"]["end_of_word_suffix"])
    )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, codec = PieceEncoder(encoder.value), pa.Codec("zstd", 1)
        kind = np.dtype(own.typecode)
        end = kind.type(end_id).tobytes()
        for batch in batches:
            for part, texts in slices(batch, "text"):
                rows = [ids + end for ids in encode_words(own, texts)]
                counts = pa.array([len(r) // kind.itemsize for r in rows], pa.int64())
                packed = pa.array([kind.char.encode() + codec.compress(r, asbytes=True) for r in rows], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), counts, packed], ["doc_id", "n_tokens", "ids"])

    rows = docs.select("doc_id", "text").mapInArrow(encoded, "doc_id long, n_tokens long, ids binary")
    return rows.select("doc_id", "n_tokens", F.xxhash64("ids").alias("tie"), "ids")


def _unpacked(packed: bytes, n_tokens: int) -> np.ndarray:
    kind = np.dtype(packed[:1].decode())
    raw = pa.Codec("zstd").decompress(packed[1:], n_tokens * kind.itemsize, asbytes=True)
    return np.frombuffer(raw, kind)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, held, waiting = np.zeros(0, np.int64), [], 0

    def summed() -> np.ndarray:
        own = np.bincount(np.concatenate(held)) if held else np.zeros(0, np.int64)
        size = max(len(own), len(counts))
        return np.pad(own, (0, size - len(own))) + np.pad(counts, (0, size - len(counts)))

    for batch in batches:
        for n, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.append(_unpacked(packed, n))
            waiting += n
            if waiting >= 16 * BLOCK_IDS:
                counts, held, waiting = summed(), [], 0
    counts = summed()
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(counts[used])], ["id", "count"])


def id_counts(tokens: DataFrame) -> DataFrame:
    """id, count over all documents; each task sends one row per id at most."""
    parts = tokens.select("n_tokens", "ids").mapInArrow(_counted, "id long, count long")
    return parts.groupBy("id").agg(F.sum("count").alias("count"))


def code_lengths(counts: np.ndarray, most_bits: int = MOST_BITS) -> np.ndarray:
    """Bits of each symbol's code, at most ``most_bits``, with the least total (package-merge)."""
    n = len(counts)
    if n > 1 << most_bits:
        raise ValueError(f"{n} symbols need more than {most_bits} bits")
    if n < 2:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    weights = np.asarray(counts, np.int64)[order]
    packages, leaves = weights[:0], []
    for _ in range(most_bits):
        merged = np.concatenate((weights, packages))
        rank = np.argsort(merged, kind="stable")
        leaves.append(rank < n)
        merged = merged[rank]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    lengths, wanted = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(leaves):
        single = int(is_leaf[:wanted].sum())
        lengths[:single] += 1
        wanted = 2 * (wanted - single)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class CodeBook:
    """Canonical codes: by length, then id."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray) -> None:
        order = np.lexsort((ids, bits))
        self.ids, self.bits = np.asarray(ids, np.int64)[order], np.asarray(bits, np.int64)[order]
        self.width = int(self.bits.max(initial=1))
        room = np.left_shift(1, self.width - self.bits)
        self.codes = (np.cumsum(room) - room) >> (self.width - self.bits)

    def encoder(self) -> tuple[np.ndarray, np.ndarray]:
        """Code and length by id."""
        codes, lengths = (np.zeros(int(self.ids.max(initial=0)) + 1, np.uint64) for _ in range(2))
        codes[self.ids], lengths[self.ids] = self.codes, self.bits
        return codes, lengths

    def table(self) -> np.ndarray:
        """64 times the id plus the length, by the next ``width`` bits."""
        room = np.left_shift(1, self.width - self.bits)
        table = np.ones(1 << self.width, np.int64)
        table[: room.sum()] = np.repeat(self.ids * 64 + self.bits, room)
        return table


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """Checkpoints and payload of a block."""
    bits = lengths[ids]
    ends = np.cumsum(bits)
    begins = ends - bits
    # A code touches two 32-bit words at most; no two codes share a bit, so sums join them.
    shifted = codes[ids] << (np.uint64(64) - bits - (begins & np.uint64(31)))
    word = (begins >> np.uint64(5)).astype(np.int64)
    n_words = int(word[-1]) + 2
    high = np.bincount(word, (shifted >> np.uint64(32)).astype(np.float64), n_words)
    low = np.bincount(word + 1, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), n_words)
    payload = (high + low).astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8]
    return begins[::STEP].astype("<u8").tobytes(), payload


def unpack(checkpoints: bytes, payload: bytes, n_ids: int, width: int, table: np.ndarray) -> np.ndarray:
    """The ids of a block: from every checkpoint ``STEP`` ids, all checkpoints in step."""
    at = np.frombuffer(checkpoints, "<u8").astype(np.int64)
    raw = np.frombuffer(payload + bytes(STEP * width // 8 + 8), np.uint8).astype(np.int64)
    words = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    found, mask = np.empty((STEP, len(at)), np.uint32), (1 << width) - 1
    for k in range(STEP):
        entry = table[(words[at >> 3] >> (32 - width - (at & 7))) & mask]
        found[k] = entry >> 6
        at += entry & 63
    return found.T.reshape(-1)[:n_ids]


def write(tokens: DataFrame, path: str) -> None:
    """Write the rows of ``token_ids`` to ``path``."""
    spark = tokens.sparkSession
    # One row per id of the vocabulary, which bounds what comes to the driver.
    counted = id_counts(tokens).toPandas()
    ids, counts = counted["id"].to_numpy(np.int64), counted["count"].to_numpy(np.int64)
    book = CodeBook(ids, code_lengths(counts))
    rows = [(int(i), int(b)) for i, b in zip(book.ids, book.bits, strict=True)]
    spark.createDataFrame(rows, "id long, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    coder = spark.sparkContext.broadcast(book.encoder())

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, lengths = coder.value
        part, block, first = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[int | None, np.ndarray]] = []

        def closed() -> pa.RecordBatch:
            sizes = [len(d) for _, d in held]
            checkpoints, payload = pack(np.concatenate([d for _, d in held]), codes, lengths)
            row = [part, block, first, [i for i, _ in held], sizes, sum(sizes), checkpoints, payload]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary())
            names = [c.split()[0] for c in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        waiting = 0
        for batch in batches:
            for doc_id, n, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append((doc_id, _unpacked(packed, n)))
                waiting += n
                if waiting >= BLOCK_IDS:
                    yield closed()
                    block, first, waiting = block + 1, first + waiting, 0
                    held.clear()
        if held:
            yield closed()

    ordered = tokens.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "n_tokens", "ids").mapInArrow(blocks, BLOCKS).write.parquet(f"{path}/blocks")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids (packed 32-bit) from the files, decoded."""
    book = spark.read.parquet(f"{path}/codebook").toPandas()
    book = CodeBook(book["id"].to_numpy(np.int64), book["bits"].to_numpy(np.int64))
    tables = spark.sparkContext.broadcast((book.width, book.table()))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["checkpoints"], row["payload"], row["n_ids"], *tables.value).astype("<u4")
                ends = np.cumsum(row["doc_tokens"])
                starts = ends - np.array(row["doc_tokens"])
                texts = [ids[i:j].tobytes() for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [
                    pa.array([row["part"]] * len(texts), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + row["first"], pa.int64()),
                    pa.array(row["doc_tokens"], pa.int64()),
                    pa.array(texts, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "inside", "n_tokens", "ids"])

    blocks = spark.read.parquet(f"{path}/blocks")
    # One row per part, and parts are range partitions, so this window is small.
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    begins = stored(totals.select("part", F.coalesce(before, F.lit(0)).alias("begin")), "part-begins")
    kind = "part int, doc_id long, inside long, n_tokens long, ids binary"
    docs = blocks.mapInArrow(documents, kind).join(begins, "part")
    return docs.select("doc_id", (F.col("begin") + F.col("inside")).alias("start"), "n_tokens", "ids")
