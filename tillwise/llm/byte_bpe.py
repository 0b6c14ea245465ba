"""Byte-level BPE encoding and decoding.

Ids are packed as little-endian unsigned 32-bit numbers in a binary column, which is what digests
and files need and costs a quarter of an array of longs.  Each token stands for some bytes: the
vocabulary writes every byte as one printable character, and that table, reversed, gives the bytes
back.  A token may hold part of a character; offsets then name the whole character, and decoding
joins bytes before it reads characters.

Cases: a null or empty text has no ids and decodes to no bytes; strings of special tokens are
ordinary text; an id outside the vocabulary raises an error; bytes that are no whole
character become U+FFFD in decoded text; repeated rows are encoded each; an empty table gives
an empty result; other columns are kept, those named like a result are replaced.
"""

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.pieces import PieceEncoder, encode_spaced, encoder_state, slices

DEFINITION = "byte_bpe_50k.json"
#: Rows that are decoded before they are sent on.
DECODED_ROWS = 2000
#: Pieces that are one match of the tokenizer's pattern.
PLAIN = " ?[A-Za-zÀ-ÖØ-öø-ÿ]+"


def byte_characters() -> dict[str, int]:
    """The byte each vocabulary character stands for.

    Printable Latin-1 bytes are themselves; the others take the characters from U+0100 on, in order.
    """
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTable:
    """The bytes of every id; ``state`` is the value of a broadcast, which keeps them for a worker's tasks."""

    def __init__(self, state: dict) -> None:
        if "tokens" not in state:
            to_byte, known = byte_characters(), json.loads(state["definition"])
            names = {i: bytes(to_byte[c] for c in name) for name, i in known["model"]["vocab"].items()}
            names |= {t["id"]: t["content"].encode() for t in known.get("added_tokens", []) if t["id"] not in names}
            state["tokens"] = [names.get(i, b"") for i in range(max(names) + 1)]
            state["lengths"] = np.fromiter(map(len, state["tokens"]), np.int64, len(state["tokens"]))
        self.tokens, self.lengths = state["tokens"], state["lengths"]

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, array("I", packed)))

    def spans(self, text: str | None, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First and last character (exclusive) of each token; a split character belongs to each part."""
        ends = np.cumsum(self.lengths[np.frombuffer(packed, "<u4")])
        raw = np.frombuffer((text or "").encode(), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        return character[starts], character[ends - 1] + 1


def definition(path: str | None = None) -> str:
    with open(path or public_tokenizers.path(DEFINITION), encoding="utf-8") as file:
        return file.read()


def _mapped(rows: DataFrame, made: dict[str, str], work) -> DataFrame:
    """``rows`` with the columns ``made`` (name to type) that ``work`` yields for each part of a batch.

    ``work`` takes a batch and yields parts of it with the arrays of the new columns.
    """
    kept = [f for f in rows.schema if f.name.lower() not in made]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{n} {t}" for n, t in made.items()])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, arrays in work(batch):
                names = [n for n in part.schema.names if n.lower() not in made]
                columns = [part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, *arrays], [*names, *made])

    return rows.mapInArrow(mapped, schema)


def encode(docs: DataFrame, path: str | None = None, offsets: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (packed) of the whole texts; with ``offsets`` also ``spans``.

    ``spans`` is an array of (first, last) characters, last exclusive.  ``path`` names a tokenizer file.
    """
    known, context = definition(path), docs.sparkSession.sparkContext
    encoder, table = context.broadcast(encoder_state(known, PLAIN)), context.broadcast({"definition": known})

    def encoded(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        for part, texts in slices(batch, "text"):
            ids = encode_spaced(PieceEncoder(encoder.value), texts)
            arrays = [pa.array(ids, pa.binary())]
            if offsets:
                bytes_of, rows = ByteTable(table.value), []
                for text, own in zip(texts.to_pylist(), ids, strict=True):
                    both = zip(*(x.tolist() for x in bytes_of.spans(text, own)), strict=True)
                    rows.append([{"first": i, "last": j} for i, j in both])
                arrays.append(pa.array(rows, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))))
            yield part, arrays

    spans = {"spans": "array<struct<first:int,last:int>>"} if offsets else {}
    return _mapped(docs, {"ids": "binary"} | spans, encoded)


def _decoded(encoded: DataFrame, path: str | None, name: str, kind: pa.DataType, read) -> DataFrame:
    table = encoded.sparkSession.sparkContext.broadcast({"definition": definition(path)})

    def decoded(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        bytes_of = ByteTable(table.value)
        for low in range(0, batch.num_rows, DECODED_ROWS):
            part = batch.slice(low, DECODED_ROWS)
            raw = [bytes_of.decode(p or b"") for p in part.column("ids").to_pylist()]
            yield part, [pa.array([read(r) for r in raw], kind)]

    return _mapped(encoded, {name: "binary" if kind == pa.binary() else "string"}, decoded)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ``ids``."""
    return _decoded(encoded, path, "decoded", pa.binary(), lambda raw: raw)


def decode_text(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded_text``; parts of characters at either end become U+FFFD."""
    return _decoded(encoded, path, "decoded_text", pa.string(), lambda raw: raw.decode("utf-8", "replace"))


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids, n_tokens, ids_sha256 and decoded_sha256 after the round trip, both ways in one pass."""
    known, context = definition(path), docs.sparkSession.sparkContext
    encoder, table = context.broadcast(encoder_state(known, PLAIN)), context.broadcast({"definition": known})

    def both_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = ByteTable(table.value)
        for batch in batches:
            for part, texts in slices(batch, "text"):
                ids = encode_spaced(PieceEncoder(encoder.value), texts)
                back = [bytes_of.decode(p) for p in ids]
                arrays = [part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(back, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "decoded"])

    done = docs.select("doc_id", "text").mapInArrow(both_ways, "doc_id long, ids binary, decoded binary")
    return done.select(
        "doc_id",
        "ids",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
