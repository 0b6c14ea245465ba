import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tillwise.llm import byte_bpe, pieces

PARTS = ["a", "b c", " ", "  ", "\n", "\t", "'s", "é", "日本", "\x1c", "\x85", "1", "22", "!", "?!", "<|endoftext|>",
         "\r\n", "́", "ǅ", "😀", "\x00", "A.B", "﻿", "​", " "]


@pytest.fixture(scope="module")
def reference():
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(3000)]


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_ids_are_those_of_the_ranks(texts, reference, monkeypatch):
    import pyarrow as pa

    state = pieces.encoder_state(byte_bpe.definition(), byte_bpe.PLAIN)
    monkeypatch.setattr(pieces, "SLICE_BYTES", 2000)
    monkeypatch.setattr(pieces, "KNOWN_BYTES", 5000)
    batch = pa.RecordBatch.from_arrays([pa.array([*texts, None])], ["text"])
    parts = [part for _, part in pieces.slices(batch, "text")]
    assert len(parts) > 5
    found = [ids for part in parts for ids in pieces.encode_spaced(pieces.PieceEncoder(state), part)]
    assert found == [packed(reference.encode_ordinary(t)) for t in texts] + [b""]


def test_decoding_and_split_characters(texts, reference):
    table = byte_bpe.ByteTable({"definition": byte_bpe.definition()})
    assert all(table.decode(packed(reference.encode_ordinary(t))) == t.encode() for t in texts)
    ids = reference.encode_ordinary("😀日")
    assert len(ids) > 2 and table.decode(packed(ids[:1])) + table.decode(packed(ids[1:])) == "😀日".encode()


def test_offsets_name_whole_characters(spark, documents, texts):
    from tokenizers import Tokenizer

    known = Tokenizer.from_str(byte_bpe.definition())
    known.encode_special_tokens = True
    rows = [(i, t, "s") for i, t in enumerate(texts[:300])]
    for r in byte_bpe.encode(documents(rows), offsets=True).collect():
        expected = known.encode(r.text, add_special_tokens=False).offsets
        assert [(s["first"], s["last"]) for s in r.spans] == expected


def test_odd_rows_and_clashing_columns(documents, odd_rows, reference):
    docs = documents(odd_rows, clash=True)
    encoded = byte_bpe.encode(docs)
    assert sorted(encoded.columns) == sorted(docs.columns)
    decoded = byte_bpe.decode_text(byte_bpe.decode(encoded)).collect()
    assert len(decoded) == len(odd_rows)
    for r in decoded:
        assert r.ids == packed(reference.encode_ordinary(r.text or ""))
        assert r.decoded == (r.text or "").encode() and r.decoded_text == (r.text or "")
    digests = byte_bpe.encode_documents(docs).filter("doc_id = 8").first()
    assert digests.decoded_sha256 == hashlib.sha256(odd_rows[-1][1].encode()).hexdigest()
    assert byte_bpe.encode_documents(docs.limit(0)).count() == 0
