import heapq
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from tillwise.llm import huffman, pieces
from tillwise.sources.workspace import new_folder, stored


def unlimited(counts):
    """Total bits of a Huffman code without a limit."""
    heap, total = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        joined = heapq.heappop(heap) + heapq.heappop(heap)
        total += joined
        heapq.heappush(heap, joined)
    return total


def test_code_lengths():
    rng = np.random.default_rng(2)
    counts = rng.integers(1, 1000, 300)
    bits = huffman.code_lengths(counts, 20)
    assert (counts * bits).sum() == unlimited(counts.tolist())
    steep = np.array([2**i for i in range(40)])
    bits = huffman.code_lengths(steep, 8)
    assert bits.max() == 8 and (0.5**bits).sum() <= 1
    assert huffman.code_lengths(np.array([5]), 4).tolist() == [1]
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9, np.int64), 3)


@pytest.mark.parametrize("n", [1, 2, huffman.STEP, huffman.STEP + 1, 5000])
def test_blocks_come_back(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 70_000)
    used, counts = np.unique(ids, return_counts=True)
    book = huffman.CodeBook(used, huffman.code_lengths(counts))
    checkpoints, payload = huffman.pack(ids, *book.encoder())
    assert (huffman.unpack(checkpoints, payload, n, book.width, book.table()) == ids).all()


def test_codes_are_canonical():
    book = huffman.CodeBook(np.array([7, 3, 9, 1]), np.array([2, 1, 3, 3]))
    assert book.ids.tolist() == [3, 7, 1, 9] and book.codes.tolist() == [0b0, 0b10, 0b110, 0b111]


def files(spark, docs):
    path = new_folder(spark, "token-files")
    huffman.write(stored(huffman.token_ids(docs), "ids"), path)
    return huffman.read_documents(spark, path)


def test_files_hold_what_was_written(spark, documents, odd_rows, monkeypatch):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(public_tokenizers.path(huffman.DEFINITION))
    monkeypatch.setattr(huffman, "BLOCK_IDS", 50)
    rng = random.Random(4)
    rows = [r for r in odd_rows if r[0] not in (None, 3)]
    rows += [(100 + i, " ".join(rng.choices(["The", "cat's", "naïve", "42", "日本"], k=i % 9)), "s") for i in range(80)]
    rng.shuffle(rows)
    found = {r.doc_id: r for r in files(spark, documents(rows, clash=True)).collect()}
    start = 0
    for i, text, _ in sorted(rows):
        ids = [*known.encode(text or "", add_special_tokens=False).ids, huffman.END_ID]
        r = found.pop(i)
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert zlib.crc32(r.ids) == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert not found


#: Signs, marks, letters whose lower case or composed form holds a mark, special tokens in whole and in part.
ODD = (
    ". , ' \" - ! … ? <|endoftext|> <|startoftext|> <|ENDOFTEXT|> <|endof <| |> İ I ı ß ẞ é e\u0301 \u0307 \u0323 \u0958 \ufb1d \u0915\u093c ﬁ ǅ Ω Å "
    "'s 'LL it's 42 ４２ ² ½ 日本 한국 \u1112\u1161 😀 👩\u200d👩 \u200b \ufeff a B word Word. end, x.y a,b .. ,, \x1f \x85 \xa0 \u3000 \u2028 \t \r \x0b"
).split(" ")


@pytest.mark.parametrize("known_bytes", [pieces.KNOWN_BYTES, 5000])
def test_ids_are_the_library_s(monkeypatch, known_bytes):
    """50,000 odd texts; once with a table of known pieces that is full all the time."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(pieces, "KNOWN_BYTES", known_bytes)
    path, rng = public_tokenizers.path(huffman.DEFINITION), random.Random(known_bytes)
    known = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        state = pieces.encoder_state(file.read(), huffman.PLAIN, "H", special_as_text=False, word_end="</w>")
    encoder = pieces.PieceEncoder(state)
    join = lambda: "".join(rng.choice(ODD) + rng.choice(["", "", " ", "\n", "  "]) for _ in range(rng.randrange(9)))
    texts = [join() for _ in range(50_000 if known_bytes > 5000 else 5000)] + ["long" * 40 + " " + "日本" * 200]
    for at in range(0, len(texts), 2500):
        part = texts[at : at + 2500]
        expected = [e.ids for e in known.encode_batch(part, add_special_tokens=False)]
        found = [np.frombuffer(b, "H").tolist() for b in pieces.encode_words(encoder, pa.array(part))]
        assert [t for t, x, y in zip(part, found, expected, strict=True) if x != y] == []
    assert max(map(len, state["recent"]), default=0) <= pieces.LONG


def test_known_pieces_are_bounded_by_bytes(monkeypatch):
    """Texts without spaces are pieces of their own and are not kept; many short ones push out the older."""
    monkeypatch.setattr(pieces, "KNOWN_BYTES", 20_000)
    with open(public_tokenizers.path(huffman.DEFINITION), encoding="utf-8") as file:
        state = pieces.encoder_state(file.read(), huffman.PLAIN, "H", special_as_text=False, word_end="</w>")
    encoder = pieces.PieceEncoder(state)
    for k in range(50):
        texts = pa.array([f"{chr(0x4E00 + k) * 500}{i} word{k}x{i}" for i in range(50)])
        pieces.encode_words(encoder, texts)
        kept = [*state["recent"].items(), *state["earlier"].items()]
        assert sum(len(p) + len(i) + pieces.ENTRY_BYTES for p, i in kept) < 3 * 20_000 and max(len(p) for p, _ in kept) <= pieces.LONG


def test_null_ids_repeated_rows_and_empty_tables(spark, documents, odd_rows):
    found = files(spark, documents(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    assert [r.start for r in found if r.doc_id is None][0] < min(r.start for r in found if r.doc_id is not None)
    ends = sorted((r.start, r.start + r.n_tokens) for r in found)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))
    assert files(spark, documents(odd_rows).limit(0)).count() == 0
