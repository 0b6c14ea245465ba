"""Fast encoding with a public tokenizer: each different piece of a batch is encoded once.

Texts are cut where no token can reach across; a batch's different pieces are found on Arrow
columns, unknown ones go through the tokenizers library together, and the ids are put together
with numpy.  The tokenizer's definition is broadcast; a worker keeps the tokenizer and its table of known
pieces, whose size is bounded, beside it for all its tasks.
"""

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A worker remembers pieces of up to about twice as many bytes, those in use longest; no piece of more than ``LONG`` letters.
KNOWN_BYTES = 32 << 20
LONG = 64
#: What an entry takes besides its letters and ids.
ENTRY_BYTES = 200
#: Bytes of text that are worked on at once (a longer text alone).
SLICE_BYTES = 4 << 20

#: White space other than the space and the newline.
_RARE_SPACE = "\\t\\r\\f\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
#: Texts in which every space and newline stands alone between other characters are regular.
_IRREGULAR = f"[ \\n][ \\n]|^[ \\n]|[ \\n]$|[{_RARE_SPACE}]"
_BEFORE_WORD = re.compile(r"(?<=\S)(?= \S)")


def encoder_state(definition: str, plain: str, typecode: str = "I", *, special_as_text: bool = True, word_end: str | None = None) -> dict:
    """What to broadcast for a tokenizer file's content; ``typecode`` as in array: "H" or "I" for 16 or 32 bits.

    Pieces that match the pattern ``plain`` are not changed by the tokenizer's normalizer and not
    cut by its pattern.  With ``word_end``, the last token of each of them and no other ends so, and spaces separate
    pieces, so many go through the tokenizer as one text.  ``special_as_text``: strings of special tokens in a text are
    ordinary text.  A plain dict, which every worker fills with its tokenizers and known pieces.
    """
    ends = None
    if word_end:
        vocabulary = json.loads(definition)["model"]["vocab"]
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for name, i in vocabulary.items() if name.endswith(word_end)]] = True
    own = {"plain": plain, "typecode": typecode, "special_as_text": special_as_text, "ends": ends, "loose": _loose_letters()}
    return {"definition": definition, **own, "recent": {}, "earlier": {}, "held": 0}


@lru_cache(maxsize=1)
def _loose_letters() -> str:
    """Letters of which composing or lower-casing makes a mark, which belongs to the signs that follow."""
    every = (chr(c) for c in range(0x80, 0x30000) if not 0xD800 <= c < 0xE000)
    marks = lambda c: any(unicodedata.category(x)[0] == "M" for x in c)
    return "".join(c for c in every if not marks(c) and marks(unicodedata.normalize("NFC", c).lower()))


class PieceEncoder:
    """Encodes Arrow columns of texts; ``state`` is the value of a broadcast made by ``encoder_state``."""

    def __init__(self, state: dict) -> None:
        self.state, self.typecode = state, state["typecode"]

    def _tokenizers(self) -> tuple:
        """The tokenizer, and one that goes straight to the merges, for plain pieces."""
        if "tokenizers" not in self.state:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            whole = Tokenizer.from_str(self.state["definition"])
            whole.encode_special_tokens = self.state["special_as_text"]
            bytes_only = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
            spaced = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, bytes_only]}
            known = json.loads(self.state["definition"])
            known |= {"normalizer": None, "pre_tokenizer": bytes_only if self.state["ends"] is None else spaced}
            self.state["tokenizers"] = (whole, Tokenizer.from_str(json.dumps(known)))
        return self.state["tokenizers"]

    def _encode(self, tokenizer, pieces: list[str], into: dict) -> None:
        for at in range(0, len(pieces), 2048):
            part = pieces[at : at + 2048]
            for piece, found in zip(part, tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                into[piece] = array(self.typecode, found.ids).tobytes()

    def _encode_plain(self, straight, pieces: list[str], into: dict) -> None:
        if self.state["ends"] is None:
            return self._encode(straight, pieces, into)
        size = np.dtype(self.typecode).itemsize
        for at in range(0, len(pieces), 8192):
            part = pieces[at : at + 8192]
            lines = [" ".join(part[i : i + 64]) for i in range(0, len(part), 64)]
            ids = np.concatenate([np.array(e.ids, self.typecode) for e in straight.encode_batch_fast(lines, add_special_tokens=False)])
            cuts = (np.flatnonzero(self.state["ends"][ids]) + 1) * size
            if len(cuts) != len(part):
                raise ValueError("a token inside a piece ends like a word")
            raw, begin = ids.tobytes(), 0
            for piece, end in zip(part, cuts.tolist(), strict=True):
                into[piece] = raw[begin:end]
                begin = end

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece as packed numbers."""
        state = self.state
        if state["held"] > KNOWN_BYTES:
            # What is still in use comes back from the earlier pieces; what is not goes next time.
            state["earlier"], state["recent"], state["held"] = state["recent"], {}, 0
        recent, earlier = state["recent"], state["earlier"]
        packed = list(map(recent.get, pieces))
        fresh = {p: earlier.get(p) for p, ids in zip(pieces, packed, strict=True) if ids is None}
        if not fresh:
            return packed
        missing = [p for p, ids in fresh.items() if ids is None]
        if missing:
            plain = re.compile(state["plain"]).fullmatch
            is_plain = [plain(p) is not None for p in missing]
            whole, straight = self._tokenizers()
            self._encode_plain(straight, list(compress(missing, is_plain)), fresh)
            self._encode(whole, [p for p, known in zip(missing, is_plain, strict=True) if not known], fresh)
        kept = fresh if max(map(len, fresh)) <= LONG else {p: ids for p, ids in fresh.items() if len(p) <= LONG}
        recent.update(kept)
        state["held"] += sum(map(len, kept)) + sum(map(len, kept.values())) + ENTRY_BYTES * len(kept)
        return [fresh[p] if ids is None else ids for p, ids in zip(pieces, packed, strict=True)]

    def joined(self, packed: list[bytes], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces ``packed[i]`` for i in ``index`` one after another, and where each begins."""
        size = np.dtype(self.typecode).itemsize
        lengths = np.fromiter(map(len, packed), np.int64, len(packed)) // size
        ids = np.frombuffer(b"".join(packed), self.typecode)
        begins = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        each = lengths[index]
        ends = np.concatenate(([0], np.cumsum(each)))
        where = np.repeat(begins[index] - ends[:-1], each) + np.arange(ends[-1])
        return ids[where], ends


def slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of a batch with about ``SLICE_BYTES`` of text each, and their texts, null as empty.

    What is made of a part can be sent before the next is begun, so memory follows the part.
    """
    texts = pc.fill_null(batch.column(column), "")
    total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = np.flatnonzero(np.diff(total // SLICE_BYTES)) + 1
    for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)], strict=True):
        if j > i:
            yield batch.slice(i, j - i), texts.slice(i, j - i)


def _packed(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The ids of each text, given where each ends."""
    view, size = memoryview(ids.tobytes()), ids.itemsize
    return [bytes(view[i * size : j * size]) for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


#: Texts in which a stop or comma may touch other signs, or letters may compose with marks.
_JOINED = "[^\\s\\pL\\pN]{2}|'|\\pM"


def encode_words(encoder: PieceEncoder, texts: pa.Array) -> list[bytes]:
    """For tokenizers that lower the case, drop white space and never join what it separates.

    Where signs stand alone, stops and commas are pieces of their own and ASCII letters are lowered
    first, so that fewer pieces differ.
    """
    loose = encoder.state["loose"]
    joined = pc.match_substring_regex(texts, f"{_JOINED}|[{loose}]" if loose else _JOINED)
    split = pc.replace_substring(pc.replace_substring(pc.ascii_lower(texts), ".", " . "), ",", " , ")
    words = pc.split_pattern(pc.replace_substring(pc.if_else(joined, texts, split), "\n", " "), " ")
    coded = words.flatten().dictionary_encode()
    packed = encoder.ids_of(coded.dictionary.to_pylist())
    ids, ends = encoder.joined(packed, coded.indices.to_numpy())
    return _packed(ids, ends[words.offsets.to_numpy() - words.offsets[0].as_py()])


def _encode_regular(encoder: PieceEncoder, texts: pa.Array) -> list[bytes]:
    pieces = pc.split_pattern(pc.replace_substring(texts, "\n", " \n "), " ")
    flat, offsets = pieces.flatten(), pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
    newline = pc.equal(flat, "\n").to_numpy(zero_copy_only=False)
    # Without a space before them: newlines, what follows one, and the first piece of a text.
    bare = newline.copy()
    bare[1:] |= newline[:-1]
    bare[offsets[:-1]] = True
    coded = flat.dictionary_encode()
    words, index = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
    both = index * 2 + bare
    used, place = np.unique(both, return_inverse=True)
    packed = encoder.ids_of([words[u >> 1] if u & 1 else f" {words[u >> 1]}" for u in used.tolist()])
    ids, ends = encoder.joined(packed, place)
    return _packed(ids, ends[offsets])


def encode_spaced(encoder: PieceEncoder, texts: pa.Array) -> list[bytes]:
    """For byte-level tokenizers whose tokens hold at most the one space before a word.

    Texts are cut before each single space between two other characters, and regular ones
    around their newlines; no match of the tokenizer's pattern reaches across these places.
    """
    odd = pc.match_substring_regex(texts, _IRREGULAR).to_numpy(zero_copy_only=False)
    regular = iter(_encode_regular(encoder, texts.filter(pa.array(~odd))) if not odd.all() else [])
    cut = iter([_BEFORE_WORD.split(t) for t in texts.filter(pa.array(odd)).to_pylist()])
    return [b"".join(encoder.ids_of(next(cut))) if o else next(regular) for o in odd]
