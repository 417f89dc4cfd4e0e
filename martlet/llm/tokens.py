"""Whole texts to token ids, through the `tokenizers` library and a word cache.

The word tokenizer drops white space and never merges across it, so a text's
ids are its words' ids in order. Words repeat far more than texts do, so each
worker keeps the ids of words it meets and joins them as little-endian unsigned
32-bit bytes. When ``MAX_WORDS`` are kept they become the old generation, of which
only the words met again move on, so rare words do not fill the cache for good.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Words whose ids one worker keeps in each of two generations.
MAX_WORDS = 500_000
#: Runs of punctuation at the ends of words whose ids one worker keeps.
MAX_MARKS = 4_096
#: Longer words are not kept.
MAX_WORD_CHARS = 40
#: Latin-1 letters followed by ASCII punctuation other than the apostrophe: the
#: normaliser and the splitter of the tokenizer leave exactly these two pieces.
PLAIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _WordIds(dict):
    """word -> ids as bytes, filled on first use."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.marks = lru_cache(maxsize=MAX_MARKS)(self.piece)
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        out = self.old.get(word)
        if out is None:
            out = self.encoded(word)
        if len(word) <= MAX_WORD_CHARS:
            if len(self) >= MAX_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = out
        return out

    def encoded(self, word: str) -> bytes:
        if not word:
            return b""
        plain = PLAIN_WORD.fullmatch(word)
        if plain is None:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        letters, marks = plain[1].lower(), plain[2]
        # other forms of a word share its letters, which are a word of the cache themselves
        out = self.piece(letters) if letters == word else self[letters]
        return out + self.marks(marks) if marks else out

    def piece(self, piece: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(piece if piece.isascii() else piece.translate(self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int | None = None) -> Callable[[str], bytes]:
    """text -> its ids (then ``end_id``) as little-endian unsigned 32-bit bytes."""
    words = _WordIds(path)
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def encode(text: str) -> bytes:
        return b"".join(map(words.__getitem__, text.replace("\n", " ").split(" "))) + end

    return encode


def id_lists(parts: list[bytes]) -> pa.ListArray:
    """One list<int32> per bytes value, without a Python object per id."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in parts], out=offsets[1:])
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def id_bytes(lists: pa.ListArray) -> list[memoryview]:
    """The ids of each list as bytes, again without an object per id."""
    offsets = np.frombuffer(lists.offsets.buffers()[1], np.int32)[lists.offsets.offset :][: len(lists) + 1]
    values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False))
    raw = memoryview(values.view(np.uint8))
    return [raw[4 * a : 4 * b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
