"""Subword ids from a public tokenizer file, fast enough for whole corpora."""

from __future__ import annotations

import os
import re
import string
import unicodedata
from array import array
from functools import cache

import numpy as np
import pyarrow as pa

WORD_BPE = "word_bpe_49k.json"
# Words that a worker process remembers, at most: two generations of half as many.
CACHE_WORDS = 400_000
LONGEST_CACHED = 64
# Texts that are looked up at once hold so many characters, at most.
GROUP_CHARS = 1 << 19
# Characters that stand alone: none changes its neighbours, their letters have lower case one by one, and all others,
# numbers too, are signs. In lower case their letters are a-z and pairs of bytes that begin as in _LETTER.
_PLAIN = re.compile("[\0-\x7f¡-©«-´¶-¹»-¿À-ÖØ-öø-įı-ňŊ-ſ\u0400-\u045f\u2010-\u2027\u2030-\u205e₠-₿]*+")
_LETTER, _SPACE = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(97, 123), 0xC3, 0xC4, 0xC5, 0xD0, 0xD1]] = True
_SPACE[[9, 10, 13, 32]] = True


@cache
def tokenizer(file: str):
    """One per worker process. `file` is a name known to `public_tokenizers`, or a path."""
    import public_tokenizers
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(file if os.path.isabs(file) else public_tokenizers.path(file))


def _byte_signs() -> list[str]:
    """The sign that byte-level BPE writes for each byte: printable Latin-1 stands for itself, others follow at 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


_SIGNS = _byte_signs()


class _Words(dict):
    """Word -> ids as bytes. Words seen since the cache was last halved, backed by those before."""

    def __init__(self, file: str):
        super().__init__()
        self.coder, self.before = tokenizer(file), {}
        self.pieces = self.coder.model.tokenize

    def __missing__(self, word: str) -> bytes:
        coded = self.before.get(word)
        if coded is None:
            coded = self._encode(word)
        if len(word) <= LONGEST_CACHED:
            if 2 * len(self) >= CACHE_WORDS:
                self.before = dict(self)
                self.clear()
            self[word] = coded
        return coded

    def _encode(self, word: str) -> bytes:
        if word.isalpha():
            low = word.lower()
            # A word of letters is one piece of the model, if normalising leaves it alone.
            if low == word and (word.isascii() or unicodedata.is_normalized("NFC", word)):
                piece = word if word.isascii() else "".join(map(_SIGNS.__getitem__, word.encode()))
                return array("I", [t.id for t in self.pieces(piece)]).tobytes()
            if low != word and low.isalpha() and "Σ" not in word:
                return self[low]
        body = word.rstrip(string.punctuation)
        if len(body) < len(word) and body.isalpha():
            return self[body] + self[word[len(body) :]]
        return array("I", self.coder.encode(word, add_special_tokens=False).ids).tobytes()


_known: dict[str, _Words] = {}


def _encode_plain(texts: list[str], known: _Words) -> list[np.ndarray]:
    """Ids of plain texts. Words, cut once more where letters end, are looked up once, however often they occur."""
    raw = [text.lower().encode() for text in texts]
    data = np.frombuffer(b"".join([one + b" " for one in raw]), np.uint8)
    letter, word = _LETTER[data], ~_SPACE[data]
    letter[1:] |= letter[:-1] & (data[1:] & 0xC0 == 0x80)
    begins = word.copy()
    begins[1:] &= ~word[:-1] | (letter[:-1] & ~letter[1:])
    at = np.flatnonzero(begins)
    offsets = np.append(np.cumsum(word, dtype=np.int32)[at] - 1, word.sum()).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data[word])).dictionary_encode()
    coded = [known[piece] for piece in pieces.dictionary.to_numpy(zero_copy_only=False)]
    sizes = np.fromiter(map(len, coded), np.int64) // 4
    index = pieces.indices.to_numpy()
    counts = sizes[index]
    ends = np.append(0, np.cumsum(counts))
    places = np.repeat((np.cumsum(sizes) - sizes)[index] - ends[:-1], counts) + np.arange(ends[-1])
    ids = np.frombuffer(b"".join(coded), "<u4")[places]
    return np.split(ids, ends[np.searchsorted(at, np.cumsum([len(one) + 1 for one in raw])[:-1])])


def encode(texts: list[str | None], file: str = WORD_BPE) -> list[np.ndarray]:
    """Ids of whole texts (null: none), without special tokens, as little-endian unsigned 32-bit numbers.

    Only for `word_bpe_49k.json` and files like it: lower case, white space dropped, letters and signs never joined.
    A text is then the sequence of its words, and words that were seen before are looked up. Plain texts go together.
    """
    known = _known.get(file)
    if known is None:
        known = _known[file] = _Words(file)
    found: list[np.ndarray | None] = [None] * len(texts)
    group, held = [], 0
    for i, text in enumerate(texts):
        text = text or ""
        # Special tokens are found before lower-casing.
        if len(text) <= GROUP_CHARS and "<|" not in text and _PLAIN.fullmatch(text):
            if held + len(text) > GROUP_CHARS:
                _fill(found, group, texts, known)
                group, held = [], 0
            group.append(i)
            held += len(text)
        else:
            words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            found[i] = np.frombuffer(b"".join(map(known.__getitem__, words)), "<u4")
    _fill(found, group, texts, known)
    return found


def _fill(found: list, group: list[int], texts: list[str | None], known: _Words) -> None:
    if group:
        for i, ids in zip(group, _encode_plain([texts[i] or "" for i in group], known)):
            found[i] = ids
