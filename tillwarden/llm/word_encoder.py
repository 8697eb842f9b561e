"""Token ids of whole texts with a `tokenizers` file, word by word.

For a tokenizer whose pre-tokenizer drops white space, no token spans a separator and no rule
looks across one, so a text's ids are its words' ids in order. A chunk of texts asks for each of
its different words once, and each Python worker keeps the ids of the words it has met; the ids of
the texts are then put together by number, without a step per word.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np

from tillwarden.llm.text import Chunk, words

#: Words whose ids a worker keeps (when full, it starts anew), and bytes of the longest of them.
KEPT_WORDS = 1_000_000
KEPT_BYTES = 64
_SPLIT_OFF = frozenset(b".,;:!?")
_PLAIN = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
#: Latin letters that are one character each, also in lower case (İ is not): a word of these is one
#: piece, and no normal form changes it.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")
#: Byte-level models write bytes as characters: printable ones of Latin-1 as they are, others from 256 on.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_AS_CHARACTER = dict(zip([b for b in range(256) if b not in _SHOWN], range(256, 512), strict=False))


class _Ids(dict):
    """word (UTF-8) -> its ids as unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = self.tokenizer.model.tokenize

    def __missing__(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters only
            ids = self.piece(word.lower().decode())
        elif len(word) > 1 and word[-1] in _SPLIT_OFF and word[-2] in _PLAIN:
            # One mark after an ASCII letter or digit is a piece of its own. Other letters may
            # decompose into a letter and a mark, with which this one would go together.
            before = word[:-1]
            known = self.get(before) or (self.piece(before.lower().decode()) if before.isalpha() else self[before])
            ids = known + self[word[-1:]]
        elif _LETTERS.fullmatch(text := word.decode()):
            ids = self.piece(text.lower())
        elif word.isascii() and word != word.lower() and b"<|" not in word:
            # ASCII letters are lowered one by one, before anything else looks at them.
            ids = self[word.lower()]
        else:
            ids = self.encode(text)
        if len(word) <= KEPT_BYTES:
            self[word] = ids
        return ids

    def piece(self, letters: str) -> bytes:
        """Ids of one piece, without the steps that would find out that it is one."""
        shown = letters if letters.isascii() else letters.encode().decode("latin-1").translate(_AS_CHARACTER)
        return array("I", [t.id for t in self.pieces(shown)]).tobytes()

    def encode(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()


@lru_cache(maxsize=2)
def _ids(path: str) -> _Ids:
    return _Ids(path)


class WordEncoder:
    """Encoder for ``path``; the tokenizer must lower-case and drop white space (checked)."""

    def __init__(self, path: str):
        self.ids = _ids(path)
        probe = self.ids.encode
        if probe("Ab c.\td\n") != probe("ab") + probe("c") + probe(".") + probe("d"):
            raise ValueError(f"{path} doesn't drop white space and lower-case words")
        if probe("Élanvital") != self.ids.piece("élanvital"):
            raise ValueError(f"{path} doesn't take a word of letters as one piece of bytes")

    def __call__(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts of a chunk in order, and where each text's begin (and the end)."""
        found, of_word, n = self._found(chunk)
        pool = np.frombuffer(b"".join(found), np.uint32)
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin = np.cumsum(size) - size
        per_word = size[of_word]
        upto = np.concatenate([[0], np.cumsum(per_word)])
        at = np.repeat(begin[of_word] - upto[:-1], per_word) + np.arange(upto[-1])
        return pool[at], upto[n]

    def lengths(self, chunk: Chunk) -> np.ndarray:
        """Number of ids of each text."""
        found, of_word, n = self._found(chunk)
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.diff(np.concatenate([[0], np.cumsum(size[of_word])])[n])

    def _found(self, chunk: Chunk) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Ids of the different words of a chunk, which of them each word is, and each text's first word."""
        if len(self.ids) > KEPT_WORDS:
            self.ids.clear()
        w = words(chunk)
        # Hashes tell words of a chunk apart; those that are too long to be kept stand for themselves.
        long = np.flatnonzero(w.end - w.start > KEPT_BYTES)
        w.hashes[long] = np.arange(len(long))
        _, first, of_word = np.unique(w.hashes, return_index=True, return_inverse=True)
        text, look_up = chunk.data.tobytes(), self.ids.__getitem__
        found = [look_up(text[a:b]) for a, b in zip(w.start[first].tolist(), w.end[first].tolist(), strict=True)]
        return found, of_word, w.first
