"""Whole texts to token ids with the ``tokenizers`` library, each distinct word encoded once per worker.

A byte-level BPE splits a text into words by a fixed pattern and merges within
each word alone. Here the split is made with the same pattern in Python's ``re``; a word seen
before takes its ids from a dictionary, a new one goes to the library's model.
The pattern's classes are those of Unicode letters and numbers, which ``re`` lacks: it splits by word
characters, and a text in which the two differ (numbers that are no decimal digits, separators
U+001C to U+001F), or which holds an added token's string, is encoded whole
by the library, as is every text of a tokenizer with a normalizer or another pre-tokenizer.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

#: Words remembered by a worker, and the longest of them.
CACHE, LONGEST = 800_000, 64
#: Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others are numbered from U+0100.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_REST = iter(range(256, 512))
BYTES = {b: chr(b if b in _PLAIN else next(_REST)) for b in range(256)}
_SPACE = BYTES[32]

#: Letters, as a set that ``re`` looks up in one step; a word with letters beyond U+FFFF is left to the next alternative.
_LETTERS = "".join(re.findall(r"[^\W\d_]+", "".join(map(chr, range(1 << 16)))))
_AHEAD = " ?[%s]++(?![\U00010000-\U0010ffff])" % _LETTERS
SPLIT = re.compile(_AHEAD + r"| ?[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+").findall
_SEPARATORS = re.compile("[\x1c-\x1f]").search


class _Odd(Exception):
    """A word that the library splits differently."""


class _Words(dict):
    """Ids of words, as bytes."""

    def __init__(self, model, code: str):
        self.tokenize, self.code = model.tokenize, code

    def __missing__(self, word: str) -> bytes:
        core = word[1:] if word[0] == " " and len(word) > 1 else word
        # Only a match of the first two alternatives can hold other numbers, only white space a separator.
        if core.isalnum() and not (core.isalpha() or core.isdecimal()) or core.isspace() and _SEPARATORS(core):
            raise _Odd
        marked = _SPACE + core if core is not word and core.isascii() and core.isalpha() else word.encode().decode("latin-1").translate(BYTES)
        ids = array(self.code, [t.id for t in self.tokenize(marked)]).tobytes()
        if len(word) <= LONGEST:
            self[word] = ids
        return ids


class Bpe:
    """``ids(text)``: the text's ids as little-endian bytes of ``dtype``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.cuts = not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.words = _Words(self.tokenizer.model, {2: "H", 4: "I"}[self.dtype.itemsize])

    def ids(self, text: str) -> bytes:
        if self.cuts and not any(t in text for t in self.added):
            if len(self.words) > CACHE:
                self.words.clear()
            try:
                return b"".join(map(self.words.__getitem__, SPLIT(text)))
            except _Odd:
                pass
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype).tobytes()


_LOADED: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """One instance per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]
