"""Ids of a lower-casing word BPE file, run by run with a cache.

The tokenizer cuts a text into runs (letters, single numbers, other marks) and
never joins characters across them, so a text's ids are those of its runs one
after another; a run met before costs one lookup.  Texts beyond Latin letters,
or in need of its normalizer, go to the tokenizer whole."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
from tokenizers import Tokenizer

#: Runs held per worker and generation.  A full cache becomes the older generation, from which
#: runs still in use come back; those that were not used since the last change are given up.
CACHE_RUNS = 300_000

_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBERS = "0-9²³¹¼-¾"
_RUNS = re.compile(f"[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")
# Code points whose kind is not plain from _RUNS, whose lower case depends on the library or on what
# follows, or that only one side takes for white space.
_OTHER = re.compile("[^\x00-\x1b\x20-\u012f\u0131-\u024f\u2010-\u2027\u2030-\u205e]")


def _byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte: itself
    for printable Latin-1, else the next free one from U+0100."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, free = [], 256
    for b in range(256):
        letters.append(chr(b if b in own else free))
        free += b not in own
    return letters


def _plain_ascii(text: str) -> bool:
    return not ("\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text)


class RunIds(dict):
    """run -> its ids as little-endian bytes of ``dtype``."""

    def __init__(self, path: str, dtype: str = "<u4"):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.packed = [i.to_bytes(np.dtype(dtype).itemsize, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.older: dict[str, bytes] = {}

    def __missing__(self, run: str) -> bytes:
        ids = self.older.get(run)
        if ids is None:
            mapped = run if run.isascii() else "".join([self.letters[b] for b in run.encode()])
            ids = b"".join([self.packed[t.id] for t in self.model.tokenize(mapped)])
        if len(self) >= CACHE_RUNS:
            self.older = dict(self)
            self.clear()
        if len(run) < 64:
            self[run] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if "<|" in text or not (_plain_ascii(text) if text.isascii() else (
                not _OTHER.search(text) and unicodedata.is_normalized("NFC", text))):
            return b"".join([self.packed[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])
        return b"".join(map(self.__getitem__, _RUNS.findall(text.lower())))


class WordIds(dict):
    """word in UTF-8 -> its ids: a second cache above that of the runs."""

    def __init__(self, path: str, dtype: str = "<u2"):
        super().__init__()
        self.runs, self.older = RunIds(path, dtype), {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.runs.encode(word.decode("utf-8", "surrogatepass"))
        if len(self) >= CACHE_RUNS:
            self.older = dict(self)
            self.clear()
        if len(word) < 64:
            self[word] = ids
        return ids
