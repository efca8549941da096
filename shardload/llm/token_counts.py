"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut into the pieces of the byte-level rule; a piece starts as one
symbol a byte.  The adjacent pairs that have a rank lie in a heap; the one of
lowest rank is popped again and again and merged in a linked list of symbols,
until the heap is empty.  The count is the symbols a piece began with minus its
merges: no identifier is looked up or emitted.  A piece of ``n`` bytes costs
``n log n``, so one run of a million letters is no special case; short pieces
met before cost one lookup.

The library's defaults hold: strings of added tokens inside a text are one token
each and end the pieces around them; nothing is added, cut off or padded.

Defined results: a null text is empty: 0 bytes, 0 tokens; repeated rows are
counted each for itself; ids of any type and nulls pass; extra columns are
ignored; a vocabulary file that asks for more than these rules (a normalizer,
another cut, dropout, whole-piece look-up) is refused when the query is built.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

LIMIT = 1024
#: Pieces held per worker and generation (a full cache becomes the older generation); longer ones are counted anew.
CACHE_PIECES, CACHE_LENGTH = 300_000, 64

# The byte-level rule, with its white space, letters and numbers among the characters below.
_SPACE = r"\t-\r \x85\xa0\u2028\u2029\u202f"
_LETTER = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_NUMBER = r"0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
                     f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: Texts with other characters are cut by the library, which knows every script's letters.
_OTHER = re.compile(r"[^\x00-\u024f\u2010-\u205e]")


def byte_letters() -> list[str]:
    """The character a byte-level vocabulary writes for each byte: itself where it
    is printable Latin-1, else the next free one from U+0100."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in own else next(free)) for b in range(256)]


def read_ranks(path: str) -> tuple[dict, list[str]]:
    """``(pair of symbols -> rank, strings of added tokens)`` of a byte-level BPE file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model["type"] == "BPE" and not any(model.get(k) for k in (
        "dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and not spec.get("normalizer") and not spec.get("truncation")
        and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space"))
    added = spec.get("added_tokens") or []
    if not plain or any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word")):
        raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
    missing = [c for c in byte_letters() if c not in model["vocab"]]
    if missing:
        raise ValueError(f"{path}: no symbol for {len(missing)} of 256 bytes")
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return {p: r for r, p in enumerate(pairs)}, [t["content"] for t in added]


def merged_length(symbols: str | list[str], ranks: dict) -> int:
    """Symbols left when no adjacent pair has a rank: the lowest rank goes first, of equal pairs the left one."""
    left = list(symbols)
    n = len(left)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((left[i], left[i + 1]))) is not None]
    heapify(heap)
    merges = 0
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        if left[i] is None or j >= n or ranks.get((left[i], left[j])) != rank:
            continue  # one of the two has been merged meanwhile
        left[i] += left[j]
        left[j] = None
        after[i] = j = after[j]
        merges += 1
        if j < n:
            before[j] = i
            if (r := ranks.get((left[i], left[j]))) is not None:
                heappush(heap, (r, i))
        if (k := before[i]) >= 0 and (r := ranks.get((left[k], left[i]))) is not None:
            heappush(heap, (r, k))
    return n - merges


class Counter(dict):
    """piece -> its tokens.  Pieces of texts that the library cuts are spelled in byte letters, behind a NUL."""

    def __init__(self, path: str):
        super().__init__()
        self.ranks, added = read_ranks(path)
        self.letters = byte_letters()
        self.older: dict[str, int] = {}
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

    def __missing__(self, piece: str) -> int:
        n = self.older.get(piece)
        if n is None:
            n = merged_length(piece[1:] if piece[0] == "\0" else [self.letters[b] for b in piece.encode()], self.ranks)
        if len(self) >= CACHE_PIECES:
            self.older = dict(self)
            self.clear()
        if len(piece) < CACHE_LENGTH:
            self[piece] = n
        return n

    def _between(self, text: str) -> int:
        if "\0" in text or _OTHER.search(text):
            return sum(self["\0" + p] for p, _ in self.cut.pre_tokenize_str(text))
        return sum(map(self.__getitem__, _PIECES.findall(text)))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.added is None or not self.added.search(text):
            return self._between(text)
        parts = self.added.split(text)
        return len(parts) - 1 + sum(self._between(p) for p in parts if p)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row of ``docs``; no shuffle.
    ``tokenizer`` is the path of a byte-level BPE file, which tasks read as well."""
    read_ranks(tokenizer)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Counter(tokenizer)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()),
                pa.array([of.count(t) for t in texts], pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = source.mapInArrow(counted, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
