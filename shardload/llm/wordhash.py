"""64-bit hashes of words and word shingles of whole texts, with NumPy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes hashed at once; longer texts are hashed in parts that end between words.
BLOCK = 1 << 18

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(0, 2 ** 64, 256, dtype=np.uint64)
_PLACE = _rng.integers(0, 2 ** 64, 16, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C17)  # odd, 3 modulo 4
_INVERSE = np.uint64(pow(int(_BASE), -1, 2 ** 64))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes between words: white space; or everything in ASCII but letters and digits.
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.table[0]) < n:
        _powers.table = tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, x, np.uint64)]), dtype=np.uint64)
                              for x in (_BASE, _INVERSE))
    return _powers.table


_powers.table = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


def _hash_words(data: bytes, between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``data`` with A-Z lower-cased, and where they start."""
    low = _LOWER[np.frombuffer(data, dtype=np.uint8)]
    inside = np.concatenate([[False], ~between[low], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    power, inverse = _powers(len(low) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[low] * power[:len(low)], dtype=np.uint64)])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)), starts


def _parts(data: bytes, between: np.ndarray) -> Iterator[bytes]:
    """``data`` cut into parts of about BLOCK bytes that end between words."""
    view, a = np.frombuffer(data, dtype=np.uint8), 0
    while a < len(data):
        b, step = min(a + BLOCK, len(data)), BLOCK
        while b < len(data):
            at = np.flatnonzero(between[view[b:b + step]])
            b = b + at[0] if len(at) else min(b + step, len(data))
            if len(at):
                break
        yield data[a:b]
        a = b


def words(texts: list, between: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first, offsets, hashes)``: the words of text ``first + k`` are
    ``hashes[offsets[k]:offsets[k + 1]]``.  A null text has none."""
    first, pending, size = 0, [], 0

    def done():
        joined = b" ".join(pending)
        edges = np.cumsum([0] + [len(p) + 1 for p in pending])
        hashes, starts = _hash_words(joined, between)
        return first, np.searchsorted(starts, edges), hashes

    for i, t in enumerate(texts):
        data = (t or "").encode("utf-8", "surrogatepass")
        if len(data) > BLOCK:
            if pending:
                yield done()
            hashes = np.concatenate([_hash_words(p, between)[0] for p in _parts(data, between)])
            yield i, np.array([0, len(hashes)]), hashes
            first, pending, size = i + 1, [], 0
            continue
        pending.append(data)
        size += len(data) + 1
        if size >= BLOCK:
            yield done()
            first, pending, size = i + 1, [], 0
    if pending:
        yield done()


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every ``k`` consecutive words; of fewer words, one of them all; of none, none."""
    n = min(k, len(hashes))
    if not n:
        return hashes[:0]
    total = np.full(len(hashes) - n + 1, n, dtype=np.uint64)
    for j in range(n):
        total += hashes[j:len(hashes) - n + 1 + j] * _PLACE[j]
    return mix(total)
