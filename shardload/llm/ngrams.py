"""Hashed character n-grams of whole texts with NumPy, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Characters handled at once; a longer text is cut into pieces that overlap, so no n-gram is lost or counted twice.
BLOCK = 1 << 18

_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], dtype=np.uint32)


def _code_points(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _hash(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    h = codes[:len(codes) - n + 1] * _MULT[0]
    for k in range(1, n):
        h = (h ^ (h >> np.uint32(15))) * _MULT[4] + codes[k:len(codes) - n + 1 + k] * _MULT[k]
    h = (h + np.uint32(n)) * _MULT[2]
    h ^= h >> np.uint32(13)
    h *= _MULT[1]
    return h >> np.uint32(32 - bits)


def _pieces(texts: list, longest: int) -> Iterator[tuple[int, str, bool]]:
    """``(owner, piece, more)``; with ``more`` the next piece starts BLOCK characters later."""
    for i, t in enumerate(texts):
        t = t or ""
        starts = range(0, max(1, len(t) - longest + 1), BLOCK) if len(t) > BLOCK else (0,)
        for a in starts:
            more = a + BLOCK in starts
            yield i, t[a:a + BLOCK + longest - 1] if more else t[a:], more


def blocks(texts: list, orders: tuple[int, ...], bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(owner, buckets)``: bucket (0 .. 2^bits - 1) of every n-gram of a text,
    in one item, or in several for a text longer than BLOCK."""
    longest = max(orders)
    pending, size = [], 0
    for piece in _pieces(texts, longest):
        pending.append(piece)
        size += len(piece[1]) + longest
        if size >= BLOCK:
            yield from _hashed(pending, orders, bits, longest)
            pending, size = [], 0
    if pending:
        yield from _hashed(pending, orders, bits, longest)


def _hashed(pieces: list, orders: tuple, bits: int, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    codes = _code_points("".join(s + "\0" * longest for _, s, _ in pieces))
    hashed = [_hash(codes, n, bits) for n in orders]
    a = 0
    for i, s, more in pieces:
        ends = [min(len(s) - n + 1, BLOCK) if more else len(s) - n + 1 for n in orders]
        yield i, np.concatenate([h[a:a + max(0, e)] for h, e in zip(hashed, ends)])
        a += len(s) + longest
