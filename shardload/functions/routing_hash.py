"""Shard routing hash: murmur3 x86 32-bit, seed 0, over UTF-16LE code units.

This is the one place where work leaves the JVM: Spark's ``hash()`` is the
same algorithm but with seed 42 over UTF-8 bytes, so it cannot route
compatibly.  The function below runs on Arrow batches; ids are grouped by
encoded length so that the block loop is vectorised over all ids of a length.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

# Fixed values of the published murmur3_x86_32 algorithm.
C1 = 0xCC9E2D51
C2 = 0x1B873593
N1 = 0xE6546B64
F1 = 0x85EBCA6B
F2 = 0xC2B2AE35


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint32(r)) | (x >> np.uint32(32 - r))


def _mix_k(k: np.ndarray) -> np.ndarray:
    k = k * np.uint32(C1)
    k = _rotl(k, 15)
    return k * np.uint32(C2)


def _hash_equal_length(buf: np.ndarray) -> np.ndarray:
    """buf: uint8 matrix, one row per id, all rows of the same byte length."""
    n, length = buf.shape
    h = np.zeros(n, dtype=np.uint32)
    nblocks = length // 4
    if nblocks:
        blocks = np.ascontiguousarray(buf[:, : nblocks * 4]).view("<u4").reshape(n, nblocks)
        for b in range(nblocks):
            h ^= _mix_k(blocks[:, b].astype(np.uint32))
            h = _rotl(h, 13)
            h = h * np.uint32(5) + np.uint32(N1)
    rem = length - nblocks * 4
    if rem:
        k = np.zeros(n, dtype=np.uint32)
        for j in range(rem - 1, -1, -1):
            k = (k << np.uint32(8)) | buf[:, nblocks * 4 + j].astype(np.uint32)
        h ^= _mix_k(k)
    h ^= np.uint32(length)
    h ^= h >> np.uint32(16)
    h = h * np.uint32(F1)
    h ^= h >> np.uint32(13)
    h = h * np.uint32(F2)
    h ^= h >> np.uint32(16)
    return h


def murmur3_utf16(ids) -> np.ndarray:
    """Signed 32-bit hashes of a sequence of strings (None → 0, masked by caller)."""
    encoded = [(s or "").encode("utf-16-le", "surrogatepass") for s in ids]
    lengths = np.fromiter((len(e) for e in encoded), dtype=np.int64, count=len(encoded))
    out = np.zeros(len(encoded), dtype=np.uint32)
    with np.errstate(over="ignore"):
        for length in np.unique(lengths):
            idx = np.nonzero(lengths == length)[0]
            if length == 0:
                out[idx] = _hash_equal_length(np.zeros((len(idx), 0), dtype=np.uint8))
                continue
            raw = b"".join(encoded[i] for i in idx)
            buf = np.frombuffer(raw, dtype=np.uint8).reshape(len(idx), int(length))
            out[idx] = _hash_equal_length(buf)
    return out.view(np.int32)


# Ship this module's code with the UDF (by value), so Python workers need
# only NumPy and pandas, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@F.pandas_udf(IntegerType())
def murmur3_id(ids: pd.Series) -> pd.Series:
    h = pd.Series(murmur3_utf16(ids.tolist()), index=ids.index, dtype="Int32")
    return h.mask(ids.isna())


def shard_of(id_col: Column | str, shards: int) -> Column:
    """Non-negative shard number of an id: ``pmod(murmur3(id), shards)``."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(murmur3_id(c), F.lit(int(shards))).cast("int")
