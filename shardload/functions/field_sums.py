"""Partial sums over the fields of a batch of documents (NumPy): documents, distinct values, values and exact ranges
by name and type.  Spark adds the partial sums up."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fields that are summed at once.
BLOCK = 200_000
VALUES = ("i", "l", "s", "f", "d", "str")
SUMS = "name string, type string, dc long, df long, ttf long"
RANGES = "min_l long, max_l long, min_d double, max_d double"


def _codes(a: pa.Array) -> tuple[np.ndarray, pa.Array]:
    d = a.dictionary_encode()
    return d.indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def _filled(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    on = a.is_valid().to_numpy(zero_copy_only=False)
    return (a.fill_null(0) if a.null_count else a).to_numpy(zero_copy_only=False), on


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """An index of every distinct combination of the keys."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= np.diff(k[order]) != 0
    return order[new]


def _sums(own: pa.Array, name: pa.Array, typ: pa.Array, values: list[pa.Array] | None, doc: np.ndarray) -> pa.RecordBatch:
    """Of fields (their documents ``doc``, ``own`` what the sums are kept apart by), a row for each name and type."""
    (a, owns), (b, names), (c, types) = _codes(own), _codes(name), _codes(typ)
    group, g = np.unique((a * max(1, len(names)) + b) * max(1, len(types)) + c, return_inverse=True)
    ttf = np.bincount(g, minlength=len(group))
    dc = np.bincount(g[_firsts(g, doc)], minlength=len(group))
    rest, t = np.divmod(group, max(1, len(types)))
    o, n = np.divmod(rest, max(1, len(names)))
    out = [owns.take(pa.array(o)), names.take(pa.array(n)), types.take(pa.array(t)), pa.array(dc)]
    if values is None:
        return pa.RecordBatch.from_arrays([*out, pa.array(np.zeros(len(group), np.int64)), pa.array(ttf)],
                                          ["own", "name", "type", "dc", "df", "ttf"])
    (i, on_i), (l, on_l), (s, on_s), (f, on_f), (d, on_d) = (_filled(v) for v in values[:5])
    text, _ = _codes(values[5])
    on_text = values[5].is_valid().to_numpy(zero_copy_only=False)
    whole, on_whole = np.where(on_l, l, np.where(on_i, i, s)).astype(np.int64), on_l | on_i | on_s
    real, on_real = np.where(on_d, d, f.astype(np.float64)), on_d | on_f
    bits = np.where(np.isnan(real), np.nan, real).view(np.int64)  # one NaN, two zeros
    value = np.where(on_text, text, np.where(on_whole, whole, bits))
    df = np.bincount(g[_firsts(value, on_text | on_whole | on_real, g, doc)], minlength=len(group))

    def reduced(how, x: np.ndarray, on: np.ndarray) -> pa.Array:
        at = np.flatnonzero(on)
        at = at[np.argsort(g[at], kind="stable")]
        result, none = np.zeros(len(group), x.dtype), np.ones(len(group), bool)
        if len(at):
            first = np.flatnonzero(np.r_[True, np.diff(g[at]) != 0])
            result[g[at[first]]], none[g[at[first]]] = how.reduceat(x[at], first), False
        return pa.array(result, mask=none, from_pandas=False)

    # NaN is above all other numbers: least only if alone, greatest if there.
    return pa.RecordBatch.from_arrays(
        [*out, pa.array(df), pa.array(ttf), reduced(np.minimum, whole, on_whole), reduced(np.maximum, whole, on_whole),
         reduced(np.fmin, real, on_real), reduced(np.maximum, real, on_real)],
        ["own", "name", "type", "dc", "df", "ttf", "min_l", "max_l", "min_d", "max_d"])


def _documents(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """The row without a name: documents."""
    has = batch.column(1).is_valid()
    if not has.true_count:
        return None
    n = batch.column(0).filter(has).value_counts()
    own, zero = n.field(0), pa.array(np.zeros(len(n), np.int64))
    none = lambda t: pa.nulls(len(n), t)
    return pa.RecordBatch.from_arrays(
        [own, none(pa.string()), none(pa.string()), n.field(1), zero, zero, *[none(pa.int64())] * 2, *[none(pa.float64())] * 2],
        ["own", "name", "type", "dc", "df", "ttf", "min_l", "max_l", "min_d", "max_d"])


def partial_sums(docs: DataFrame, by: str | None = None, ranges: bool = True) -> DataFrame:
    """``(own, name, type, dc, df, ttf[, min_l, max_l, min_d, max_d])`` of the batches of ``docs``: ``own`` is column ``by``,
    ``dc`` documents, ``df`` distinct values of them, ``ttf`` values.  With ``ranges`` a row without a name counts
    the documents; without, distinct values are not counted."""
    own = F.col(by) if by else F.lit(0)
    values = VALUES if ranges else ()
    rows = docs.select(own.alias("own"), *[F.col("fields")[c].alias(c) for c in ("name", "type", *values)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if ranges and (found := _documents(batch)) is not None:
                yield found
            sizes = np.concatenate([[0], np.cumsum(batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            a = 0
            while a < batch.num_rows:  # whole documents, about BLOCK fields of them
                b = max(a + 1, int(np.searchsorted(sizes, sizes[a] + BLOCK, "right")) - 1)
                part = batch.slice(a, b - a)
                flat = [part.column(k).flatten() for k in range(1, part.num_columns)]
                doc = np.repeat(np.arange(b - a), np.diff(sizes[a:b + 1]))
                named = flat[0].is_valid()
                if named.true_count < len(named):
                    flat, doc = [x.filter(named) for x in flat], doc[named.to_numpy(zero_copy_only=False)]
                if len(doc):
                    yield _sums(part.column(0).take(pa.array(doc)), flat[0], flat[1], flat[2:] or None, doc)
                a = b

    kind = rows.schema["own"].dataType.simpleString()
    return rows.mapInArrow(run, f"own {kind}, {SUMS}" + (f", {RANGES}" if ranges else ""))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
