"""Values of named fields, a batch of documents at a time (Arrow kernels).

Each function takes the ``fields`` of a document and nothing else, so Spark runs it in the
call that parses them, if nothing comes between: the fields, of which most are not asked
for, are then not handed to the JVM and back.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from shardload.functions.field_parse import FIELDS

#: The first value in input order, all of them, all in ascending order, or the distinct ones in ascending order.
HOW = ("first", "all", "sorted", "set")


def _edges(fields: pa.Array) -> tuple[pa.StructArray, np.ndarray]:
    """The fields of all documents end to end, and where each document's begin; a null document has none."""
    sizes = pc.fill_null(pc.list_value_length(fields), 0).to_numpy(zero_copy_only=False)
    return fields.flatten(), np.concatenate([[0], np.cumsum(sizes)])


def _in_order(values: pa.Array, doc: np.ndarray, distinct: bool) -> tuple[pa.Array, np.ndarray]:
    """The values in ascending order in their document, as Spark sorts them: NaN last, texts by their bytes, a zero
    and a negative zero as equals."""
    if pa.types.is_floating(values.type):
        key = values.to_numpy(zero_copy_only=False)
        key = np.where(key == 0, 0, key)  # NumPy sorts NaN last
    elif pa.types.is_string(values.type):
        d = values.cast(pa.binary()).dictionary_encode()
        rank = np.empty(len(d.dictionary), np.int64)
        rank[pc.sort_indices(d.dictionary).to_numpy()] = np.arange(len(rank))
        key = rank[d.indices.to_numpy()]
    else:
        key = values.to_numpy(zero_copy_only=False)
    order = np.lexsort((key, doc))
    if distinct and len(order):
        k, d = key[order], doc[order]
        order = order[np.r_[True, (np.diff(k) != 0) | (np.diff(d) != 0)]]
    return values.take(pa.array(order)), doc[order]


def values_of(fields: pa.Array, names: list[str], slots: list[str], how: str) -> pa.StructArray:
    """A member ``v<k>`` for every name: the values that its fields have in the slot, or the first (``HOW``)."""
    flat, edges = _edges(fields)
    of = np.repeat(np.arange(len(fields)), np.diff(edges))
    own = flat.field("name").dictionary_encode()
    index = own.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    none = fields.is_null() if fields.null_count else None
    out = []
    for name, slot in zip(names, slots):
        code = pc.index(own.dictionary, pa.scalar(name, own.dictionary.type)).as_py()
        at = np.flatnonzero(index == code) if code >= 0 else np.zeros(0, np.int64)
        values = flat.field(slot).take(pa.array(at))
        if values.null_count:
            on = values.is_valid()
            at, values = at[on.to_numpy(zero_copy_only=False)], values.filter(on)
        doc = of[at]
        if how == "first":
            first, where = np.unique(doc, return_index=True)
            take, absent = np.zeros(len(fields), np.int64), np.ones(len(fields), bool)
            take[first], absent[first] = where, False
            out.append(values.take(pa.array(take, mask=absent)))
            continue
        if how != "all":
            values, doc = _in_order(values, doc, how == "set")
        offsets = np.searchsorted(doc, np.arange(len(fields) + 1)).astype(np.int32)
        out.append(pa.ListArray.from_arrays(pa.array(offsets), values, mask=none))
    return pa.StructArray.from_arrays(out, names=[f"v{k}" for k in range(len(out))])


def members_of(fields: pa.Array, members: list[str]) -> pa.ListArray:
    """The fields with some of their members only."""
    flat, edges = _edges(fields)
    own = pa.StructArray.from_arrays([flat.field(m) for m in members], names=members)
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), own, mask=fields.is_null() if fields.null_count else None)


# The module's code travels with the function, as that of ``field_parse``.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def some_members(fields: Column, members: list[str]) -> Column:
    """``array<struct<...>>`` of the fields with these members only."""
    kinds = dict(m.split(":") for m in FIELDS.removeprefix("array<struct<").removesuffix(">>").split(","))

    @F.arrow_udf("array<struct<" + ",".join(f"{m}:{kinds[m]}" for m in members) + ">>")
    def run(fields: pa.Array) -> pa.Array:
        return members_of(fields, members)
    return run(fields)


def named_values(fields: Column, names: list[str], slots: list[str], types: list[str], how: str) -> Column:
    """``struct<v0, v1, ...>``: of the ``k``-th name the values in its slot, of the Spark type given, as ``how`` says."""
    kind = (lambda t: t) if how == "first" else "array<{}>".format

    @F.arrow_udf("struct<" + ",".join(f"v{k}:{kind(t)}" for k, t in enumerate(types)) + ">")
    def run(fields: pa.Array) -> pa.Array:
        return values_of(fields, names, slots, how)
    return run(fields)
