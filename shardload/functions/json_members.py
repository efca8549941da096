"""Members of JSON objects with repeated names, a batch at a time (Arrow kernels)."""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F


_ESCAPED = {"\"": "\\\"", "\\": "\\\\", "\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}
_SPECIAL = pa.array(["NaN", "Infinity", "-Infinity"])


def _literals(text: pa.Array) -> pa.Array:
    """JSON string literals, with the escapes of Spark's JSON writer."""
    escape = lambda m: _ESCAPED.get(m[0], f"\\u{ord(m[0]):04X}")
    odd = pc.fill_null(pc.match_substring_regex(text, r'["\\\x00-\x1f]'), False)
    if odd.true_count:
        plain = [re.sub(r'["\\\x00-\x1f]', escape, t.decode("utf-8", "replace"))
                 for t in text.filter(odd).cast(pa.binary()).to_pylist()]
        text = pc.replace_with_mask(text, odd, pa.array(plain, pa.string()))
    return pc.binary_join_element_wise('"', text, '"', "")


def members_of(names: pa.Array, whole: pa.Array, real: pa.Array, text: pa.Array, collect: bool) -> pa.Array:
    """The members of every document, joined by commas: of a repeated name the last value, at its position, or with
    ``collect`` an array of all its values, at the first one's.  A field has a whole number, the text of a real one, a
    text, or nothing (``null``); one without a name is left out."""
    sizes = pc.fill_null(pc.list_value_length(names), 0).to_numpy(zero_copy_only=False)
    name, doc = names.flatten(), np.repeat(np.arange(len(names)), sizes)
    whole, real, text = whole.flatten(), real.flatten(), text.flatten()
    if name.null_count:
        named = name.is_valid()
        doc = doc[named.to_numpy(zero_copy_only=False)]
        name, whole, real, text = (x.filter(named) for x in (name, whole, real, text))
    real = pc.if_else(pc.is_in(real, value_set=_SPECIAL), pc.binary_join_element_wise('"', real, '"', ""), real)
    json = pc.coalesce(_literals(text), whole.cast(pa.string()), real, pa.scalar("null"))
    literals = name.dictionary_encode()
    key = doc * max(1, len(literals.dictionary)) + literals.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(key, kind="stable")  # the values of a document's name follow one another, as they came
    edges = np.r_[np.flatnonzero(np.diff(key[order], prepend=-1)), len(order)]
    if collect:
        values = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), json.take(pa.array(order))), ",")
        values = pc.if_else(pa.array(np.diff(edges) > 1), pc.binary_join_element_wise("[", values, "]", ""), values)
        first = order[edges[:-1]]
        by_place = np.argsort(first)
        at, values = first[by_place], values.take(pa.array(by_place))
    else:
        at = np.sort(order[edges[1:] - 1])
        values = json.take(pa.array(at))
    own = _literals(literals.dictionary).take(literals.indices.take(pa.array(at)))
    members = pc.binary_join_element_wise(own, values, ":")
    offsets = np.searchsorted(doc[at], np.arange(len(names) + 1))
    out = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), members), ",")
    return pc.if_else(names.is_null(), pa.scalar(None, pa.string()), out) if names.null_count else out


# The module's code travels with the function, as that of ``field_parse``.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def members(fields: Column, collect: bool) -> Column:
    @F.arrow_udf("string")
    def run(names: pa.Array, i: pa.Array, l: pa.Array, s: pa.Array, real: pa.Array, text: pa.Array) -> pa.Array:
        long = lambda a: a.cast(pa.list_(pa.int64())).flatten()
        whole = pc.coalesce(long(i), long(l), long(s))
        sizes = pc.fill_null(pc.list_value_length(names), 0).to_numpy(zero_copy_only=False)
        whole = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), whole)
        kind = pa.list_(pa.string())
        return members_of(names.cast(kind), whole, real.cast(kind), text.cast(kind), collect)
    # Only Spark writes a float or double as Java does.
    real = F.transform(fields, lambda x: F.coalesce(x["d"].cast("string"), x["f"].cast("string")))
    return run(fields["name"], fields["i"], fields["l"], fields["s"], real, fields["str"])
