"""Columns of payloads to typed fields, a batch at a time (Arrow kernels).

Higher-order functions over the columns are evaluated node by node without code
generation; here each step runs once over all columns of a batch.  What the fast
conversions do not take (blanks, suffixes, exponents, long or bad numbers) goes through
``_whole`` and ``_real``, which follow Java's ``valueOf`` text by text.
"""

from __future__ import annotations

import math
import re
import sys
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

TAG_PREFIX = "col_"
TAG_VALUE = 1
NUMERIC_TYPES = ("integer", "long", "short", "float", "double")
SLOTS = ("i", "l", "s", "f", "d")
ARROW = (pa.int32(), pa.int64(), pa.int16(), pa.float32(), pa.float64())
FIELDS = ("array<struct<pos:int,name:string,type:string,raw:string,i:int,l:bigint,s:smallint,f:float,d:double,"
          "str:string,error:string>>")
_STRUCT = [pa.field("pos", pa.int32()), *[pa.field(n, pa.string()) for n in ("name", "type", "raw")],
           *[pa.field(n, t) for n, t in zip(SLOTS, ARROW)], pa.field("str", pa.string()), pa.field("error", pa.string())]
_INTEGRAL = re.compile(r"([+-]?[0-9]+)(\r\n|\n|\r)?")  # Java's $ also stands before a last line end
_NAMED = re.compile(r"([+-]?)(NaN|Infinity)(\r\n|\n|\r)?")
_DECIMAL = re.compile(r"([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)[fFdD]?")
_HEX = re.compile(r"([+-]?)0[xX]([0-9a-fA-F]*)\.?([0-9a-fA-F]*)[pP]([+-]?[0-9]+)[fFdD]?")
_OVER = 2.0 ** 128 - 2.0 ** 103  # between the largest float and infinity
_BLANKS = "".join(map(chr, range(33)))


def _whole(text: str, bits: int) -> int | None:
    m = _INTEGRAL.fullmatch(text)
    if m is None:
        return None
    sign, digits = text[0] == "-", m[1].lstrip("+-").lstrip("0") or "0"
    if len(digits) > 19:
        return None
    n = -int(digits) if sign else int(digits)
    return n if -(1 << bits - 1) <= n < 1 << bits - 1 else None


def _nearest(value: float, exact, single: bool) -> float:
    """``value``, the double nearest to a number, as the float nearest to it: a double between two floats does not say to
    which side of it the number lies, so ``exact`` is asked."""
    if not single:
        return value
    with np.errstate(over="ignore"):
        f = np.float32(value)
    if abs(value) == _OVER and abs(exact()) < _OVER:
        return math.copysign(float(np.finfo(np.float32).max), value)
    if np.isfinite(f) and float(f) != value:
        other = np.nextafter(f, np.float32(np.inf if value > float(f) else -np.inf))
        if np.isfinite(other) and (float(f) + float(other)) / 2 == value:
            side = exact() - Fraction(value)
            if side:
                f = max(f, other) if side > 0 else min(f, other)
    return float(f)


def _real(text: str, single: bool) -> float | None:
    if "n" in text or "N" in text:
        m = _NAMED.fullmatch(text.strip(" "))
        return None if m is None else float(m[1] + m[2].lower())
    text = text.strip(_BLANKS)
    m = _DECIMAL.fullmatch(text)
    if m is not None:
        return _nearest(float(m[1]), lambda: Fraction(m[1]), single)
    m = _HEX.fullmatch(text)
    if m is None or not m[2] + m[3]:
        return None
    digits, power = int(m[2] + m[3], 16), int(m[4]) - 4 * len(m[3])
    sign = -1.0 if m[1] == "-" else 1.0
    top = digits.bit_length() + power
    if not digits or top < -1100:
        return sign * 0.0
    if top > 1100:
        return sign * float("inf")
    exact = Fraction(digits) * Fraction(2) ** power
    try:
        value = float(exact)
    except OverflowError:
        value = float("inf")
    return sign * _nearest(value, lambda: exact, single)


def _texts(a: pa.Array) -> list[str]:
    return [t.decode("utf-8", "replace") for t in a.cast(pa.binary()).to_pylist()]


def _numbers(text: pa.Array, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of the texts as the ``kind``-th number type, and which of them are one."""
    typ = ARROW[kind]
    out, good = np.zeros(len(text), typ.to_pandas_dtype()), np.zeros(len(text), bool)
    left = np.arange(len(text))

    def quick(at: np.ndarray, to: pa.DataType) -> None:
        if not len(at):
            return
        x = text.take(pa.array(at)).cast(to).to_numpy(zero_copy_only=False)
        if kind >= 3:
            ok = np.isfinite(x)
        else:
            ok = (x >= np.iinfo(out.dtype).min) & (x <= np.iinfo(out.dtype).max)
        out[at[ok]], good[at[ok]] = x[ok].astype(out.dtype), True

    if kind < 3:
        plain = pc.and_(pc.string_is_ascii(text), pc.ascii_is_decimal(text)).to_numpy(zero_copy_only=False)
        plain &= pc.less_equal(pc.binary_length(text), 18).to_numpy(zero_copy_only=False)
        quick(np.flatnonzero(plain), pa.int64())
    else:
        try:
            quick(left, typ)
        except pa.ArrowInvalid:
            plain = pc.match_substring_regex(text, r"^-?[0-9]{1,30}(\.[0-9]{1,30})?\z")
            quick(np.flatnonzero(plain.to_numpy(zero_copy_only=False)), typ)
    left = np.flatnonzero(~good)
    if len(left):
        for k, t in zip(left, _texts(text.take(pa.array(left)))):
            value = _whole(t, typ.bit_width) if kind < 3 else _real(t, kind == 3)
            if value is not None:
                out[k], good[k] = value, True
    return out, good


def _strip(text: pa.Array, sep: str) -> pa.Array:
    if len(sep) == 1 and sep.isascii():
        return pc.ascii_rtrim(text, characters=sep)
    quoted = "".join(c if c.isalnum() or not c.isascii() else f"\\x{ord(c):02x}" for c in sep)
    return pc.replace_substring_regex(text, pattern=f"(?:{quoted})+\\z", replacement="")


def _split(text: pa.Array, sep: str) -> tuple[pa.Array, np.ndarray]:
    """``text.split(sep)`` with Java's rules: all parts, and how many each text has."""
    t = _strip(text, sep)
    lists = pc.split_pattern(t, pattern=sep)
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    parts = lists.flatten()
    none = _only(t, text)
    if none.any():
        parts, n = parts.filter(pa.array(~np.repeat(none, n))), np.where(none, 0, n)
    return parts, n


def _only(stripped: pa.Array, text: pa.Array) -> np.ndarray:
    """Texts made of separators alone."""
    one = pc.and_(pc.equal(pc.binary_length(stripped), 0), pc.greater(pc.binary_length(text), 0))
    return pc.fill_null(one, False).to_numpy(zero_copy_only=False)


def _starts(n: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(n)])


def fields_of(payload: pa.Array, delim: str) -> pa.Array:
    """The fields of every payload, as ``operators.fields`` describes them."""
    cells, n_cells = _split(payload, delim)
    columns, n_columns = _split(cells, ",")
    offsets = _starts(n_columns)[_starts(n_cells)]
    pos = np.arange(len(columns)) - np.repeat(offsets[:-1], np.diff(offsets))

    t = pc.ascii_rtrim(columns, characters=":")
    lists = pc.split_pattern(t, pattern=":", max_splits=3)
    first, parts = lists.offsets.to_numpy()[:-1], lists.values
    n = np.where(_only(t, columns), 0, np.diff(lists.offsets.to_numpy()))  # 4: four or more
    part = lambda k: parts.take(pa.array(first + k, mask=n <= k))
    name, value = part(0), part(1)
    tags = n == 1
    if tags.any():
        name = pc.if_else(pa.array(tags), pc.binary_join_element_wise(TAG_PREFIX, name, ""), name)
    kind = pc.index_in(pc.ascii_lower(part(2)), value_set=pa.array(NUMERIC_TYPES)).fill_null(-1).to_numpy(zero_copy_only=False)
    typ = np.where(tags, 0, np.where(kind < 0, len(NUMERIC_TYPES), kind))
    bad = np.full(len(columns), -1)
    bad[n == 0] = len(NUMERIC_TYPES)
    slots = []
    for k, to in enumerate(ARROW):
        at = np.flatnonzero(kind == k)
        x, good = _numbers(value.take(pa.array(at)), k)
        slot, none = np.zeros(len(columns), to.to_pandas_dtype()), np.ones(len(columns), bool)
        slot[at], none[at] = x, ~good
        bad[at[~good]] = k
        if k == 0:
            slot[tags], none[tags] = TAG_VALUE, False
        slots.append(pa.array(slot, to, mask=none))
    none = pa.nulls(len(columns), pa.string())
    errors = pa.array([*[f"bad_{t}" for t in NUMERIC_TYPES], "malformed"])
    struct = pa.StructArray.from_arrays([
        pa.array(pos.astype(np.int32)), name, pa.array([*NUMERIC_TYPES, "string"]).take(pa.array(typ, mask=n == 0)),
        pc.if_else(pa.array(tags), str(TAG_VALUE), value) if tags.any() else value, *slots,
        pc.if_else(pa.array((n >= 2) & (kind < 0)), value, none),
        errors.take(pa.array(bad, mask=bad < 0)) if (bad >= 0).any() else none], fields=_STRUCT)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), struct,
                                    mask=payload.is_null() if payload.null_count else None)


# The module's code travels with the function, as that of ``routing_hash``.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def parsed(payload: Column, delim: str) -> Column:
    @F.arrow_udf(FIELDS)
    def run(payload: pa.Array) -> pa.Array:
        return fields_of(payload.cast(pa.string()), delim)
    return run(payload)


def parsed_checked(payload: Column, doc_id: Column, delim: str) -> Column:
    """``parsed``; a bad value raises in the batch that has it."""
    @F.arrow_udf(FIELDS)
    def run(payload: pa.Array, doc_id: pa.Array) -> pa.Array:
        fields = fields_of(payload.cast(pa.string()), delim)
        error = fields.values.field("error")
        if error.null_count < len(error):
            at = int(np.flatnonzero(error.is_valid().to_numpy(zero_copy_only=False))[0])
            doc = int(np.searchsorted(fields.offsets.to_numpy(), at, "right")) - 1
            raise ValueError(f"bad field value in document {doc_id[doc].as_py()}")
        return fields
    return run(payload, doc_id)
