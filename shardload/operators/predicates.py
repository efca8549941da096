"""Query predicates over built documents.

Each returns a Column usable in ``where``.  On the document array the test
is ``exists`` over the fields; on a wide table (one column per field) the
same functions take the column name via ``wide=True`` so that Parquet
pushdown applies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardload.functions.routing_hash import murmur3_utf16
from shardload.operators.docs import SLOT_OF_TYPE, SYSTEM_FIELDS

SPARK_TYPE = {"integer": "int", "long": "bigint", "short": "smallint", "float": "float", "double": "double",
              "string": "string"}


def _typed_lit(v, typ: str) -> Column:
    return F.lit(v).cast(SPARK_TYPE[typ])


def _on_field(field: str, typ: str, test, wide: bool) -> Column:
    if wide:
        return test(F.col(field))
    slot = SLOT_OF_TYPE[typ]
    return F.exists("fields", lambda x: (x["name"] == F.lit(field)) & F.coalesce(test(x[slot]), F.lit(False)))


def term(field: str, value, typ: str, wide: bool = False) -> Column:
    """Exact value (in the field's own type: a float compares as float)."""
    v = _typed_lit(value, typ)
    return _on_field(field, typ, lambda c: c == v, wide)


def range_(field: str, typ: str, lo=None, hi=None, include_lo: bool = True, include_hi: bool = True,
           wide: bool = False) -> Column:
    """Range with open (None), inclusive or exclusive bounds.  An open
    upper bound ends at infinity, so NaN is in no range but one up to NaN."""
    def test(c):
        cond = ~F.isnan(c) if hi is None and typ in ("float", "double") else F.lit(True)
        if lo is not None:
            lv = _typed_lit(lo, typ)
            cond = cond & ((c >= lv) if include_lo else (c > lv))
        if hi is not None:
            hv = _typed_lit(hi, typ)
            cond = cond & ((c <= hv) if include_hi else (c < hv))
        return cond
    return _on_field(field, typ, test, wide)


def fuzzy(field: str, value, spread, typ: str, wide: bool = False) -> Column:
    """``[v - s, v + s]`` both inclusive.  Float bounds are computed in
    32-bit float arithmetic; short bounds in int arithmetic (no overflow)."""
    if typ == "short":
        v, s = F.lit(int(value)).cast("int"), F.lit(int(spread)).cast("int")
        lo, hi = v - s, v + s
        return _on_field(field, typ, lambda c: c.cast("int").between(lo, hi), wide)
    v, s = _typed_lit(value, typ), _typed_lit(spread, typ)
    lo, hi = (v - s).cast(SPARK_TYPE[typ]), (v + s).cast(SPARK_TYPE[typ])
    return _on_field(field, typ, lambda c: c.between(lo, hi), wide)


def exists_(field: str) -> Column:
    """The document has the field (or a field below the dotted path);
    only names are compared.  System fields are in every document."""
    if any(name == field or name.startswith(field + ".") for name in SYSTEM_FIELDS):
        return F.lit(True)
    return F.exists("fields", lambda x: F.coalesce(
        (x["name"] == field) | F.startswith(x["name"], F.lit(field + ".")), F.lit(False)))


def exists_in_build(field: str) -> Column:
    """E4 on a published build: its stored field names."""
    return F.array_contains("_field_names", field)


def match_term(docs: DataFrame, post: DataFrame, field: str, word: str) -> DataFrame:
    """E5: documents whose ``field`` holds the (already analysed) term."""
    hits = post.where((F.col("field") == field) & (F.col("term") == word)).select("_doc")
    return docs.join(hits, "_doc", "left_semi")


def shard_for(doc_id: str, shards: int) -> int:
    """Driver-side route of one id (same hash as the build)."""
    h = int(murmur3_utf16([doc_id])[0])
    return h % shards


def get_by_id(docs: DataFrame, doc_id: str, shards: int) -> DataFrame:
    """The shard is computed up front, so a dataset partitioned by
    ``shard_id`` is pruned to one directory before the id filter runs."""
    return docs.where((F.col("shard_id") == F.lit(shard_for(doc_id, shards))) & (F.col("_id") == F.lit(doc_id)))
