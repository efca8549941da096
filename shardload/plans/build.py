"""The import plan: lines → keyed → documents → routed (→ placed, ordered).

Up to the write this is one Catalyst plan with one exchange (``by_shard``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardload import DEFAULT_DELIM, DEFAULT_SHARDS, DEFAULT_TYPE
from shardload.operators.docs import assemble
from shardload.operators.fields import parse_docs, parse_in_place, parse_meta_fields
from shardload.operators.routing import by_bytes, by_shard, order_shard, route
from shardload.sources.lines import keyed_lines

#: Bytes of ids and payloads that a task sorts, unless told otherwise; short lines take about twenty times that in memory.
RANGE_BYTES = 32 << 20


def parsed_docs(lines: DataFrame, delim: str = DEFAULT_DELIM, auto_id: bool = False,
                on_error: str = "fail", shards: int = DEFAULT_SHARDS, in_batch: bool = False) -> DataFrame:
    """``(_doc, _id, shard_id, fields)`` — parsed and routed, not yet placed.

    The routing hash runs on the thin keyed lines, before the parse, so the
    rows held while Python hashes a batch are ids and payloads, not parsed
    field arrays."""
    keyed = route(keyed_lines(lines, delim=delim, auto_id=auto_id), shards)
    return parse_docs(keyed, delim=delim, on_error=on_error, in_batch=in_batch)


def placed_lines(keyed: DataFrame, shards: int = DEFAULT_SHARDS, split: int = 1, range_bytes: int | None = None) -> DataFrame:
    """``(_doc, _id, payload, shard_id)`` in its shard's partition and order: ``split`` ranges of equally many lines a
    shard, or as many ranges as each shard's bytes ask for, of ``range_bytes`` (without either, ``RANGE_BYTES``):
    what one task sorts does not grow with the input."""
    routed = route(keyed, shards)
    if range_bytes is None and split <= 1:
        range_bytes = RANGE_BYTES
    if range_bytes:
        return order_shard(by_bytes(routed, shards, F.octet_length("payload") + F.octet_length("_id"), range_bytes))
    return order_shard(by_shard(routed, shards, split))


def shard_docs(lines: DataFrame, index: str, doc_type: str = DEFAULT_TYPE,
               delim: str = DEFAULT_DELIM, auto_id: bool = False, on_error: str = "fail",
               shards: int = DEFAULT_SHARDS, split: int = 1, with_all: bool = False,
               source_dup: str = "keep", range_bytes: int | None = None) -> DataFrame:
    """Full documents, one partition (or ``split`` ranges, or as many as
    the shard's bytes ask for) per shard, in descending id order inside each shard.  Lines are placed and sorted as
    they are; parse and assembly are projections above, so one exchange moves
    the text once and the order holds."""
    placed = placed_lines(keyed_lines(lines, delim=delim, auto_id=auto_id), shards, split, range_bytes)
    return assemble(parse_in_place(placed, delim, on_error), index, doc_type, with_all=with_all, dup=source_dup)


def shard_fields(keyed: DataFrame, index: str, doc_type: str = DEFAULT_TYPE, shards: int = DEFAULT_SHARDS,
                 split: int = 1, with_all: bool = False, source_dup: str = "keep", range_bytes: int | None = None,
                 **parse) -> DataFrame:
    """``shard_docs`` for keyed lines whose cells an external schema types (``meta``)."""
    return assemble(parse_meta_fields(placed_lines(keyed, shards, split, range_bytes), **parse), index, doc_type,
                    with_all=with_all, dup=source_dup)


def numeric_value():
    """Any numeric slot of a long-form field row, as DOUBLE."""
    return F.coalesce(F.col("i").cast("double"), F.col("l").cast("double"), F.col("s").cast("double"),
                      F.col("f").cast("double"), F.col("d"))
