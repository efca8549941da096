"""Conjunctive search over a published build's inverted index.

A clause names a run of the stored index: a string term (``postings``) or a range of
numeric terms (``numeric_terms``).  Both tables are sorted by field and term, so a run
is a pushed-down filter that reads its own row groups.  The runs are intersected per
shard, the rarest first: what is left bounds the ids that the next run is read for,
and only shards where every clause has a document are looked at further.  Documents
are fetched last, from the files whose shard and id range hold a match.

Runs are keyed by document, so a term that half of all documents hold is spread over
all tasks.  A side is broadcast only behind a count (``BROADCAST``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardload.operators.postings import ANALYZERS, ENGLISH_STOP_WORDS
from shardload.session import scratch_path

#: Matches (shard, key, id) up to which a side is broadcast.
BROADCAST = 500_000
INTEGRAL = ("integer", "long", "short")
SPARK = {"integer": "int", "long": "bigint", "short": "smallint", "float": "float", "double": "double"}


@dataclass(frozen=True)
class Term:
    """E5: string field ``field`` holds the analysed ``term``."""
    field: str
    term: str


@dataclass(frozen=True)
class Range:
    """Numeric field with a value between bounds (None is open); an open upper bound ends at infinity."""
    field: str
    type: str
    lo: object = None
    hi: object = None
    include_lo: bool = True
    include_hi: bool = True


def equals(field: str, value, typ: str) -> Range:
    """E1 as a range of one value."""
    return Range(field, typ, value, value)


def around(field: str, value, spread, typ: str) -> Range:
    """``[value - spread, value + spread]``; a float's bounds are computed as 32-bit floats, a short's as integers."""
    if typ in ("float", "double"):
        import numpy as np
        kind = np.float32 if typ == "float" else np.float64
        return Range(field, typ, float(kind(value) - kind(spread)), float(kind(value) + kind(spread)))
    return Range(field, typ, int(value) - int(spread), int(value) + int(spread))


def words(spark: SparkSession, field: str, text: str, analyzer: str = "standard", stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS) -> list[Term]:
    """The terms that the analysis of the build makes of a query text: all of them have to match."""
    row = spark.range(1).select(ANALYZERS[analyzer](F.lit(text)).alias("t")).first()
    return [Term(field, t) for t in dict.fromkeys(row.t) if t not in stop_words]


def _run(tables: dict[str, DataFrame], clause: Term | Range) -> DataFrame:
    """``(shard_id, _doc, _id)`` of a clause; a document may stand there more than once."""
    if isinstance(clause, Term):
        hits = tables["postings"].where((F.col("field") == clause.field) & (F.col("term") == clause.term))
        return hits.select("shard_id", "_doc", "_id")
    whole = clause.type in INTEGRAL
    value = F.col("whole" if whole else "real")
    bound = lambda v: F.lit(v).cast("bigint" if whole else SPARK[clause.type]).cast("bigint" if whole else "double")
    test: Column = value.isNotNull()
    if clause.lo is not None:
        test = test & ((value >= bound(clause.lo)) if clause.include_lo else (value > bound(clause.lo)))
    if clause.hi is not None:
        test = test & ((value <= bound(clause.hi)) if clause.include_hi else (value < bound(clause.hi)))
    elif not whole:
        test = test & ~F.isnan(value)
    hits = tables["numeric_terms"].where((F.col("field") == clause.field) & (F.col("type") == clause.type) & test)
    return hits.select("shard_id", "_doc", "_id")


def _saved(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "search")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def intersect(tables: dict[str, DataFrame], clauses: list[Term | Range]) -> DataFrame:
    """``(shard_id, _doc, _id)`` of the documents that every clause matches, written to the shared folder."""
    runs = [_run(tables, c) for c in clauses]
    counted = reduce(DataFrame.unionByName, [r.select(F.lit(k).alias("clause"), "shard_id") for k, r in enumerate(runs)])
    sizes: dict[int, dict[int, int]] = {k: {} for k in range(len(runs))}
    for r in counted.groupBy("clause", "shard_id").count().collect():  # clauses x shards
        sizes[r["clause"]][r["shard_id"]] = r["count"]
    shards = sorted(set.intersection(*[set(s) for s in sizes.values()]))
    order = sorted(sizes, key=lambda k: sum(sizes[k].get(s, 0) for s in shards))
    in_shards = F.col("shard_id").isin(shards) if shards else F.lit(False)
    found = _saved(runs[order[0]].where(in_shards).distinct())
    for k in order[1:]:
        left = found.agg(F.count(F.lit(1)), F.min("_id"), F.max("_id"), F.collect_set("shard_id")).first()  # shards at most
        if not left[0]:
            break
        other = runs[k].where(F.col("shard_id").isin(left[3]) & F.col("_id").between(left[1], left[2]))
        key = ["shard_id", "_doc"]
        if left[0] <= BROADCAST:  # the few of a rare run look the others up
            found = _saved(other.join(F.broadcast(found.select(*key)), key, "left_semi").distinct())
        else:
            found = _saved(found.join(other, key, "left_semi"))
    return found


def _documents(spark: SparkSession, root: str, build: str, found: DataFrame, fmt: str) -> DataFrame:
    """The stored documents of ``found``, from the files that can hold them."""
    from shardload.plans.files import files_holding, open_files
    from shardload.plans.publish import read_current, read_files
    n = found.count()
    files = read_files(spark, root, build)
    hits = files_holding(files, found.select("shard_id", "_id").distinct()) if n else []
    docs = open_files(spark, root, hits, fmt) if hits else read_current(spark, root, fmt).where(F.lit(False))
    keys = found.select("shard_id", "_doc")
    return docs.join(F.broadcast(keys) if n <= BROADCAST else keys, ["shard_id", "_doc"], "left_semi").select(docs.columns)


def search(spark: SparkSession, root: str, *clauses: Term | Range, fmt: str = "parquet") -> DataFrame:
    """The documents of the live build that every clause matches.  The build must have been published with postings."""
    from shardload.plans.publish import live_build, read_current_part
    if not clauses:
        raise ValueError("a search needs at least one clause")
    build = live_build(spark, root)
    tables = {}
    if any(isinstance(c, Term) for c in clauses):
        tables["postings"] = read_current_part(spark, root, "postings", fmt)
    if any(isinstance(c, Range) for c in clauses):
        tables["numeric_terms"] = read_current_part(spark, root, "numeric_terms", fmt)
    return _documents(spark, root, build, intersect(tables, list(clauses)), fmt)
