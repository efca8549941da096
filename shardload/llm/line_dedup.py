"""Line dedup by site-relative frequency (DataFrame functions only).

Group by host; a line's ratio is the number of the host's pages that contain it
over all pages of the host.  Lines above the ratio are boilerplate of that host
and are removed from its pages.

Defined results: lines end at ``\\n`` and are compared without outer spaces, by a 64-bit hash;
blank lines always stay; a line counts once per page however often it occurs;
a null text stays null (it counts as a page without lines); a null host is a
host of its own; a page that is all boilerplate keeps its row with the text ''
or its blank lines; repeated rows are pages of their own
unless ``copies_once`` is set (the lines are removed from all rows alike); extra columns pass
through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardload.llm.common import saved, small

MAX_RATIO = 0.08
MIN_PAGES = 5
#: Hosts, and boilerplate lines of all hosts, up to which these are broadcast.
BROADCAST_HOSTS, BROADCAST_LINES = 20_000, 500_000
#: Lines of a host that a look-up walks one by one; more are dealt to so many arrays.
FEW, BUCKETS = 32, 256


def _line_keys(text: Column) -> Column:
    return F.transform(F.split(text, "\n", -1), lambda x: F.xxhash64(F.trim(x)))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO,
                min_pages: int = MIN_PAGES, copies_once: bool = False) -> DataFrame:
    """``(host, lines ARRAY<BIGINT>)``: hashes of every host's boilerplate lines.
    With ``copies_once`` pages of one text count as one page of their host.

    A host's array is short by construction: every entry is on more than
    ``max_ratio`` of its pages, so there are fewer entries than the mean number
    of lines per page divided by ``max_ratio``."""
    d = docs.select(F.col(host).alias("h"), F.col(text).alias("t"))
    d = d.select("h", "t", F.array_distinct(_line_keys(F.col("t"))).alias("keys"))
    if copies_once:
        d = saved(d.groupBy("h", F.md5("t").alias("t")).agg(F.first("keys").alias("keys")), "line-pages")
    pages = d.groupBy("h").agg(F.count(F.lit(1)).alias("pages"))
    blank = F.xxhash64(F.lit(""))
    lines = (d.where(F.col("t").isNotNull())
             .select("h", F.explode("keys").alias("line"))
             .where(F.col("line") != blank)
             .groupBy("h", "line").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") >= min_pages))
    return (lines.alias("l").join(pages.alias("p"), F.col("l.h").eqNullSafe(F.col("p.h")))
            .where(F.col("n") > F.lit(max_ratio) * F.col("pages"))
            .groupBy(F.col("l.h").alias("h")).agg(F.collect_list("line").alias("lines")))


def _buckets(lines: Column) -> Column:
    """The lines of a host in ``BUCKETS`` arrays by hash (a few lines in one), so that a look-up walks only its own."""
    return F.when(F.size(lines) <= FEW, F.array(lines)).otherwise(F.transform(
        F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.filter(lines, lambda x: F.pmod(x, F.lit(BUCKETS)) == b)))


def _holds(buckets: Column, line: Column) -> Column:
    at = F.when(F.size(buckets) == 1, F.lit(0)).otherwise(F.pmod(line, F.lit(BUCKETS)).cast("int"))
    return F.array_contains(F.get(buckets, at), line)


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO,
                     min_pages: int = MIN_PAGES, counts: bool = False, copies_once: bool = False) -> DataFrame:
    """``docs`` with boilerplate lines removed from ``text``; with ``counts``
    also ``n_lines`` and ``n_dropped`` (null text: 0 and 0), which must not be
    columns of ``docs`` then."""
    marks = saved(boilerplate(docs, host, text, max_ratio, min_pages, copies_once), "boilerplate")
    entries = marks.agg(F.sum(F.size("lines"))).first()[0] or 0
    marks = marks.select("h", _buckets(F.col("lines")).alias("lines"))
    if entries <= BROADCAST_LINES:
        marks = small(marks, BROADCAST_HOSTS)  # else a join by host, whose hot hosts are split
    marks = marks.select(F.struct("h", "lines").alias("__boilerplate"))
    joined = docs.join(marks, F.col(f"`{host}`").eqNullSafe(F.col("__boilerplate.h")), "left")
    bad = F.col("__boilerplate.lines")
    all_lines = F.split(F.col(f"`{text}`"), "\n", -1)
    kept = F.filter(all_lines, lambda x: ~_holds(bad, F.xxhash64(F.trim(x))))
    out = [F.when(bad.isNull(), F.col(f"`{text}`")).otherwise(F.array_join(kept, "\n")).alias(text)
           if c == text else F.col(f"`{c}`") for c in docs.columns]
    if counts:
        n = F.coalesce(F.size(all_lines), F.lit(0))
        out += [F.when(F.col(f"`{text}`").isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
                F.when(F.col(f"`{text}`").isNull() | bad.isNull(), 0).otherwise(n - F.size(kept)).cast("long")
                .alias("n_dropped")]
    return joined.select(*out)


#: The same result in DuckDB, over ``documents``.
ORACLE = f"""
WITH pages AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
rows AS (SELECT doc_id, source, text, row_number() OVER () AS r FROM documents),
cut AS (SELECT r, source, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM rows WHERE text IS NOT NULL),
freq AS (SELECT source, trim(line) AS line, count(DISTINCT r) AS n FROM cut WHERE trim(line) <> '' GROUP BY ALL),
bad AS (SELECT f.source, f.line FROM freq f JOIN pages p ON f.source IS NOT DISTINCT FROM p.source
        WHERE f.n >= {MIN_PAGES} AND f.n > {MAX_RATIO} * p.pages),
marked AS (SELECT c.r, c.i, c.line, b.line IS NOT NULL AS drop FROM cut c
           LEFT JOIN bad b ON b.source IS NOT DISTINCT FROM c.source AND b.line = trim(c.line)),
agg AS (SELECT r, count(*) AS n_lines, count(*) FILTER (drop) AS n_dropped,
               coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT drop), '') AS text FROM marked GROUP BY r)
SELECT rows.doc_id, agg.text, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped
FROM rows LEFT JOIN agg ON rows.r = agg.r
"""
