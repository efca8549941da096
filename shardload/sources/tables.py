"""Line-format inputs derived from the driver tables.

The reference reads delimited text whose cells describe themselves.  These
encoders turn the parquet tables into such lines with Spark, so every query
reads the given tables and its work grows with them.  Each encoder returns
``(value STRING)`` plus the ``_doc`` key; the layouts are fixed so that a
plain SQL query over the original table can check the parsed result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardload.sources.lines import with_doc_key

TAB = "\t"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_days(ts: Column) -> Column:
    """Whole days since 1970-01-01 of a (zone-less) timestamp."""
    return F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date"))


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 00:00 of a zone-less timestamp (wall clock)."""
    return (epoch_days(ts).cast("bigint") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
            + F.floor(F.second(ts)).cast("bigint"))


def _kv(name: str, value: Column, typ: str | None = None) -> Column:
    parts = [F.lit(name + ":"), value.cast("string")]
    if typ is not None:
        parts.append(F.lit(":" + typ))
    return F.concat(*parts)


def _line(*cells: Column) -> Column:
    return F.concat_ws(TAB, *cells)


def _cell(*cols: Column) -> Column:
    return F.concat_ws(",", *cols)


def _keyed(df: DataFrame, value: Column) -> DataFrame:
    """Key the table rows (spreading a narrow scan over all cores) and encode.

    The line is produced by a one-element generator: later filters on it
    (the keyed-line split) then stay above it instead of being pushed below
    the spread exchange, where they would build every line a second time on
    the unspread input."""
    return with_doc_key(df, spread=True).select(F.explode(F.array(value)).alias("value"), "_doc")


def orders_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey \\t cust:<long>,total:<double>,status:<s>,day:<integer> \\t <priority tag>``."""
    o = table(spark, sf_dir, "orders")
    return _keyed(o, _line(
        F.col("o_orderkey").cast("string"),
        _cell(_kv("cust", F.col("o_custkey"), "long"),
              _kv("total", F.col("o_totalprice"), "double"),
              _kv("status", F.col("o_orderstatus")),
              _kv("day", epoch_days(F.col("o_orderdate")), "integer")),
        F.col("o_orderpriority")))


def lineitem_id() -> Column:
    return F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"))


def lineitem_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id ``<orderkey>-<linenumber>-<partkey>``; typed cell (mixed-case type
    names), a cell with an unknown type, and a cell with a tag plus
    multi-valued string (``code``) and numeric (``num``) fields."""
    li = table(spark, sf_dir, "lineitem")
    return _keyed(li, _line(
        lineitem_id(),
        _cell(_kv("qty", F.col("l_quantity"), "double"),
              _kv("line", F.col("l_linenumber"), "integer"),
              _kv("part", F.col("l_partkey"), "long"),
              _kv("disc", F.col("l_discount"), "float"),
              _kv("tax", F.col("l_tax"), "FLOAT"),
              _kv("flag", F.col("l_returnflag"))),
        _cell(_kv("price", F.col("l_extendedprice"), "Double"),
              _kv("ship", epoch_days(F.col("l_shipdate")), "short"),
              _kv("status", F.col("l_linestatus"), "text")),
        _cell(F.col("l_returnflag"),
              _kv("code", F.col("l_returnflag")), _kv("code", F.col("l_linestatus")),
              _kv("code", F.col("l_returnflag")),
              _kv("num", F.col("l_linenumber"), "integer"),
              _kv("num", F.col("l_quantity").cast("int"), "integer"))))


# Doubles of ``special_lines`` by order key modulo 50; the last five are not Java's spellings.
SPECIAL_DOUBLES = {0: "NaN", 1: "Infinity", 2: "-Infinity", 3: "-0.0", 4: "0.0",
                   45: "inf", 46: "nan", 47: "-INFINITY", 48: "+Inf", 49: "infinity"}


def special_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey \\t total:<double>,big:<long>``: special doubles among the
    totals, longs from 2^53 up."""
    o = table(spark, sf_dir, "orders")
    total = F.col("o_totalprice").cast("string")
    for k, text in SPECIAL_DOUBLES.items():
        total = F.when(F.col("o_orderkey") % 50 == k, F.lit(text)).otherwise(total)
    return _keyed(o, _line(F.col("o_orderkey").cast("string"),
                           _cell(_kv("total", total, "double"),
                                 _kv("big", F.lit(1 << 53) + F.col("o_orderkey") % 7, "long"))))


def mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose names are declared with a type that changes from line to line:
    ``n`` short/integer/long, ``x`` float/double, ``y`` short/float, ``z`` integer/float, ``big`` long (from 2^53 up) and
    double, ``s`` string/integer, ``N`` (another name than ``n``) integer, and the priority as a tag."""
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    pick = lambda m, *options: F.element_at(F.array(*options), (key % m + 1).cast("int"))
    typed = lambda name, value, *types: F.concat(F.lit(name + ":"), value.cast("string"), F.lit(":"), pick(len(types), *map(F.lit, types)))
    return _keyed(o, _line(
        key.cast("string"),
        _cell(typed("n", key % 100, "short", "integer", "long"),
              typed("x", (key % 8).cast("double") / 4, "float", "double"),
              typed("y", key % 90, "short", "float"),
              typed("z", key % 80, "integer", "float"),
              pick(2, F.concat(F.lit("big:"), (F.lit(1 << 53) + key % 7).cast("string"), F.lit(":long")), F.lit("big:0.5:double")),
              pick(2, F.concat(F.lit("s:a"), (key % 5).cast("string")), F.lit("s:7:integer")),
              _kv("N", key % 3, "integer")),
        F.col("o_orderpriority")))


def part_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``p_partkey \\t size:<short>,price:<float>,brand:<s>,type:<s> \\t <name tag>``."""
    p = table(spark, sf_dir, "part")
    return _keyed(p, _line(
        F.col("p_partkey").cast("string"),
        _cell(_kv("size", F.col("p_size"), "short"),
              _kv("price", F.col("p_retailprice"), "float"),
              _kv("brand", F.col("p_brand")),
              _kv("type", F.col("p_type"))),
        F.col("p_name")))


def events_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed by ``user_id`` (many documents per id).  ``props`` holds ``:``,
    so ``props:{"k": 87}`` parses as an unknown type with value ``{"k"``."""
    e = table(spark, sf_dir, "events")
    return _keyed(e, _line(
        F.col("user_id").cast("string"),
        _cell(_kv("value", F.col("value"), "double"),
              _kv("type", F.col("event_type")),
              _kv("props", F.col("props"))),
        _cell(_kv("ts", epoch_seconds(F.col("ts")), "long"),
              _kv("eid", F.col("event_id"), "long"))))


def docmeta_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id \\t lang:<s>,source:<s>,chars:<short> \\t <lang tag>``; texts
    longer than a short holds make a natural number error."""
    d = table(spark, sf_dir, "documents")
    return _keyed(d, _line(
        F.col("doc_id").cast("string"),
        _cell(_kv("lang", F.col("lang")), _kv("source", F.col("source")),
              _kv("chars", F.col("n_chars"), "short")),
        F.col("lang")))


LINE_BREAK = "\r\n|\r|\n"


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document text, as a text scan of the documents
    would give them (``\\n``, ``\\r\\n`` and ``\\r`` end a line)."""
    d = table(spark, sf_dir, "documents").select("text")
    lines = d.select(F.explode(F.split(F.col("text"), LINE_BREAK, -1)).alias("value"))
    return with_doc_key(lines, spread=True).select("value", "_doc")


FIXTURES = {
    "orders": orders_lines,
    "lineitem": lineitem_lines,
    "part": part_lines,
    "events": events_lines,
    "docmeta": docmeta_lines,
    "text": text_lines,
}


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain positional cells, no self-description (for an external schema):
    ``c_custkey \\t c_name \\t c_nationkey \\t c_acctbal \\t c_mktsegment``."""
    c = table(spark, sf_dir, "customer")
    return _keyed(c, _line(F.col("c_custkey").cast("string"), F.col("c_name"),
                           F.col("c_nationkey").cast("string"), F.col("c_acctbal").cast("string"),
                           F.col("c_mktsegment")))


CUSTOMER_META = "name:string,nation:integer,acctbal:double,segment:string"

FIXTURES["customer"] = customer_lines


# --- audit records ------------------------------------------------------------
# The reference produces these records at run time (file deliveries, shard
# placement).  They are derived here from ``lineitem`` with fixed rules so
# that their size follows the data and an SQL oracle can repeat them.

N_HOSTS = 8


def transfer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(build_id, index, shard_id, host, is_primary, file_type, file,
    bytes_expected, bytes_written, ok)``; a file is complete when the bytes
    written reach the bytes declared."""
    li = table(spark, sf_dir, "lineitem")
    host_no = F.pmod(F.col("l_suppkey"), F.lit(N_HOSTS))
    expected = F.floor(F.col("l_extendedprice")).cast("bigint")
    short = (F.col("l_discount") >= 0.1) & (F.col("l_tax") >= 0.08)
    written = expected - F.when(short, F.lit(1)).otherwise(F.lit(0))
    return li.select(
        F.year("l_shipdate").alias("build_id"),
        F.concat(F.lit("idx_"), F.col("l_returnflag")).alias("index"),
        (F.col("l_linenumber") - 1).alias("shard_id"),
        F.concat(F.lit("node"), host_no.cast("string")).alias("host"),
        (host_no == 0).alias("is_primary"),
        F.when(F.col("l_linestatus") == "F", F.lit("segment")).otherwise(F.lit("translog")).alias("file_type"),
        F.concat(F.lit("f"), F.col("l_orderkey").cast("string")).alias("file"),
        expected.alias("bytes_expected"),
        written.alias("bytes_written"),
        (written >= expected).alias("ok"))


def shard_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ts, index, shard_id, role, host, assigned, active)`` placement records."""
    li = table(spark, sf_dir, "lineitem")
    host_no = F.pmod(F.col("l_suppkey"), F.lit(N_HOSTS))
    return li.select(
        F.year("l_shipdate").alias("ts"),
        F.concat(F.lit("idx_"), F.col("l_returnflag")).alias("index"),
        (F.col("l_linenumber") - 1).alias("shard_id"),
        F.when(host_no == 0, F.lit("primary")).otherwise(F.lit("replica")).alias("role"),
        F.concat(F.lit("node"), host_no.cast("string")).alias("host"),
        (F.col("l_discount") < 0.1).alias("assigned"),
        (F.col("l_tax") < 0.08).alias("active"))


def documents_docs(spark: SparkSession, sf_dir: str, shards: int) -> DataFrame:
    """Documents as routed index documents: ``(_doc, _id, shard_id, lang, text)``.
    The text holds ``,`` and ``:``, so it is indexed directly rather than
    through the line format."""
    from shardload.functions.routing_hash import shard_of
    d = table(spark, sf_dir, "documents")
    d = d.select(F.col("doc_id").alias("_doc"), F.col("doc_id").cast("string").alias("_id"),
                 shard_of(F.col("doc_id").cast("string"), shards).alias("shard_id"), "lang", "text")
    return d.repartition(F.col("_doc"))  # by the document's key: grouping by document needs no second shuffle
