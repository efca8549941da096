"""Line sources (A1-A5): text scan, keyed-line split, ids, external metadata.

Output of ``keyed_lines``: ``_doc BIGINT`` (per-line document key, unique
and stable for a deterministic input split), ``_id STRING``, ``payload STRING``.
Duplicate ids stay separate documents, so ``_doc`` — not ``_id`` — is the
document key everywhere downstream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from shardload import DEFAULT_DELIM
from shardload.functions.split import java_split, quote, strip_leading, strip_trailing

# Declared type names understood by the line format.
TYPE_NAMES = ("integer", "long", "short", "float", "double", "string")
SPARK_TYPES = {"integer": "int", "long": "bigint", "short": "smallint",
               "float": "float", "double": "double", "string": "string"}
DDL_TO_TYPE = {v: k for k, v in SPARK_TYPES.items()}


def read_lines(spark: SparkSession, path: str | list[str], line_sep: str | None = None) -> DataFrame:
    """A1: scan text files, one row per line (``value``) with its file path."""
    reader = spark.read.format("text")
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    df = reader.load(path)
    return df.select("value", F.col("_metadata.file_path").alias("_file"))


def with_doc_key(lines: DataFrame, spread: bool = False) -> DataFrame:
    """Attach ``_doc``: partition-local position, stable under task retry for a
    deterministic scan (same splits give the same keys).

    With ``spread``, the keyed lines are hash-partitioned on ``_doc``: for an
    input of few partitions (one unsplittable file or row group, a gzip file)
    whose CPU-heavy parse should run on every core.  Hash placement is
    deterministic, so a retried task sees the same rows.
    """
    keyed = lines.withColumn("_doc", F.monotonically_increasing_id())
    return keyed.repartition(F.col("_doc")) if spread else keyed


def numbered_lines(spark: SparkSession, path: str | list[str], line_sep: str | None = None) -> DataFrame:
    """A1 with ``_line``, the line's number in its file from 0, whatever the
    splits: lines are counted per file block first (one row a block), then each
    block's lines start where the blocks before it end."""
    reader = spark.read.format("text")
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    lines = reader.load(path).select("value", F.col("_metadata.file_path").alias("_file"),
                                     F.col("_metadata.file_block_start").alias("_block"),
                                     F.monotonically_increasing_id().alias("_at"))
    before = F.sum("n").over(Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = (lines.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("_first"))
              .select("_file", "_block", "_first", F.coalesce(before, F.lit(0)).alias("_before")))
    return lines.join(blocks, ["_file", "_block"]).select(
        "value", "_file", (F.col("_before") + F.col("_at") - F.col("_first")).alias("_line"))


def has_cells(value: Column, delim: str) -> Column:
    """``value.split(delim).length >= 1`` in Java: false only for a non-empty
    line made of delimiters."""
    return (value == F.lit("")) | (strip_trailing(value, delim) != F.lit(""))


def keyed_lines(lines: DataFrame, delim: str = DEFAULT_DELIM, auto_id: bool = False,
                id_seed: str = "") -> DataFrame:
    """A2/A3/A4: split off the id (explicit mode) or make one (auto mode).

    Explicit mode keeps lines with at least two cells; the payload is the rest
    of the line without trailing delimiters and without leading empty cells
    (the re-join adds a delimiter only after non-empty content).
    """
    if "_doc" not in lines.columns:
        lines = with_doc_key(lines)
    v = F.col("value")
    if auto_id:
        return (lines.where(has_cells(v, delim))
                .select("_doc", auto_id_col(lines, id_seed).alias("_id"), v.alias("payload")))
    staged = lines.select("_doc", strip_trailing(v, delim).alias("_s"))
    first = F.instr(F.col("_s"), delim)
    rest = F.substr(F.col("_s"), first + F.lit(len(delim)))
    return (staged.where(first > 0)
            .select("_doc",
                    F.substring_index(F.col("_s"), delim, 1).alias("_id"),
                    strip_leading(rest, delim).alias("payload")))


def dropped_lines(lines: DataFrame, delim: str = DEFAULT_DELIM) -> DataFrame:
    """Lines that explicit-id mode drops (fewer than two cells)."""
    if "_doc" not in lines.columns:
        lines = with_doc_key(lines)
    s = strip_trailing(F.col("value"), delim)
    return lines.where(F.instr(s, delim) == 0).select("_doc", "value")


def auto_id_col(lines: DataFrame, seed: str = "") -> Column:
    """A3: 22-character URL-safe base64 id (16 bytes), stable per line.

    A random UUID would change when a task is retried; this one is a digest of
    (seed, file, line number) for ``numbered_lines``, the same on any cluster,
    or else of the line key, the same for the same split.
    """
    file_part = F.col("_file") if "_file" in lines.columns else F.lit("")
    line = F.col("_line" if "_line" in lines.columns else "_doc").cast("string")
    digest = F.unhex(F.md5(F.concat_ws("\u0001", F.lit(seed), file_part, line)))
    b64 = F.translate(F.base64(digest), "+/", "-_")
    return F.substring(b64, 1, 22)


def auto_id(lines: DataFrame, seed: str = "", delim: str = DEFAULT_DELIM) -> DataFrame:
    """A3: auto-id mode: every line (except delimiter-only ones) becomes a
    document with a generated id; the whole line is the payload."""
    return keyed_lines(lines, delim=delim, auto_id=True, id_seed=seed)


def parse_meta(meta: str) -> StructType:
    """A5: ``name:type,name:type`` → Spark schema (driver-side, tiny)."""
    fields = []
    for item in [m for m in meta.split(",") if m.strip()]:
        name, _, typ = item.strip().partition(":")
        typ = (typ or "string").strip().lower()
        fields.append(StructField(name.strip(), _ddl_type(SPARK_TYPES.get(typ, "string")), True))
    return StructType(fields)


def _ddl_type(ddl: str):
    from pyspark.sql.types import (DoubleType, FloatType, IntegerType, LongType,
                                   ShortType, StringType)
    return {"int": IntegerType(), "bigint": LongType(), "smallint": ShortType(),
            "float": FloatType(), "double": DoubleType()}.get(ddl, StringType())


def parse_with_schema(keyed: DataFrame, meta: str | StructType, delim: str = DEFAULT_DELIM) -> DataFrame:
    """A5: positional cells typed by an external ``name:type`` list.

    Cell ``k`` of the payload is column ``k``; missing cells are null and a
    value that does not parse is null (``try_cast``), with the count of such
    values in ``_bad``.
    """
    from shardload.operators.fields import coerce
    schema = parse_meta(meta) if isinstance(meta, str) else meta
    cells = java_split(F.col("payload"), delim)
    cols, bad = [], []
    for k, f in enumerate(schema.fields):
        raw = F.get(cells, k)
        typed = coerce(raw, DDL_TO_TYPE.get(f.dataType.simpleString(), "string")).cast(f.dataType)
        cols.append(typed.alias(f.name))
        bad.append(F.when(raw.isNotNull() & typed.isNull(), 1).otherwise(0))
    bad_sum = bad[0] if len(bad) == 1 else sum(bad[1:], bad[0])
    return keyed.select("_doc", "_id", *cols, bad_sum.alias("_bad"))


__all__ = ["read_lines", "keyed_lines", "dropped_lines", "auto_id", "auto_id_col", "with_doc_key",
           "parse_meta", "parse_with_schema", "has_cells", "quote", "TYPE_NAMES"]
