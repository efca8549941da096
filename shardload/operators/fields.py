"""Field parsing (B1-B8) and schema discovery.

A document's payload is split into cells (delimiter), columns (``,``) and
parts (``:``), all with Java split rules.  Each column becomes one field
struct; the document keeps its fields as an ordered array, so no shuffle is
needed to assemble it.  ``fields_long`` explodes to one row per field.

Field struct: ``pos INT, name STRING, type STRING, raw STRING, i INT,
l BIGINT, s SMALLINT, f FLOAT, d DOUBLE, str STRING, error STRING`` — exactly
one value slot is set for a valid field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardload import DEFAULT_DELIM
from shardload.functions.field_parse import NUMERIC_TYPES, TAG_PREFIX, parsed, parsed_checked
from shardload.functions.field_sums import partial_sums
from shardload.functions.field_values import some_members
from shardload.functions.split import java_split

# Fixed values of the line format.
INTEGRAL = "^[+-]?[0-9]+$"          # Integer/Long/Short.valueOf take no blanks
NAMED_NUMBER = "^[+-]?(NaN|Infinity)$"  # Double/Float.valueOf, upper and lower case as written

ON_ERROR = ("fail", "reject", "null")


def columns_of(payload: Column, delim: str = DEFAULT_DELIM) -> Column:
    """B1: cell → column flatten, ``array<string>`` in input order.

    (A single regex rewrite-and-split was tried; Java's look-ahead regex made
    it slower than these nested fast-path splits.)"""
    return F.flatten(F.transform(java_split(payload, delim), lambda cell: java_split(cell, ",")))


SPARK_TYPE = {"integer": "int", "long": "bigint", "short": "smallint", "float": "float", "double": "double"}


def coerce(value: Column, typ: str) -> Column:
    """Text → typed value with Java's parse rules; null when it does not
    parse.  Integral types take an optional sign and ASCII digits only (no
    blanks, no fraction); float and double accept what ``Double.valueOf``
    accepts (surrounding blanks, exponent, ``NaN``/``Infinity``)."""
    typ = typ.lower()
    if typ not in SPARK_TYPE:
        return value
    cast = value.try_cast(SPARK_TYPE[typ])
    if typ in ("integer", "long", "short"):
        return F.when(value.rlike(INTEGRAL), cast)
    # The cast takes more spellings of these two than Java; every one holds an n.
    named = F.lower(value).contains("n")
    return F.when(~named | F.trim(value).rlike(NAMED_NUMBER), cast)


def split_fields(keyed: DataFrame, delim: str = DEFAULT_DELIM) -> DataFrame:
    """B1 long form of the raw columns: ``(_doc, _id, pos, column)``."""
    return keyed.select("_doc", "_id", F.posexplode(columns_of(F.col("payload"), delim)).alias("pos", "column")) \
        .withColumn("pos", F.col("pos").cast("int"))


def parse_fields(payload: Column, delim: str = DEFAULT_DELIM) -> Column:
    """``array<field>`` of a payload; positions are 0-based over all columns."""
    return parsed(payload, delim)


def fail_on_error(fields: Column, doc_id: Column) -> Column:
    """The fields as they are; a bad value raises when its field is evaluated."""
    message = F.concat(F.lit("bad field value in document "), doc_id)
    return F.transform(fields, lambda x: x.withField(
        "error", F.when(x["error"].isNull(), x["error"]).otherwise(F.raise_error(message).cast("string"))))


BAD = "_bad"


def bad_values(fields: Column, payload: Column, delim: str = DEFAULT_DELIM) -> Column:
    """``array<struct<pos, token, reason>>`` of a document's bad columns; null if it has none."""
    bad = F.filter(fields, lambda x: x["error"].isNotNull())
    return F.when(has_error(fields), F.transform(bad, lambda x: F.struct(
        x["pos"].alias("pos"), F.get(columns_of(payload, delim), x["pos"]).alias("token"), x["error"].alias("reason"))))


def kept(docs: DataFrame) -> DataFrame:
    """The documents without bad values of a build in ``reject`` mode; of any other, all."""
    return docs.where(F.col(BAD).isNull()).drop(BAD) if BAD in docs.columns else docs


def rejected(docs: DataFrame) -> DataFrame:
    """``(_doc, _id, shard_id, pos, token, reason)`` of the rejected documents of a build."""
    if BAD not in docs.columns:
        raise ValueError("the build was not made in reject mode")
    return docs.where(F.col(BAD).isNotNull()).select("_doc", "_id", "shard_id", F.explode(BAD).alias("b")) \
        .select("_doc", "_id", "shard_id", "b.*")


def has_error(fields: Column) -> Column:
    return F.exists(fields, lambda x: x["error"].isNotNull())


def check_on_error(on_error: str) -> None:
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")


def parse_in_place(keyed: DataFrame, delim: str = DEFAULT_DELIM, on_error: str = "fail") -> DataFrame:
    """``fields`` in place of ``payload``, by projections only: the rows keep
    their partition and order.  No document is lost: ``fail`` raises, ``null``
    keeps bad fields with null slots, ``reject`` marks documents in ``_bad``
    (see ``kept`` and ``rejected``)."""
    check_on_error(on_error)
    if on_error == "fail":
        return keyed.withColumn("fields", parsed_checked(F.col("payload"), F.col("_id"), delim)).drop("payload")
    docs = keyed.withColumn("fields", parse_fields(F.col("payload"), delim))
    if on_error == "reject":
        docs = docs.withColumn(BAD, bad_values(F.col("fields"), F.col("payload"), delim))
    return docs.drop("payload")


def parse_meta_fields(keyed: DataFrame, meta: str, delim: str = DEFAULT_DELIM, on_error: str = "fail") -> DataFrame:
    """A5: ``fields`` from positional cells typed by ``name:type,name:type``:
    cell ``k`` is the field of the ``k``-th name, an absent cell gives none, a
    type that is not a number type is a string.  Bad cells as in ``parse_in_place``."""
    check_on_error(on_error)
    names = [m.strip().partition(":") for m in meta.split(",") if m.strip()]
    cells = java_split(F.col("payload"), delim)

    def one(k: int, name: str, typ: str) -> Column:
        typ, raw = typ.strip().lower() or "string", F.get(cells, F.lit(k))
        typ = typ if typ in NUMERIC_TYPES else "string"
        slots = [F.when(F.lit(t == typ), coerce(raw, t)).alias(slot) for slot, t in zip("ilsfd", NUMERIC_TYPES)]
        value = coerce(raw, typ)
        return F.when(raw.isNotNull(), F.struct(
            F.lit(k).alias("pos"), F.lit(name.strip()).alias("name"), F.lit(typ).alias("type"), raw.alias("raw"), *slots,
            F.when(F.lit(typ == "string"), raw).alias("str"),
            F.when(value.isNull(), F.lit("bad_" + typ)).alias("error")))

    fields = F.filter(F.array(*[one(k, n, t) for k, (n, _, t) in enumerate(names)]), lambda x: x.isNotNull())
    docs = keyed.withColumn("fields", fields)
    if on_error == "reject":
        bad = F.filter("fields", lambda x: x["error"].isNotNull())
        docs = docs.withColumn(BAD, F.when(has_error(F.col("fields")), F.transform(bad, lambda x: F.struct(
            x["pos"].alias("pos"), x["raw"].alias("token"), x["error"].alias("reason")))))
    elif on_error == "fail":
        docs = docs.withColumn("fields", fail_on_error(F.col("fields"), F.col("_id")))
    return docs.drop("payload")


def parse_docs(keyed: DataFrame, delim: str = DEFAULT_DELIM, on_error: str = "fail", in_batch: bool = False) -> DataFrame:
    """Keyed lines → ``(_doc, _id, fields)``.

    ``on_error``: ``fail`` raises on the first bad value (the reference's
    behaviour), ``reject`` leaves documents with a bad value out (``rejects``
    has them; a build in this mode keeps them beside the others),
    ``null`` keeps them with the bad fields' value slots null.

    ``in_batch`` (with ``fail``) is for a plan that takes ``fields`` once, by a batch function such as those of
    ``field_values``: Spark runs it in the call that parses, and a bad value raises there.  Such a plan must not filter on
    ``fields`` (the filter would parse again), and one that does not take them checks no values.
    """
    check_on_error(on_error)
    if in_batch:
        if on_error != "fail":
            raise ValueError("in_batch is for on_error='fail'")
        extra = [c for c in keyed.columns if c not in ("_doc", "_id", "payload")]
        return keyed.select("_doc", "_id", *extra, parsed_checked(F.col("payload"), F.col("_id"), delim).alias("fields"))
    # The parse sits in a generator so that a filter on its result cannot be
    # pushed below it and evaluate the whole parse a second time.
    extra = [c for c in keyed.columns if c not in ("_doc", "_id", "payload")]
    docs = keyed.select("_doc", "_id", *extra,
                        F.explode(F.array(parse_fields(F.col("payload"), delim))).alias("fields"))
    if on_error == "reject":
        return docs.where(~has_error(F.col("fields")))
    if on_error == "fail":
        check = F.when(has_error(F.col("fields")),
                       F.raise_error(F.concat(F.lit("bad field value in document "), F.col("_id"))))
        return docs.where(check.isNull())
    return docs


def typed_fields(keyed: DataFrame, delim: str = DEFAULT_DELIM, on_error: str = "fail") -> DataFrame:
    """The survey's name for ``parse_docs``."""
    return parse_docs(keyed, delim=delim, on_error=on_error)


def rejects(keyed: DataFrame, delim: str = DEFAULT_DELIM) -> DataFrame:
    """One row per bad column of every rejected document:
    ``(_doc, _id, pos, token, reason)``."""
    # Generator barrier, as in parse_docs: the filter below must not re-parse.
    docs = keyed.select("_doc", "_id", "payload", F.explode(F.array(parse_fields(F.col("payload"), delim))).alias("fields"))
    return (docs.where(has_error(F.col("fields")))
            .select("_doc", "_id", F.explode(bad_values(F.col("fields"), F.col("payload"), delim)).alias("b"))
            .select("_doc", "_id", "b.*"))


def fields_long(docs: DataFrame, keep: tuple[str, ...] = ("_doc", "_id"), outer: bool = False,
                members: tuple[str, ...] | None = None) -> DataFrame:
    """B1 long form: one row per field (``outer`` keeps empty documents as
    one all-null row; positions are in the ``pos`` field).  With ``members`` the
    others are left out in the batch, before the rows are made (``parse_docs``, ``in_batch``)."""
    keep = tuple(c for c in keep if c in docs.columns)
    if members is not None:
        docs = docs.select(*keep, some_members(F.col("fields"), list(members)).alias("fields"))
    gen = F.explode_outer("fields") if outer else F.explode("fields")
    if members is not None and not outer:
        # Spark filters what ``explode`` takes by its size, and would parse for that once more.
        return docs.select(*keep, F.explode_outer("fields").alias("f")).where("f IS NOT NULL").select(*keep, "f.*")
    return docs.select(*keep, gen.alias("f")).select(*keep, "f.*")


def value_string(f: Column) -> Column:
    """Canonical text of a field value (numbers in Java's ``toString`` form)."""
    return F.coalesce(f["str"], f["i"].cast("string"), f["l"].cast("string"), f["s"].cast("string"),
                      f["f"].cast("string"), f["d"].cast("string"))


# Distinct values inside a row are taken over one string each: Spark keeps a hash
# set of strings, but compares structs pair by pair.
_LENGTH = 10


def distinct_key(name: Column, typ: Column, value: Column | None = None) -> Column:
    """Name, type and value as one string: two fixed-width lengths, then the parts."""
    width = lambda c: F.lpad(F.length(c).cast("string"), _LENGTH, "0")
    return F.concat(width(name), width(typ), name, typ, *([F.coalesce(value, F.lit("\0"))] if value is not None else []))


def key_part(key: Column, part: int) -> Column:
    """Name (0) or type (1) of a ``distinct_key``."""
    n = [F.substring(key, 1 + k * _LENGTH, _LENGTH).cast("int") for k in (0, 1)]
    return F.substr(key, F.lit(2 * _LENGTH + 1) + (n[0] if part else F.lit(0)), n[part])


def key_value(key: Column) -> Column:
    """The value of a ``distinct_key``."""
    n = [F.substring(key, 1 + k * _LENGTH, _LENGTH).cast("int") for k in (0, 1)]
    return F.substr(key, F.lit(2 * _LENGTH + 1) + n[0] + n[1])


def infer_fields(docs: DataFrame, in_batch: bool = False) -> DataFrame:
    """Per field name, the declared types seen, documents and values.

    One pass, one aggregation: each batch emits a row for every (name, type) it has;
    only these partial sums are shuffled.  ``in_batch`` as in ``parse_docs``.
    """
    if in_batch:
        docs = docs.select(some_members(F.col("fields"), ["name", "type"]).alias("fields"))
    return (partial_sums(docs, ranges=False).groupBy("name", "type")
            .agg(F.sum("dc").alias("docs"), F.sum("ttf").alias("n_values")))
