"""Document assembly.

Every function works inside one document row (higher-order functions over
the ``fields`` array), so assembly costs no shuffle whatever the data size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardload import DEFAULT_TYPE
from shardload.functions.field_values import named_values
from shardload.functions.json_members import members

# System fields present in every document, in the order they are
# added before the user fields.
SYSTEM_FIELDS = ("_source", "_type", "_uid", "_version")
UID_SEP = "#"
DOC_VERSION = 1


# Characters the JSON writer escapes: quote, backslash and control characters.
_NEEDS_ESCAPE = r'["\\\x00-\x1f]'


def json_string(c: Column) -> Column:
    """JSON string literal of ``c``.  Text with nothing to escape is quoted
    directly; anything else goes through Spark's JSON writer."""
    arr = F.to_json(F.array(c))
    escaped = F.substr(arr, F.lit(2), F.length(arr) - F.lit(2))
    return F.when(c.rlike(_NEEDS_ESCAPE), escaped).otherwise(F.concat(F.lit('"'), c, F.lit('"')))


def _json_number(c: Column) -> Column:
    txt = c.cast("string")
    special = F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(special, F.concat(F.lit('"'), txt, F.lit('"'))).otherwise(txt)


def field_value_json(f: Column) -> Column:
    t = f["type"]
    return F.coalesce(
        F.when(t == "string", json_string(f["str"]))
        .when(t == "integer", f["i"].cast("string"))
        .when(t == "long", f["l"].cast("string"))
        .when(t == "short", f["s"].cast("string"))
        .when(t == "float", _json_number(f["f"]))
        .when(t == "double", _json_number(f["d"])),
        F.lit("null"))


DUP_POLICIES = ("keep", "last", "array")


def source_json(fields: Column | str = "fields", dup: str = "keep") -> Column:
    """``_source`` JSON object of the user fields in input order.

    ``dup='keep'`` writes a repeated name once per value (as the reference
    does); ``'last'`` keeps only the last value of a name, at the position of
    that last value; ``'array'`` writes each name once, at its first
    position, with a JSON array when it has more than one value.
    """
    if dup not in DUP_POLICIES:
        raise ValueError(f"dup must be one of {DUP_POLICIES}")
    fc = F.col(fields) if isinstance(fields, str) else fields
    if dup == "keep":
        valid = F.filter(fc, lambda x: x["name"].isNotNull())
        joined = F.array_join(F.transform(valid, lambda x: F.concat(json_string(x["name"]), F.lit(":"), field_value_json(x))), ",")
    else:
        joined = members(fc, dup == "array")
    return F.concat(F.lit("{"), joined, F.lit("}"))


def with_doc_meta(docs: DataFrame, index: str, doc_type: str = DEFAULT_TYPE) -> DataFrame:
    """``_index``, ``_type``, ``_uid`` (= type#id) and ``_version`` (= 1)."""
    return docs.withColumns({
        "_index": F.lit(index),
        "_type": F.lit(doc_type),
        "_uid": F.concat(F.lit(doc_type), F.lit(UID_SEP), F.col("_id")),
        "_version": F.lit(DOC_VERSION).cast("bigint"),
    })


def name_prefixes(name: Column) -> Column:
    """Every dotted prefix of a name, the name itself last (``a``, ``a.b``, ``a.b.c``)."""
    parts = F.split(name, "\\.", -1)
    dotted = F.transform(F.sequence(F.lit(1), F.size(parts)),
                         lambda k: F.array_join(F.slice(parts, F.lit(1), k), "."))
    return F.when(F.instr(name, ".") == 0, F.array(name)).otherwise(dotted)


def field_names(fields: Column | str = "fields") -> Column:
    """``_field_names`` — prefixes of all system and user field names,
    de-duplicated, in order of first appearance."""
    fc = F.col(fields) if isinstance(fields, str) else fields
    names = F.filter(F.transform(fc, lambda x: x["name"]), lambda n: n.isNotNull())
    system = F.array(*[F.lit(s) for s in SYSTEM_FIELDS])
    user = F.flatten(F.transform(names, name_prefixes))
    return F.array_distinct(F.concat(system, user))


def _named(fields: Column, name: str) -> Column:
    return F.filter(fields, lambda x: x["name"] == F.lit(name))


def _values_of(fields: Column, name: str, slot: str) -> Column:
    return F.transform(F.filter(fields, lambda x: (x["name"] == F.lit(name)) & x[slot].isNotNull()),
                       lambda x: x[slot])


def numeric_doc_values(fields: Column, name: str, slot: str) -> Column:
    """C4: sorted numeric doc values of one field, duplicates kept."""
    return F.array_sort(_values_of(fields, name, slot))


def string_doc_values(fields: Column, name: str) -> Column:
    """Sorted set of string doc values of one field."""
    return F.array_sort(F.array_distinct(_values_of(fields, name, "str")))


SLOT_OF_TYPE = {"integer": "i", "long": "l", "short": "s", "float": "f", "double": "d", "string": "str"}


def _batch_columns(docs: DataFrame, schema: dict[str, str], keep: list[str], how) -> DataFrame:
    """A column for each name of ``schema``, whose values are picked in the batch that has the fields; ``how`` by type."""
    from shardload.operators.fields import SPARK_TYPE
    of = {kind: [n for n, t in schema.items() if how(t) == kind] for kind in dict.fromkeys(map(how, schema.values()))}
    place = {n: f"_{kind}.v{k}" for kind, names in of.items() for k, n in enumerate(names)}
    structs = [named_values(F.col("fields"), names, [SLOT_OF_TYPE[schema[n]] for n in names],
                            [SPARK_TYPE.get(schema[n], "string") for n in names], kind).alias(f"_{kind}") for kind, names in of.items()]
    return docs.select(*[F.col(c).alias(f"_keep{k}") for k, c in enumerate(keep)], *structs).select(
        *[F.col(f"_keep{k}").alias(c) for k, c in enumerate(keep)], *[F.col(place[n]).alias(n) for n in schema])


def doc_values(docs: DataFrame, schema: dict[str, str], keep=("_id",), in_batch: bool = False) -> DataFrame:
    """One ``ARRAY<T>`` column per field of ``schema`` (name → type).  ``in_batch`` as in ``parse_docs``."""
    if in_batch and schema:
        return _batch_columns(docs, schema, [c for c in keep if c in docs.columns], lambda t: "set" if t == "string" else "sorted")
    fc = F.col("fields")
    cols = []
    for name, typ in schema.items():
        slot = SLOT_OF_TYPE[typ]
        col = string_doc_values(fc, name) if slot == "str" else numeric_doc_values(fc, name, slot)
        cols.append(col.alias(name))
    return docs.select(*[c for c in keep if c in docs.columns], *cols)


def negative_zero_last_key(c: Column) -> Column:
    """Tie-break so that ``-0.0`` sorts before ``0.0`` (the sortable-bits order)."""
    return F.when((c == F.lit(0.0)) & c.cast("string").startswith("-"), F.lit(0)).otherwise(F.lit(1))


def sort_numeric(df: DataFrame, col: str, descending: bool = False, then: tuple[str, ...] = ()) -> DataFrame:
    """Order by a float/double column with the index's total order:
    ``-inf < … < -0.0 < 0.0 < … < inf < NaN``; nulls last; ``then`` breaks ties."""
    c = F.col(col)
    if descending:
        keys = [c.desc_nulls_last(), negative_zero_last_key(c).desc()]
    else:
        keys = [c.asc_nulls_last(), negative_zero_last_key(c).asc()]
    return df.orderBy(*keys, *[F.col(t) for t in then])


# The lattice of number types: within a chain the wider one; a float meets an integer
# where every digit of both is kept, else both are text.
_INTEGRAL, _REAL = ("short", "integer", "long"), ("float", "double")
#: Columns of a discovered schema at most; more raise, none is left out.
MAX_COLUMNS = 2000


def join_types(types) -> str:
    """The least type that holds every value of the given ones exactly (``string`` holds all)."""
    types = set(types)
    whole, real = (max((chain.index(t) for t in types if t in chain), default=None) for chain in (_INTEGRAL, _REAL))
    if not types or not types <= {*_INTEGRAL, *_REAL}:
        return "string"
    if real is None:
        return _INTEGRAL[whole]
    if whole is None:
        return _REAL[real]
    if _INTEGRAL[whole] == "long":
        return "string"  # a double does not hold every long, nor a long a fraction
    return "float" if (_INTEGRAL[whole], _REAL[real]) == ("short", "float") else "double"


def discover_schema(docs: DataFrame, max_columns: int = MAX_COLUMNS, in_batch: bool = False) -> dict[str, str]:
    """C8 for C7: ``name -> type`` of the dynamic fields in order of name, one pass over the documents.

    Tags are not columns: a name that begins with the tag prefix and is an integer wherever it occurs is one
    (bare tokens make unboundedly many).  A name with several declared types gets their join."""
    from shardload.operators.fields import TAG_PREFIX, infer_fields
    types = infer_fields(docs, in_batch).groupBy("name").agg(F.collect_set("type").alias("types"))  # at most six a name
    tag = F.col("name").startswith(TAG_PREFIX) & (F.size("types") == 1) & F.array_contains("types", "integer")
    found = types.where(~tag).limit(max_columns + 1).collect()
    if len(found) > max_columns:
        raise ValueError(f"more than {max_columns} field names; give a schema")
    return {r["name"]: join_types(r["types"]) for r in sorted(found, key=lambda r: r["name"])}


def _as_type(x: Column, typ: str) -> Column:
    """The value of a field as ``typ``, one that holds its own type."""
    from shardload.operators.fields import SPARK_TYPE, value_string
    if typ == "string":
        return value_string(x)
    down = {t for t in (*_INTEGRAL, *_REAL) if join_types((t, typ)) == typ}
    return F.coalesce(*[x[SLOT_OF_TYPE[t]].cast(SPARK_TYPE[typ]) for t in sorted(down)])


def column_names(names, keep=()) -> dict[str, str]:
    """``name -> column``.  Spark's column names ignore case; a name that meets a kept column or an earlier name gets
    a number behind it."""
    taken, out = {k.lower() for k in keep}, {}
    for name in names:
        column, n = name, 2
        while column.lower() in taken:
            column, n = f"{name}__{n}", n + 1
        taken.add(column.lower())
        out[name] = column
    return out


def to_wide(docs: DataFrame, schema: dict[str, str] | None = None, multi: str = "first",
            keep=("_id",), max_columns: int = MAX_COLUMNS, in_batch: bool = False) -> DataFrame:
    """Typed wide columns from the dynamic fields.

    ``multi='first'`` keeps the first value in input order, ``'array'`` all values in input order.  With a
    ``schema`` a column takes the values declared with its type.  Without one the schema is discovered
    (``discover_schema``) and a column takes every value of its name, widened to the joined type; a bad value is null.
    ``in_batch``, with a schema, as in ``parse_docs``."""
    fc, cols = F.col("fields"), []
    keep = [c for c in keep if c in docs.columns]
    if in_batch and schema:
        return _batch_columns(docs, schema, keep, lambda t: "first" if multi == "first" else "all")
    discovered = schema is None
    if discovered:
        schema = discover_schema(docs, max_columns)
    columns = column_names(schema, keep) if discovered else {n: n for n in schema}
    for name, typ in schema.items():
        if discovered:
            vals = F.filter(F.transform(_named(fc, name), lambda x: _as_type(x, typ)), lambda v: v.isNotNull())
        else:
            vals = _values_of(fc, name, SLOT_OF_TYPE[typ])
        cols.append((F.get(vals, 0) if multi == "first" else vals).alias(columns[name]))
    return docs.select(*keep, *cols)


def all_text(fields: Column | str = "fields") -> Column:
    """``_all`` catch-all text: the value text of every field, space-joined."""
    fc = F.col(fields) if isinstance(fields, str) else fields
    return F.array_join(F.transform(fc, lambda x: x["raw"]), " ")


def assemble(docs: DataFrame, index: str, doc_type: str = DEFAULT_TYPE,
             with_all: bool = False, dup: str = "keep") -> DataFrame:
    """Full document row: meta, ``_source`` (``dup`` policy for repeated
    names), ``_field_names`` (and ``_all``)."""
    out = with_doc_meta(docs, index, doc_type).withColumns({
        "_source": source_json("fields", dup),
        "_field_names": field_names("fields"),
    })
    if with_all:
        out = out.withColumn("_all", all_text("fields"))
    return out
