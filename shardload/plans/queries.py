"""Registered queries: one per operator of the inventory.

Each takes ``(spark, sf_dir)``, reads the driver tables (through the line
encoders of ``shardload.sources.tables``) and returns a DataFrame whose
columns are named exactly as in the matching oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from shardload.operators.docs import (all_text, discover_schema, doc_values, field_names, sort_numeric, source_json,
                                      to_wide, with_doc_meta)
from shardload.operators.audit import index_readiness, shard_readiness, transfer_acceptance
from shardload.operators.fields import fields_long, infer_fields, parse_meta_fields, rejects
from shardload.operators.postings import numeric_terms, postings, term_counts, tokenize, tokens_of
from shardload.operators.predicates import exists_, exists_in_build, fuzzy, get_by_id, match_term, range_, term
from shardload.operators.routing import by_shard, order_shard, route, route_hash, shard_histogram, shard_skew
from shardload.operators.stats import duplicate_ids, field_stats, manifest, merge_field_states, merge_term_states
from shardload.plans.build import numeric_value, parsed_docs, placed_lines, shard_docs
from shardload.plans.files import documents_by_id, verify_build
from shardload.plans.search import Range, Term, around, search
from shardload.plans.publish import (bulk_lines, publish, read_current, read_current_part, verify_publish,
                                     write_sharded)
from shardload.session import scratch_path
from shardload.streaming.ingest import ingest_stream
from shardload.streaming.publish import apply_batch, publish_stream, snapshot
from shardload.sources.lines import dropped_lines, keyed_lines, parse_with_schema, read_lines, with_doc_key
from shardload.sources.tables import (CUSTOMER_META, TAB, customer_lines, docmeta_lines, documents_docs,
                                      events_lines, lineitem_lines, mixed_lines, orders_lines, part_lines, shard_state,
                                      special_lines, table, text_lines, transfer_log)

SHARDS = 5
SPACE = " "
POS_MASK = (1 << 33) - 1

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- A: sources --------------------------------------------------------------

@query
def q_scan_lines(spark, sf):
    """A1: the document texts written as text files, scanned line by line."""
    path = scratch_path(spark, "text")
    table(spark, sf, "documents").select(F.col("text").alias("value")).write.text(path)
    return read_lines(spark, path).select("value")


@query
def q_keyed_lines(spark, sf):
    """A2: id and payload of each order line."""
    return keyed_lines(orders_lines(spark, sf)).select("_id", "payload")


@query
def q_dropped_lines(spark, sf):
    """A2: text lines with fewer than two space-separated cells."""
    return dropped_lines(text_lines(spark, sf), delim=SPACE).select("value")


@query
def q_custom_delim(spark, sf):
    """A4: text lines split on a space; field count per (name, type)."""
    docs = parsed_docs(text_lines(spark, sf), delim=SPACE, shards=SHARDS, on_error="reject")
    return (fields_long(docs, keep=()).groupBy("name", "type")
            .agg(F.count(F.lit(1)).alias("n")))


# --- B: field parsing --------------------------------------------------------

@query
def q_fields_long(spark, sf):
    """B1: one row per field of each line item."""
    docs = parsed_docs(lineitem_lines(spark, sf), shards=SHARDS, in_batch=True)
    return fields_long(docs, members=("pos", "name", "type", "i", "l", "s", "f", "d", "str")).select(
        "_id", "pos", "name", "type", numeric_value().alias("num"), F.col("str"))


@query
def q_tags(spark, sf):
    """B2: bare tokens become ``col_<token>`` = 1."""
    docs = parsed_docs(part_lines(spark, sf), shards=SHARDS)
    return (fields_long(docs, keep=()).where(F.col("name").startswith("col_"))
            .groupBy("name", "type").agg(F.count(F.lit(1)).alias("n"), F.sum("i").alias("sum_value")))


@query
def q_string_fields(spark, sf):
    """``name:value`` string fields of the event lines."""
    docs = parsed_docs(events_lines(spark, sf), shards=SHARDS)
    return (fields_long(docs, keep=()).where(F.col("type") == "string")
            .groupBy("name", F.col("str").alias("value")).agg(F.count(F.lit(1)).alias("n")))


@query
def q_typed_fields(spark, sf):
    """Typed values (any case of type name) per field."""
    docs = parsed_docs(lineitem_lines(spark, sf), shards=SHARDS)
    v = numeric_value()
    return (fields_long(docs, keep=()).where(F.col("type") != "string")
            .groupBy("name", "type")
            .agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("min_v"), F.max(v).alias("max_v")))


@query
def q_unknown_type(spark, sf):
    """B4f: a declared type that is not a number type gives a string."""
    docs = parsed_docs(lineitem_lines(spark, sf), shards=SHARDS, in_batch=True)
    return (fields_long(docs, keep=(), members=("name", "type", "str")).where(F.col("name") == "status")
            .groupBy("name", "type", F.col("str").alias("value")).agg(F.count(F.lit(1)).alias("n")))


@query
def q_rejects(spark, sf):
    """Bad number values (``chars`` overflows a short)."""
    return rejects(keyed_lines(docmeta_lines(spark, sf))).select("_id", "pos", "token", "reason")


# --- F: routing --------------------------------------------------------------

@query
def q_route(spark, sf):
    """hash and shard of each order id."""
    keyed = keyed_lines(orders_lines(spark, sf))
    return route_hash(keyed).select("_id", "hash",
                                    F.pmod(F.col("hash"), F.lit(SHARDS)).cast("int").alias("shard_id"))


@query
def q_shard_hist(spark, sf):
    """Minimum slice: orders → lines → parse → route → per shard/field stats."""
    docs = parsed_docs(orders_lines(spark, sf), shards=SHARDS)
    v = numeric_value()
    return (fields_long(docs, keep=("shard_id",)).groupBy("shard_id", "name", "type")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.min(v).alias("min_num"), F.max(v).alias("max_num"),
                 F.min("str").alias("min_str"), F.max("str").alias("max_str")))


# --- A3/A5/B7: ids, external schema, empty documents ---------------------------

@query
def q_auto_id(spark, sf):
    """A3: auto-id mode over the text lines: every kept line gets a unique
    22-character id."""
    keyed = keyed_lines(text_lines(spark, sf), delim=SPACE, auto_id=True)
    return keyed.agg(F.count(F.lit(1)).alias("n_docs"),
                     F.count_distinct("_id").alias("n_ids"),
                     F.min(F.length("_id")).alias("min_len"),
                     F.max(F.length("_id")).alias("max_len"))


@query
def q_meta_schema(spark, sf):
    """A5: positional customer cells typed by an external ``name:type`` list."""
    keyed = keyed_lines(customer_lines(spark, sf))
    return parse_with_schema(keyed, CUSTOMER_META).select("_id", "name", "nation", "acctbal", "segment", "_bad")


@query
def q_empty_docs(spark, sf):
    """Documents are kept even with no user field; per fixture, documents
    and documents without fields (long form with ``explode_outer``)."""
    docs = parsed_docs(text_lines(spark, sf), delim=SPACE, shards=SHARDS, on_error="reject")
    return docs.agg(F.count(F.lit(1)).alias("n_docs"),
                    F.count(F.when(F.size("fields") == 0, 1)).alias("n_empty"),
                    F.sum(F.greatest(F.size("fields"), F.lit(1))).alias("n_outer_rows"))


# --- C: document assembly ----------------------------------------------------

@query
def q_source_json(spark, sf):
    """``_source`` of each event document (escaped strings, input order)."""
    docs = parsed_docs(events_lines(spark, sf), shards=SHARDS)
    return docs.select("_id", source_json("fields").alias("_source"))


@query
def q_doc_meta(spark, sf):
    """Index, type, uid and version of each part document."""
    docs = with_doc_meta(parsed_docs(part_lines(spark, sf), shards=SHARDS), "parts", "part")
    return docs.select("_index", "_type", "_id", "_uid", "_version")


@query
def q_field_names(spark, sf):
    """Documents per ``_field_names`` entry (dotted prefixes included)."""
    docs = parsed_docs(text_lines(spark, sf), delim=SPACE, shards=SHARDS, on_error="reject")
    return (docs.select(F.explode(field_names("fields")).alias("field"))
            .groupBy("field").agg(F.count(F.lit(1)).alias("n_docs")))


def _join_values(arr):
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), ",")


@query
def q_docvalues_num(spark, sf):
    """C4: numeric doc values of ``num`` (sorted, duplicates kept)."""
    docs = parsed_docs(lineitem_lines(spark, sf), shards=SHARDS, in_batch=True)
    dv = doc_values(docs, {"num": "integer"}, keep=("_id",), in_batch=True)
    return dv.select("_id", _join_values(F.col("num")).alias("num_values"), F.size("num").alias("n_values"))


@query
def q_docvalues_str(spark, sf):
    """String doc values of ``code`` (sorted set)."""
    docs = parsed_docs(lineitem_lines(spark, sf), shards=SHARDS, in_batch=True)
    dv = doc_values(docs, {"code": "string"}, keep=("_id",), in_batch=True)
    return dv.select("_id", F.array_join("code", ",").alias("code_values"), F.size("code").alias("n_values"))


def _ranked(df: DataFrame, name: str) -> DataFrame:
    """``rank`` (from 1) of every row of a sorted frame: positions inside the
    written partitions plus the rows of the partitions before (one count each)."""
    path = scratch_path(df.sparkSession, name)
    at = F.monotonically_increasing_id()
    df.withColumn("_p", F.shiftright(at, 33)).withColumn("_i", at.bitwiseAND(F.lit(POS_MASK))).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    before = F.sum("n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    parts = rows.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).select("_p", F.coalesce(before, F.lit(0)).alias("_b"))
    return rows.join(parts, "_p").withColumn("rank", F.col("_b") + F.col("_i") + 1).drop("_p", "_i", "_b")


@query
def q_sort_double(spark, sf):
    """The orders by ``total`` (descending, index order for doubles), with NaN, both infinities and both
    zeros among the values; documents with a bad value are rejected (``q_sort_double_all`` keeps them)."""
    docs = parsed_docs(special_lines(spark, sf), shards=SHARDS, on_error="reject")
    wide = to_wide(docs, {"total": "double"})
    ranked = _ranked(sort_numeric(wide, "total", descending=True, then=("_id",)), "sorted")
    return ranked.select("_id", F.col("total").cast("string").alias("total"), "rank")


@query
def q_sort_double_all(spark, sf):
    """All orders by ``total`` as in ``q_sort_double``; the nulls of rejected values come last."""
    docs = parsed_docs(special_lines(spark, sf), shards=SHARDS, on_error="null")
    wide = to_wide(docs, {"total": "double"})
    ranked = _ranked(sort_numeric(wide, "total", descending=True, then=("_id",)), "sorted-all")
    return ranked.select("_id", F.col("total").cast("string").alias("total"), "rank")


@query
def q_bad_numbers(spark, sf):
    """Spellings of NaN and infinity that are not Java's are rejects."""
    return rejects(keyed_lines(special_lines(spark, sf))).select("_id", "token", "reason")


@query
def q_wide(spark, sf):
    """Typed wide table of the line items."""
    docs = parsed_docs(lineitem_lines(spark, sf), shards=SHARDS, in_batch=True)
    return to_wide(docs, {"qty": "double", "line": "integer", "part": "long", "disc": "float",
                          "ship": "short", "flag": "string", "code": "string"}, in_batch=True)


@query
def q_infer_schema(spark, sf):
    """Names, declared types, documents and values of the line items."""
    return infer_fields(parsed_docs(lineitem_lines(spark, sf), shards=SHARDS, in_batch=True), in_batch=True)


@query
def q_all_text(spark, sf):
    """``_all`` catch-all text of each part document."""
    docs = parsed_docs(part_lines(spark, sf), shards=SHARDS)
    return docs.select("_id", all_text("fields").alias("_all"))


# --- D: inverted index -------------------------------------------------------

def _doc_tokens(spark, sf):
    return tokenize(documents_docs(spark, sf, SHARDS), "text")


@query
def q_tokens(spark, sf):
    """Tokens and distinct terms per document text."""
    d = documents_docs(spark, sf, SHARDS)
    t = tokens_of(F.col("text"))
    return d.select("_id", F.size(t).alias("n_tokens"), F.size(F.array_distinct(t)).alias("n_terms"))


@query
def q_postings(spark, sf):
    """Postings (term, shard, document) with frequency and positions."""
    p = postings(_doc_tokens(spark, sf))
    return p.select("field", "term", "shard_id", "_id", "tf",
                    F.array_join(F.transform("positions", lambda x: x.cast("string")), ",").alias("positions"))


@query
def q_term_stats(spark, sf):
    """D3: document frequency and total term frequency per term."""
    return term_counts(with_doc_key(table(spark, sf, "documents").select("text"), spread=True), "text")


@query
def q_num_terms(spark, sf):
    """Exact numeric terms of the part documents."""
    return numeric_terms(parsed_docs(part_lines(spark, sf), shards=SHARDS))


@query
def q_num_terms_exact(spark, sf):
    """Longs above 2^53, NaN, infinities and both zeros stay terms of their own."""
    docs = parsed_docs(special_lines(spark, sf), shards=SHARDS, on_error="reject")
    return numeric_terms(docs).withColumn("real", F.col("real").cast("string"))


@query
def q_num_postings(spark, sf):
    """D4 in a published build: documents of the numeric terms of ``size`` and ``col_…``."""
    docs = shard_docs(part_lines(spark, sf), "parts", "part", shards=SHARDS)
    root = scratch_path(spark, "publish_numeric")
    publish(docs, root, shards=SHARDS, with_postings=True)
    terms = read_current_part(spark, root, "numeric_terms")
    return terms.where(F.col("whole").isNotNull()).select("field", "type", "whole", "shard_id", "_id", "tf")


# --- E: predicates -----------------------------------------------------------

@query
def q_term_float(spark, sf):
    """Float term (compared as 32-bit float)."""
    docs = parsed_docs(part_lines(spark, sf), shards=SHARDS)
    return docs.where(term("price", 901.0, "float")).select("_id")


@query
def q_term_short(spark, sf):
    """Short term."""
    docs = parsed_docs(part_lines(spark, sf), shards=SHARDS)
    return docs.where(term("size", 11, "short")).select("_id")


@query
def q_range(spark, sf):
    """Ship day in [9500, 9600) and quantity above 45 (open upper bound)."""
    docs = parsed_docs(lineitem_lines(spark, sf), shards=SHARDS)
    return (docs.where(range_("ship", "short", 9500, 9600, include_lo=True, include_hi=False)
                       & range_("qty", "double", lo=45, include_lo=False))
            .select("_id"))


@query
def q_fuzzy(spark, sf):
    """Price within 1000 ± 50 (float math) and size within 20 ± 3 (int math)."""
    docs = parsed_docs(part_lines(spark, sf), shards=SHARDS)
    return docs.where(fuzzy("price", 1000.0, 50.0, "float") & fuzzy("size", 20, 3, "short")).select("_id")


@query
def q_exists(spark, sf):
    """Text documents that have the field ``col_the`` (or a dotted child)."""
    docs = parsed_docs(text_lines(spark, sf), delim=SPACE, shards=SHARDS, on_error="reject")
    return docs.where(exists_("col_the")).select("_id", F.size("fields").alias("n_fields"))


@query
def q_match_term(spark, sf):
    """E5: documents whose text holds the term ``the`` (postings semi-join)."""
    d = documents_docs(spark, sf, SHARDS)
    p = postings(tokenize(d, "text"))
    return match_term(d, p, "text", "the").select("_id", "lang")


@query
def q_get_by_id(spark, sf):
    """One order document of a published build by id; only its shard's
    folder is read."""
    root = scratch_path(spark, "publish_get")
    publish(shard_docs(orders_lines(spark, sf), "orders", "order", shards=SHARDS), root, shards=SHARDS)
    return get_by_id(read_current(spark, root), "42", SHARDS).select("_id", "shard_id", F.size("fields").alias("n_fields"))


@query
def q_match_published(spark, sf):
    """E4/E5 on a published build: documents whose ``type`` holds a term, from
    the stored postings, and that have the field ``brand``."""
    root = scratch_path(spark, "publish_match")
    publish(shard_docs(part_lines(spark, sf), "parts", "part", shards=SHARDS, split=2), root, shards=SHARDS, split=2,
            with_postings=True)
    docs = read_current(spark, root).where(exists_in_build("brand"))
    return match_term(docs, read_current_part(spark, root, "postings"), "type", "economy").select("_id", "shard_id")


# --- G: statistics -----------------------------------------------------------

@query
def q_field_stats(spark, sf):
    """G1: field statistics of the line items."""
    return field_stats(parsed_docs(lineitem_lines(spark, sf), shards=SHARDS))


@query
def q_field_stats_exact(spark, sf):
    """G1 over longs above 2^53 and special doubles: nothing is rounded."""
    docs = parsed_docs(special_lines(spark, sf), shards=SHARDS, on_error="reject")
    return field_stats(docs).withColumns({c: F.col(c).cast("string") for c in ("min_d", "max_d")})


@query
def q_duplicate_ids(spark, sf):
    """Event documents sharing an id (user)."""
    return duplicate_ids(parsed_docs(events_lines(spark, sf), shards=SHARDS))


@query
def q_manifest(spark, sf):
    """Per-shard manifest of the order documents."""
    return manifest(parsed_docs(orders_lines(spark, sf), shards=SHARDS), "b1")


# --- F: placement ------------------------------------------------------------

@query
def q_shard_order(spark, sf):
    """rank of each order document inside its shard partition after
    placement and the descending id sort."""
    docs = order_shard(by_shard(parsed_docs(orders_lines(spark, sf), shards=SHARDS), SHARDS))
    pos = F.monotonically_increasing_id().bitwiseAND(F.lit(POS_MASK))
    return docs.select("shard_id", "_id", (pos + 1).cast("int").alias("rank"))


@query
def q_split_order(spark, sf):
    """F3 on written files: with three ranges per shard, the rank of each order
    document over a shard's files, taken in file order."""
    docs = shard_docs(orders_lines(spark, sf), "orders", "order", shards=SHARDS, split=3)
    path = scratch_path(spark, "split_order")
    write_sharded(docs, path)
    rows = spark.read.parquet(path).select("shard_id", "_id", F.col("_metadata.file_name").alias("f"),
                                           F.col("_metadata.row_index").alias("r"))
    # the rows of the files before (one row a file), plus the place in the file
    before = F.sum("n").over(Window.partitionBy("shard_id").orderBy("f").rowsBetween(Window.unboundedPreceding, -1))
    files = rows.groupBy("shard_id", "f").agg(F.count(F.lit(1)).alias("n")).select("shard_id", "f", F.coalesce(before, F.lit(0)).alias("b"))
    return rows.join(files, ["shard_id", "f"]).select("shard_id", "_id", (F.col("b") + F.col("r") + 1).cast("int").alias("rank"))


@query
def q_shard_skew(spark, sf):
    """shard size spread of the line-item documents, from the routed lines."""
    return shard_skew(route(keyed_lines(lineitem_lines(spark, sf)), SHARDS))


# --- H: publish and audits ---------------------------------------------------

@query
def q_write_readback(spark, sf):
    """H1: write the order documents sharded, read them back per shard."""
    docs = shard_docs(orders_lines(spark, sf), "orders", "order", shards=SHARDS)
    path = scratch_path(spark, "write_readback")
    write_sharded(docs, path)
    back = spark.read.parquet(path)
    return back.groupBy("shard_id").agg(F.count(F.lit(1)).alias("n_docs"),
                                        F.min("_id").alias("min_id"), F.max("_id").alias("max_id"))


@query
def q_verify_publish(spark, sf):
    """H3/H4: publish the order documents, then compare the input's lines per
    shard with the files."""
    lines = orders_lines(spark, sf)
    root = scratch_path(spark, "publish")
    publish(shard_docs(lines, "orders", "order", shards=SHARDS), root, shards=SHARDS)
    expected = shard_histogram(route(keyed_lines(lines), SHARDS))
    return verify_publish(expected, read_current(spark, root))


@query
def q_publish_rejects(spark, sf):
    """A published build in reject mode loses no document: kept and
    rejected ones per shard, from the manifest and from the stored rejects."""
    docs = shard_docs(docmeta_lines(spark, sf), "docs", "doc", shards=SHARDS, on_error="reject")
    root = scratch_path(spark, "publish_rejects")
    publish(docs, root, shards=SHARDS)
    found = read_current_part(spark, root, "rejects").groupBy(F.col("shard_id").cast("int").alias("shard_id")).agg(
        F.count_distinct("_doc").alias("found"), F.min("reason").alias("reason"))
    kept_rows = read_current_part(spark, root, "manifest").select(
        F.col("shard_id").cast("int").alias("shard_id"), "n_docs", "n_rejected")
    return kept_rows.join(found, "shard_id", "left").select(
        "shard_id", "n_docs", "n_rejected", F.coalesce("found", F.lit(0)).cast("long").alias("found"), "reason")


@query
def q_meta_import(spark, sf):
    """A5 as an import: customer cells typed by a metadata list whose second
    number type does not fit; kept and rejected values per field."""
    docs = parse_meta_fields(route(keyed_lines(customer_lines(spark, sf)), SHARDS),
                             "name:string,nation:short,acctbal:integer,segment:text", on_error="null")
    return (fields_long(docs, keep=()).groupBy("name", "type")
            .agg(F.count(F.lit(1)).alias("n"), F.count("error").alias("n_bad"), F.sum("s").alias("sum_short"),
                 F.count("str").alias("n_str")))


@query
def q_bulk_lines(spark, sf):
    """H7: bulk request body (action + source) of each order document."""
    docs = parsed_docs(orders_lines(spark, sf), shards=SHARDS)
    return bulk_lines(docs, "orders", "order")


@query
def q_transfer_acceptance(spark, sf):
    """H5: accept rule per build and shard over the delivery log."""
    return transfer_acceptance(transfer_log(spark, sf))


@query
def q_shard_readiness(spark, sf):
    """Readiness and active replica hosts per snapshot and shard."""
    return shard_readiness(shard_state(spark, sf))


@query
def q_index_readiness(spark, sf):
    """H6: an index snapshot is ready when every shard is."""
    return index_readiness(shard_state(spark, sf))


@query
def q_stream_ingest(spark, sf):
    """Order lines in two text files, ingested by the streaming job in two
    batches, then counted per shard; every document has a key of its own."""
    base = scratch_path(spark, "stream")
    orders_lines(spark, sf).select("value").repartition(2).write.text(f"{base}/src")
    q = ingest_stream(spark, f"{base}/src", f"{base}/out", f"{base}/ck", index="orders", doc_type="order",
                      shards=SHARDS, max_files_per_trigger=1)
    q.awaitTermination()
    back = spark.read.parquet(f"{base}/out")
    return back.groupBy("shard_id").agg(F.count(F.lit(1)).alias("n_docs"),
                                        F.min("_id").alias("min_id"), F.max("_id").alias("max_id"),
                                        F.count_distinct("_doc").alias("n_keys"),
                                        F.count_distinct("batch_id").alias("n_batches"))


@query
def q_published_postings(spark, sf):
    """D2 per shard in a published build: term statistics read back from the
    build's inverted index of the order documents."""
    docs = shard_docs(orders_lines(spark, sf), "orders", "order", shards=SHARDS)
    root = scratch_path(spark, "publish_index")
    publish(docs, root, shards=SHARDS, with_postings=True)
    post = read_current_part(spark, root, "postings")
    return post.groupBy("field", "term", "shard_id").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf"))


@query
def q_published_doc_values(spark, sf):
    """C4 per shard in a published build: ``total`` and ``cust`` doc values
    read back from the build's doc-value columns."""
    docs = shard_docs(orders_lines(spark, sf), "orders", "order", shards=SHARDS)
    root = scratch_path(spark, "publish_dv")
    publish(docs, root, shards=SHARDS, doc_value_schema={"total": "double", "cust": "long"})
    dv = read_current_part(spark, root, "doc_values")
    return dv.groupBy("shard_id").agg(F.count(F.lit(1)).alias("n_docs"),
                                      F.min(F.element_at("total", 1)).alias("min_total"),
                                      F.max(F.element_at("total", -1)).alias("max_total"),
                                      F.sum(F.size("cust")).alias("n_cust"))


@query
def q_source_dup(spark, sf):
    """C1 policies for repeated names (``code`` ×3, ``num`` ×2 per line item):
    last value wins, and values collected into JSON arrays."""
    docs = parsed_docs(lineitem_lines(spark, sf), shards=SHARDS)
    return docs.select("_id", source_json("fields", "last").alias("src_last"),
                       source_json("fields", "array").alias("src_array"))


@query
def q_range_wide(spark, sf):
    """E2 on a written wide table: the same range as ``q_range`` on scalar
    columns, so the bounds reach the Parquet scan as pushed filters."""
    docs = parsed_docs(lineitem_lines(spark, sf), shards=SHARDS, in_batch=True)
    path = scratch_path(spark, "wide")
    to_wide(docs, {"ship": "short", "qty": "double"}, in_batch=True).write.parquet(path)
    wide = spark.read.parquet(path)
    return (wide.where(range_("ship", "short", 9500, 9600, include_lo=True, include_hi=False, wide=True)
                       & range_("qty", "double", lo=45, include_lo=False, wide=True))
            .select("_id"))


# --- lookups, search and verification on published builds ----------------------

def _published_orders(spark, sf, name, **options):
    root = scratch_path(spark, name)
    publish(shard_docs(orders_lines(spark, sf), "orders", "order", shards=SHARDS, split=3), root, shards=SHARDS, split=3, **options)
    return root


@query
def q_lookup_ids(spark, sf):
    """E6 with data skipping: order documents by a list of ids; only the files whose
    shard and id range fit are opened."""
    root = _published_orders(spark, sf, "publish_lookup")
    return documents_by_id(spark, root, ["42", "777", "14999", "42", "none such"]).select(
        "_id", "shard_id", F.size("fields").alias("n_fields"))


@query
def q_lookup_join(spark, sf):
    """E6 for a table of ids: the order documents whose id is a customer's key."""
    root = _published_orders(spark, sf, "publish_lookup_join")
    ids = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("_id"))
    return documents_by_id(spark, root, ids).select("_id", "shard_id", F.size("fields").alias("n_fields"))


@query
def q_search(spark, sf):
    """E5 with E2 and E3 on a published build: ``type`` holds a term, ``size`` lies in [10, 30)
    and ``price`` within 1000 ± 150."""
    root = scratch_path(spark, "publish_search")
    publish(shard_docs(part_lines(spark, sf), "parts", "part", shards=SHARDS, split=2), root, shards=SHARDS, split=2,
            with_postings=True)
    return search(spark, root, Term("type", "economy"), Range("size", "short", 10, 30, include_hi=False),
                  around("price", 1000.0, 150.0, "float")).select("_id", "shard_id")


@query
def q_search_common(spark, sf):
    """E5 with E2: a term that about half of all orders hold, and open and exclusive ranges."""
    root = _published_orders(spark, sf, "publish_search_common", with_postings=True)
    return search(spark, root, Term("status", "o"), Range("total", "double", 200000.0, include_lo=False),
                  Range("day", "integer", None, 9800)).select("_id", "shard_id")


@query
def q_build_files(spark, sf):
    """H4: the files of a build, added up per shard, and how many of them are not as they were written."""
    root = _published_orders(spark, sf, "publish_files")
    faults = verify_build(spark, root).groupBy("shard_id").agg(F.count(F.lit(1)).alias("n_faults"))
    sums = read_current_part(spark, root, "files").groupBy("shard_id").agg(
        F.sum("n_rows").alias("n_docs"), F.min("min_id").alias("min_id"), F.max("max_id").alias("max_id"))
    return sums.join(faults, "shard_id", "left").select("shard_id", "n_docs", "min_id", "max_id",
                                                        F.coalesce("n_faults", F.lit(0)).cast("long").alias("n_faults"))


@query
def q_stream_publish(spark, sf):
    """Order lines in two files, two batches that go live one after the other and are merged
    into one run; then the whole stream again from the start, which changes nothing."""
    base = scratch_path(spark, "stream_publish")
    orders_lines(spark, sf).select("value").repartition(2).write.text(f"{base}/src")
    for replay in range(2):
        publish_stream(spark, f"{base}/src", f"{base}/root", f"{base}/ck{replay}", index="orders", doc_type="order", shards=SHARDS,
                       merge_at=2, max_files_per_trigger=1).awaitTermination()
    state = snapshot(spark, f"{base}/root")
    return read_current(spark, f"{base}/root").groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min("_id").alias("min_id"), F.max("_id").alias("max_id"),
        F.count_distinct("_doc").alias("n_keys"), F.lit(len(state["epochs"])).cast("long").alias("n_epochs"))


@query
def q_wide_discovered(spark, sf):
    """C7 without a schema (uses C8): names with conflicting declared types get the join of these, tags
    are no columns, and a name that differs in case only is a column of its own."""
    return to_wide(parsed_docs(mixed_lines(spark, sf), shards=SHARDS))


@query
def q_discover_schema(spark, sf):
    """C8 resolved: the joined type of every name that is a column, with its values and declared types."""
    docs = parsed_docs(mixed_lines(spark, sf), shards=SHARDS, in_batch=True)
    joined = F.create_map(*[F.lit(x) for pair in discover_schema(docs, in_batch=True).items() for x in pair])
    return (infer_fields(docs, in_batch=True).withColumn("joined", F.try_element_at(joined, "name")).where("joined IS NOT NULL")
            .groupBy("name", "joined").agg(F.count(F.lit(1)).alias("n_types"), F.sum("n_values").alias("n_values")))


@query
def q_word_terms(spark, sf):
    """D1/D3 by Unicode word breaking: document frequency and total frequency of the words of all texts."""
    docs = with_doc_key(table(spark, sf, "documents").select("text"), spread=True)
    return term_counts(docs, "text", analyzer="standard").select("term", "df", "ttf")


def _two_batches(spark, sf, name, **side):
    """The order lines published as two batches, odd and even keys."""
    lines, root = orders_lines(spark, sf).select("value"), scratch_path(spark, name)
    odd = F.substring_index("value", "\t", 1).cast("long") % 2 == 1
    for epoch, part in enumerate((odd, ~odd)):
        apply_batch(lines.where(part), root, epoch, "orders", "order", shards=SHARDS, with_stats=True, **side)
    return root


@query
def q_stored_field_stats(spark, sf):
    """G1 kept with the build: states of the shards of two batches, merged without a look at the documents."""
    return merge_field_states(read_current_part(spark, _two_batches(spark, sf, "stored_stats"), "field_stats"))


@query
def q_stored_term_stats(spark, sf):
    """D3 kept with the build: the terms of shards 1 and 3, merged over two batches."""
    root = _two_batches(spark, sf, "stored_terms", with_postings=True)
    return merge_term_states(read_current_part(spark, root, "term_stats"), [1, 3])


@query
def q_placed_by_bytes(spark, sf):
    """F2 by weight with F3: the texts as lines of very different lengths, in ranges of about 64 KB; the rank of each
    document over its shard's ranges, and the shard's share of all bytes."""
    docs = table(spark, sf, "documents").select(F.concat_ws(TAB, F.col("doc_id").cast("string"), F.regexp_replace("text", TAB, " ")).alias("value"))
    placed = placed_lines(keyed_lines(with_doc_key(docs, spread=True)), SHARDS, range_bytes=64 << 10)
    path, at = scratch_path(spark, "placed"), F.monotonically_increasing_id()
    placed.select("shard_id", "_id", F.octet_length("payload").cast("long").alias("bytes"), F.shiftright(at, 33).alias("_p"),
                  at.bitwiseAND(F.lit(POS_MASK)).alias("_i")).write.parquet(path)
    rows = spark.read.parquet(path)
    # a partition holds one range of one shard; a row for each of them
    before = F.sum("n").over(Window.partitionBy("shard_id").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    parts = rows.groupBy("shard_id", "_p").agg(F.count(F.lit(1)).alias("n")).select("shard_id", "_p", F.coalesce(before, F.lit(0)).alias("_b"))
    return rows.join(parts, ["shard_id", "_p"]).select("shard_id", "_id", "bytes", (F.col("_b") + F.col("_i") + 1).alias("rank"))
