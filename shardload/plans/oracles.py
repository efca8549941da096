"""DuckDB oracle SQL for the registered queries.

Each statement recomputes a query's result from the original tables with
plain SQL (views ``orders``, ``lineitem``, … are registered by the checker).
Column names and types match the Spark result.
"""

from __future__ import annotations

from shardload.sources.tables import SPECIAL_DOUBLES
from shardload.plans.oracle_sql import (epoch_days_sql, epoch_seconds_sql, java_split_sql,
                                        murmur3_signed, shard_sql)

SHARDS = 5
TAB = "\t"
NUMERIC = "('integer', 'long', 'short', 'float', 'double')"

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


# --- shared SQL pieces ---------------------------------------------------------

TEXT_LINES = ("SELECT unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS value FROM documents")
# The same lines with a document key (source document, line number).
TEXT_LINES_K = ("SELECT doc_id, unnest(range(1, len(arr) + 1)) AS ln, unnest(arr) AS value "
                "FROM (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS arr FROM documents)")


def keyed_sql(lines: str, sep: str, carry: str = "") -> str:
    """Explicit-id split of ``lines(value)`` → ``(_id, payload)`` (+ ``carry`` columns)."""
    c = f"{carry}, " if carry else ""
    return f"""
    SELECT {c}split_part(s, '{sep}', 1) AS _id,
           regexp_replace(substr(s, strpos(s, '{sep}') + {len(sep)}), '^({sep})+', '') AS payload
    FROM (SELECT {c}regexp_replace(value, '({sep})+$', '') AS s FROM ({lines}))
    WHERE strpos(s, '{sep}') > 0"""


def columns_sql(payload: str, sep: str) -> str:
    """Java-split cells, then columns: ``VARCHAR[]``."""
    return (f"flatten(list_transform({java_split_sql(payload, sep)}, "
            f"lambda cell: {java_split_sql('cell', ',')}))")


def field_name_sql(p: str) -> str:
    return f"(CASE len({p}) WHEN 0 THEN NULL WHEN 1 THEN 'col_' || {p}[1] ELSE {p}[1] END)"


def field_type_sql(p: str) -> str:
    return (f"(CASE WHEN len({p}) = 1 THEN 'integer' WHEN len({p}) = 2 THEN 'string' "
            f"WHEN len({p}) >= 3 AND lower({p}[3]) IN {NUMERIC} THEN lower({p}[3]) "
            f"WHEN len({p}) >= 3 THEN 'string' END)")


def parsed_fields_sql(keyed: str, sep: str, carry: str = "") -> str:
    """``(_id, pos, name, type, str)`` of every column of ``keyed(_id, payload)``
    (string values only; numeric oracles use the table columns directly)."""
    c = f"{carry}, " if carry else ""
    return f"""
    SELECT {c}_id, pos, {field_name_sql('p')} AS name, {field_type_sql('p')} AS type,
           CASE WHEN {field_type_sql('p')} = 'string' THEN p[2] END AS str
    FROM (SELECT {c}_id, CAST(gi - 1 AS INTEGER) AS pos, {java_split_sql('cols[gi]', ':')} AS p
          FROM (SELECT {c}_id, cols, unnest(range(1, len(cols) + 1)) AS gi
                FROM (SELECT {c}_id, {columns_sql('payload', sep)} AS cols FROM ({keyed}))))"""


def orders_fields() -> str:
    """Long form of the order lines: ``(_id, shard_id, pos, name, type, num, str)``."""
    sid = "o_orderkey::VARCHAR"
    sh = shard_sql(sid, SHARDS)
    days = epoch_days_sql("o_orderdate")
    return f"""
    SELECT {sid} AS _id, {sh} AS shard_id, 0 AS pos, 'cust' AS name, 'long' AS type, o_custkey::DOUBLE AS num, NULL::VARCHAR AS str FROM orders
    UNION ALL SELECT {sid}, {sh}, 1, 'total', 'double', o_totalprice, NULL FROM orders
    UNION ALL SELECT {sid}, {sh}, 2, 'status', 'string', NULL, o_orderstatus FROM orders
    UNION ALL SELECT {sid}, {sh}, 3, 'day', 'integer', {days}::DOUBLE, NULL FROM orders
    UNION ALL SELECT {sid}, {sh}, 4, 'col_' || o_orderpriority, 'integer', 1.0, NULL FROM orders"""


LI_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey)"
# Document key of a line item: the whole row (ids alone repeat).
LI_DK = ("row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, "
         "l_tax, l_returnflag, l_linestatus, l_shipdate)")


def lineitem_fields() -> str:
    """Long form of the line-item lines: ``(_id, pos, name, type, num, str)``."""
    d = epoch_days_sql("l_shipdate")
    rows = [
        ("0", "'qty'", "'double'", "l_quantity", "NULL"),
        ("1", "'line'", "'integer'", "l_linenumber::DOUBLE", "NULL"),
        ("2", "'part'", "'long'", "l_partkey::DOUBLE", "NULL"),
        ("3", "'disc'", "'float'", "CAST(l_discount AS FLOAT)::DOUBLE", "NULL"),
        ("4", "'tax'", "'float'", "CAST(l_tax AS FLOAT)::DOUBLE", "NULL"),
        ("5", "'flag'", "'string'", "NULL", "l_returnflag"),
        ("6", "'price'", "'double'", "l_extendedprice", "NULL"),
        ("7", "'ship'", "'short'", f"{d}::DOUBLE", "NULL"),
        ("8", "'status'", "'string'", "NULL", "l_linestatus"),
        ("9", "'col_' || l_returnflag", "'integer'", "1.0", "NULL"),
        ("10", "'code'", "'string'", "NULL", "l_returnflag"),
        ("11", "'code'", "'string'", "NULL", "l_linestatus"),
        ("12", "'code'", "'string'", "NULL", "l_returnflag"),
        ("13", "'num'", "'integer'", "l_linenumber::DOUBLE", "NULL"),
        ("14", "'num'", "'integer'", "trunc(l_quantity)::DOUBLE", "NULL"),
    ]
    parts = []
    for i, (pos, name, typ, num, st) in enumerate(rows):
        if i == 0:
            parts.append(f"SELECT {LI_DK} AS dk, {LI_ID} AS _id, CAST({pos} AS INTEGER) AS pos, {name} AS name, "
                         f"{typ} AS type, CAST({num} AS DOUBLE) AS num, CAST({st} AS VARCHAR) AS str FROM lineitem")
        else:
            parts.append(f"SELECT {LI_DK}, {LI_ID}, {pos}, {name}, {typ}, {num}, {st} FROM lineitem")
    return "\nUNION ALL ".join(parts)


# --- A: sources --------------------------------------------------------------

oracle("q_scan_lines", TEXT_LINES)

oracle("q_keyed_lines", f"""
SELECT o_orderkey::VARCHAR AS _id,
       concat('cust:', o_custkey, ':long,total:', o_totalprice::VARCHAR, ':double,status:', o_orderstatus,
              ',day:', {epoch_days_sql('o_orderdate')}, ':integer', chr(9), o_orderpriority) AS payload
FROM orders""")

oracle("q_dropped_lines", f"""
SELECT value FROM ({TEXT_LINES}) WHERE strpos(regexp_replace(value, '( )+$', ''), ' ') = 0""")

oracle("q_custom_delim", f"""
SELECT name, type, count(*) AS n FROM ({parsed_fields_sql(keyed_sql(TEXT_LINES, ' '), ' ')})
GROUP BY name, type""")

# --- B: field parsing --------------------------------------------------------

oracle("q_fields_long", f"SELECT _id, pos, name, type, num, str FROM ({lineitem_fields()})")

oracle("q_tags", """
SELECT 'col_' || p_name AS name, 'integer' AS type, count(*) AS n, CAST(count(*) AS BIGINT) AS sum_value
FROM part GROUP BY p_name""")

oracle("q_string_fields", f"""
SELECT name, str AS value, count(*) AS n FROM (
  SELECT 'type' AS name, event_type AS str FROM events
  UNION ALL
  SELECT {field_name_sql('p')}, CASE WHEN {field_type_sql('p')} = 'string' THEN p[2] END
  FROM (SELECT {java_split_sql("'props:' || props", ':')} AS p FROM events)
  WHERE {field_type_sql('p')} = 'string')
GROUP BY name, str""")

oracle("q_typed_fields", f"""
SELECT name, type, count(*) AS n, min(num) AS min_v, max(num) AS max_v
FROM ({lineitem_fields()}) WHERE type <> 'string' GROUP BY name, type""")

oracle("q_unknown_type", """
SELECT 'status' AS name, 'string' AS type, l_linestatus AS value, count(*) AS n FROM lineitem GROUP BY l_linestatus""")

oracle("q_rejects", """
SELECT doc_id::VARCHAR AS _id, 2 AS pos, concat('chars:', n_chars, ':short') AS token, 'bad_short' AS reason
FROM documents WHERE n_chars > 32767 OR n_chars < -32768""")

# --- F: routing --------------------------------------------------------------

oracle("q_route", f"""
SELECT o_orderkey::VARCHAR AS _id, CAST({murmur3_signed('o_orderkey::VARCHAR')} AS INTEGER) AS hash,
       {shard_sql('o_orderkey::VARCHAR', SHARDS)} AS shard_id
FROM orders""")

oracle("q_shard_hist", f"""
SELECT shard_id, name, type, count(*) AS n, min(num) AS min_num, max(num) AS max_num,
       min(str) AS min_str, max(str) AS max_str
FROM ({orders_fields()}) GROUP BY shard_id, name, type""")


# --- A3/A5/B7 ------------------------------------------------------------------

oracle("q_auto_id", f"""
SELECT count(*) AS n_docs, count(*) AS n_ids, 22 AS min_len, 22 AS max_len
FROM ({TEXT_LINES}) WHERE value = '' OR regexp_replace(value, '( )+$', '') <> ''""")

oracle("q_meta_schema", """
SELECT c_custkey::VARCHAR AS _id, c_name AS name, c_nationkey AS nation, c_acctbal AS acctbal,
       c_mktsegment AS segment, 0 AS _bad
FROM customer""")

oracle("q_empty_docs", f"""
SELECT count(*) AS n_docs, count(*) FILTER (WHERE len(cols) = 0) AS n_empty,
       CAST(sum(greatest(len(cols), 1)) AS BIGINT) AS n_outer_rows
FROM (SELECT {columns_sql('payload', ' ')} AS cols FROM ({keyed_sql(TEXT_LINES, ' ')}))""")

# --- C: document assembly ----------------------------------------------------

oracle("q_source_json", f"""
SELECT user_id::VARCHAR AS _id,
       concat('{{"value":', value::VARCHAR, ',"type":', to_json(event_type), ',"props":',
              to_json(split_part(props, ':', 1)), ',"ts":', {epoch_seconds_sql('ts')}, ',"eid":', event_id, '}}')
         AS _source
FROM events""")

oracle("q_doc_meta", """
SELECT 'parts' AS _index, 'part' AS _type, p_partkey::VARCHAR AS _id, 'part#' || p_partkey AS _uid,
       CAST(1 AS BIGINT) AS _version
FROM part""")


def prefixes_sql(n: str) -> str:
    return (f"list_transform(range(1, len(string_split({n}, '.')) + 1), "
            f"lambda k: array_to_string(string_split({n}, '.')[1:k], '.'))")


_TEXT_KEYED = keyed_sql(TEXT_LINES_K, ' ', carry="doc_id, ln")
oracle("q_field_names", f"""
SELECT field, count(*) AS n_docs FROM (
  SELECT DISTINCT doc_id, ln, field FROM (
    SELECT doc_id, ln, unnest({prefixes_sql('name')}) AS field
    FROM ({parsed_fields_sql(_TEXT_KEYED, ' ', carry='doc_id, ln')}) WHERE name IS NOT NULL
    UNION ALL
    SELECT doc_id, ln, unnest(['_source', '_type', '_uid', '_version']) FROM ({_TEXT_KEYED})))
GROUP BY field""")

oracle("q_docvalues_num", f"""
SELECT {LI_ID} AS _id,
       array_to_string(list_sort([l_linenumber, CAST(trunc(l_quantity) AS INTEGER)]), ',') AS num_values,
       2 AS n_values
FROM lineitem""")

oracle("q_docvalues_str", f"""
SELECT {LI_ID} AS _id,
       array_to_string(list_sort(list_distinct([l_returnflag, l_linestatus, l_returnflag])), ',') AS code_values,
       CAST(len(list_distinct([l_returnflag, l_linestatus, l_returnflag])) AS INTEGER) AS n_values
FROM lineitem""")

SPECIAL = ("CASE o_orderkey % 50 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in SPECIAL_DOUBLES.items())
           + " ELSE o_totalprice::VARCHAR END")
GOOD = "o_orderkey % 50 < 45"
# Descending index order: NaN, Infinity, numbers, 0.0, -0.0, negative numbers.
oracle("q_sort_double", f"""
SELECT o_orderkey::VARCHAR AS _id, {SPECIAL} AS total,
       row_number() OVER (ORDER BY CAST({SPECIAL} AS DOUBLE) DESC, (o_orderkey % 50 = 3)::INT, o_orderkey::VARCHAR) AS rank
FROM orders WHERE {GOOD}""")

oracle("q_sort_double_all", f"""
SELECT o_orderkey::VARCHAR AS _id, total,
       row_number() OVER (ORDER BY CAST(total AS DOUBLE) DESC NULLS LAST, (o_orderkey % 50 = 3)::INT, o_orderkey::VARCHAR) AS rank
FROM (SELECT o_orderkey, CASE WHEN {GOOD} THEN {SPECIAL} END AS total FROM orders)""")

oracle("q_bad_numbers", f"""
SELECT o_orderkey::VARCHAR AS _id, concat('total:', {SPECIAL}, ':double') AS token, 'bad_double' AS reason
FROM orders WHERE NOT {GOOD}""")

oracle("q_num_terms_exact", f"""
SELECT field, type, whole, real, neg_zero, count(*) AS df, count(*) AS ttf FROM (
  SELECT 'total' AS field, 'double' AS type, NULL::BIGINT AS whole, {SPECIAL} AS real,
         ({SPECIAL}) = '-0.0' AS neg_zero FROM orders WHERE {GOOD}
  UNION ALL SELECT 'big', 'long', 9007199254740992 + o_orderkey % 7, NULL, false FROM orders WHERE {GOOD})
GROUP BY ALL""")

oracle("q_field_stats_exact", f"""
SELECT 'big' AS name, 'long' AS type, count(*) AS max_doc, count(*) AS doc_count, count(*) AS sum_doc_freq,
       count(*) AS sum_total_term_freq, min(9007199254740992 + o_orderkey % 7) AS min_l,
       max(9007199254740992 + o_orderkey % 7) AS max_l, NULL::VARCHAR AS min_d, NULL::VARCHAR AS max_d
FROM orders WHERE {GOOD}
UNION ALL
SELECT 'total', 'double', count(*), count(*), count(*), count(*), NULL, NULL, '-Infinity', 'NaN' FROM orders WHERE {GOOD}""")

oracle("q_wide", f"""
SELECT {LI_ID} AS _id, l_quantity AS qty, l_linenumber AS line, l_partkey AS part,
       CAST(l_discount AS FLOAT) AS disc, CAST({epoch_days_sql('l_shipdate')} AS SMALLINT) AS ship,
       l_returnflag AS flag, l_returnflag AS code
FROM lineitem""")

oracle("q_infer_schema", f"""
SELECT name, type, count(DISTINCT dk) AS docs, count(*) AS n_values
FROM ({lineitem_fields()}) GROUP BY name, type""")

oracle("q_all_text", """
SELECT p_partkey::VARCHAR AS _id, concat_ws(' ', p_size, p_retailprice::VARCHAR, p_brand, p_type, '1') AS _all
FROM part""")


# --- D: inverted index -------------------------------------------------------

TOKEN_RE = "[\\p{L}\\p{N}]+"
DOC_TOKENS = (f"SELECT doc_id, lang, regexp_extract_all(lower(text), '{TOKEN_RE}') AS toks FROM documents")
TOKEN_ROWS = (f"SELECT doc_id, unnest(toks) AS term, unnest(range(len(toks))) AS position FROM ({DOC_TOKENS})")
DOC_SHARD = shard_sql("doc_id::VARCHAR", SHARDS)
POSTINGS = f"""
SELECT 'text' AS field, term, {DOC_SHARD} AS shard_id, doc_id::VARCHAR AS _id, count(*) AS tf,
       array_to_string(list_sort(list(position)), ',') AS positions
FROM ({TOKEN_ROWS}) GROUP BY term, doc_id"""

oracle("q_tokens", f"""
SELECT doc_id::VARCHAR AS _id, CAST(len(toks) AS INTEGER) AS n_tokens,
       CAST(len(list_distinct(toks)) AS INTEGER) AS n_terms
FROM ({DOC_TOKENS})""")

oracle("q_postings", POSTINGS)

oracle("q_term_stats", f"""
SELECT field, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ttf FROM ({POSTINGS}) GROUP BY field, term""")

oracle("q_num_terms", """
SELECT field, type, whole, real, false AS neg_zero, count(*) AS df, count(*) AS ttf FROM (
  SELECT 'size' AS field, 'short' AS type, p_size::BIGINT AS whole, NULL::DOUBLE AS real FROM part
  UNION ALL SELECT 'price', 'float', NULL, CAST(p_retailprice AS FLOAT)::DOUBLE FROM part
  UNION ALL SELECT 'col_' || p_name, 'integer', 1, NULL FROM part)
GROUP BY field, type, whole, real""")

PART_SHARD = shard_sql("p_partkey::VARCHAR", SHARDS)
oracle("q_num_postings", f"""
SELECT 'size' AS field, 'short' AS type, p_size::BIGINT AS whole, {PART_SHARD} AS shard_id,
       p_partkey::VARCHAR AS _id, 1::BIGINT AS tf FROM part
UNION ALL SELECT 'col_' || p_name, 'integer', 1, {PART_SHARD}, p_partkey::VARCHAR, 1 FROM part""")

oracle("q_match_published", f"""
SELECT p_partkey::VARCHAR AS _id, {PART_SHARD} AS shard_id FROM part
WHERE list_contains(regexp_extract_all(lower(p_type), '{TOKEN_RE}'), 'economy')""")

# --- E: predicates -----------------------------------------------------------

oracle("q_term_float", """
SELECT p_partkey::VARCHAR AS _id FROM part WHERE CAST(p_retailprice AS FLOAT) = CAST(901.0 AS FLOAT)""")

oracle("q_term_short", "SELECT p_partkey::VARCHAR AS _id FROM part WHERE p_size = 11")

oracle("q_range", f"""
SELECT {LI_ID} AS _id FROM lineitem
WHERE {epoch_days_sql('l_shipdate')} >= 9500 AND {epoch_days_sql('l_shipdate')} < 9600 AND l_quantity > 45""")

oracle("q_fuzzy", """
SELECT p_partkey::VARCHAR AS _id FROM part
WHERE CAST(p_retailprice AS FLOAT) BETWEEN CAST(1000.0 AS FLOAT) - CAST(50.0 AS FLOAT)
                                       AND CAST(1000.0 AS FLOAT) + CAST(50.0 AS FLOAT)
  AND p_size BETWEEN 20 - 3 AND 20 + 3""")

_TEXT_FIELDS = parsed_fields_sql(_TEXT_KEYED, ' ', carry="doc_id, ln")
oracle("q_exists", f"""
SELECT k._id, CAST(len({columns_sql('k.payload', ' ')}) AS INTEGER) AS n_fields
FROM ({_TEXT_KEYED}) k
WHERE EXISTS (SELECT 1 FROM ({_TEXT_FIELDS}) f
              WHERE f.doc_id = k.doc_id AND f.ln = k.ln
                AND (f.name = 'col_the' OR starts_with(f.name, 'col_the.')))""")

oracle("q_match_term", f"""
SELECT doc_id::VARCHAR AS _id, lang FROM ({DOC_TOKENS}) WHERE list_contains(toks, 'the')""")

oracle("q_get_by_id", f"""
SELECT o_orderkey::VARCHAR AS _id, {shard_sql('o_orderkey::VARCHAR', SHARDS)} AS shard_id, 5 AS n_fields
FROM orders WHERE o_orderkey::VARCHAR = '42'""")

# --- G: statistics -----------------------------------------------------------

oracle("q_field_stats", f"""
WITH f AS ({lineitem_fields()}),
     d AS (SELECT DISTINCT dk, name, type, num, str FROM f)
SELECT a.name, a.type, (SELECT count(*) FROM lineitem) AS max_doc, a.doc_count, b.sum_doc_freq,
       a.sum_total_term_freq, a.min_l, a.max_l, a.min_d, a.max_d
FROM (SELECT name, type, count(DISTINCT dk) AS doc_count, count(*) AS sum_total_term_freq,
             CAST(min(CASE WHEN type IN ('integer', 'long', 'short') THEN num END) AS BIGINT) AS min_l,
             CAST(max(CASE WHEN type IN ('integer', 'long', 'short') THEN num END) AS BIGINT) AS max_l,
             min(CASE WHEN type IN ('float', 'double') THEN num END) AS min_d,
             max(CASE WHEN type IN ('float', 'double') THEN num END) AS max_d FROM f GROUP BY name, type) a
JOIN (SELECT name, type, count(*) AS sum_doc_freq FROM d GROUP BY name, type) b USING (name, type)""")

oracle("q_duplicate_ids", """
SELECT user_id::VARCHAR AS _id, count(*) AS n_docs FROM events GROUP BY user_id HAVING count(*) > 1""")

oracle("q_manifest", f"""
SELECT 'b1' AS build_id, {shard_sql('o_orderkey::VARCHAR', SHARDS)} AS shard_id, 1 AS generation,
       count(*) AS n_docs, count(DISTINCT o_orderkey) AS n_ids,
       min(o_orderkey::VARCHAR) AS min_id, max(o_orderkey::VARCHAR) AS max_id
FROM orders GROUP BY 2""")

# --- F: placement ------------------------------------------------------------

oracle("q_shard_order", f"""
SELECT shard_id, _id, CAST(row_number() OVER (PARTITION BY shard_id ORDER BY _id DESC) AS INTEGER) AS rank
FROM (SELECT {shard_sql('o_orderkey::VARCHAR', SHARDS)} AS shard_id, o_orderkey::VARCHAR AS _id FROM orders)""")

oracle("q_split_order", ORACLES["q_shard_order"])

oracle("q_shard_skew", f"""
SELECT CAST(count(*) AS BIGINT) AS n_shards, max(n) AS max_docs, min(n) AS min_docs, sum(n)::BIGINT AS total_docs,
       round(max(n) / avg(n), 6) AS skew
FROM (SELECT {shard_sql(LI_ID, SHARDS)} AS shard_id, count(*) AS n FROM lineitem GROUP BY 1)""")

# --- H: publish and audits ---------------------------------------------------

ORDERS_BY_SHARD = f"""
SELECT {shard_sql('o_orderkey::VARCHAR', SHARDS)} AS shard_id, count(*) AS n_docs,
       min(o_orderkey::VARCHAR) AS min_id, max(o_orderkey::VARCHAR) AS max_id
FROM orders GROUP BY 1"""

oracle("q_write_readback", ORDERS_BY_SHARD)

oracle("q_verify_publish", f"""
SELECT shard_id, n_docs AS expected, n_docs AS found, true AS ok FROM ({ORDERS_BY_SHARD})""")

oracle("q_bulk_lines", f"""
SELECT {shard_sql('o_orderkey::VARCHAR', SHARDS)} AS shard_id, o_orderkey::VARCHAR AS _id,
       concat('{{"index":{{"_index":"orders","_type":"order","_id":', to_json(o_orderkey::VARCHAR), '}}}}', chr(10),
              '{{"cust":', o_custkey, ',"total":', o_totalprice::VARCHAR, ',"status":', to_json(o_orderstatus),
              ',"day":', {epoch_days_sql('o_orderdate')}, ',', to_json('col_' || o_orderpriority), ':1}}') AS bulk
FROM orders""")

TRANSFER_LOG = """
SELECT CAST(year(l_shipdate) AS INTEGER) AS build_id, 'idx_' || l_returnflag AS index, l_linenumber - 1 AS shard_id,
       'node' || (l_suppkey % 8) AS host, (l_suppkey % 8 = 0) AS is_primary,
       floor(l_extendedprice)::BIGINT - CASE WHEN l_discount >= 0.1 AND l_tax >= 0.08 THEN 1 ELSE 0 END
         >= floor(l_extendedprice)::BIGINT AS ok
FROM lineitem"""

oracle("q_transfer_acceptance", f"""
SELECT build_id, index, shard_id, primary_ok, n_replicas, n_replicas_ok,
       CASE WHEN NOT primary_ok THEN 'failed'
            WHEN n_replicas > 0 AND n_replicas_ok = 0 THEN 'failed'
            WHEN n_replicas_ok < n_replicas THEN 'partial' ELSE 'accepted' END AS status
FROM (SELECT build_id, index, shard_id,
             coalesce(bool_or(is_primary AND host_ok), false) AS primary_ok,
             count(*) FILTER (WHERE NOT is_primary) AS n_replicas,
             count(*) FILTER (WHERE NOT is_primary AND host_ok) AS n_replicas_ok
      FROM (SELECT build_id, index, shard_id, host, is_primary, bool_and(ok) AS host_ok
            FROM ({TRANSFER_LOG}) GROUP BY ALL)
      GROUP BY ALL)""")

SHARD_STATE = """
SELECT CAST(year(l_shipdate) AS INTEGER) AS ts, 'idx_' || l_returnflag AS index, l_linenumber - 1 AS shard_id,
       CASE WHEN l_suppkey % 8 = 0 THEN 'primary' ELSE 'replica' END AS role,
       'node' || (l_suppkey % 8) AS host, l_discount < 0.1 AS assigned, l_tax < 0.08 AS active
FROM lineitem"""

oracle("q_shard_readiness", f"""
SELECT ts, index, shard_id, primary_ok, n_replicas, n_active_replicas, replica_hosts,
       primary_ok AND (n_replicas = 0 OR n_active_replicas > 0) AS ready
FROM (SELECT ts, index, shard_id,
             coalesce(bool_or(role = 'primary' AND assigned AND active), false) AS primary_ok,
             count(*) FILTER (WHERE role = 'replica') AS n_replicas,
             count(*) FILTER (WHERE role = 'replica' AND assigned AND active) AS n_active_replicas,
             coalesce(array_to_string(list_sort(list_distinct(list(host) FILTER (WHERE role = 'replica' AND assigned AND active))), ','), '') AS replica_hosts
      FROM ({SHARD_STATE}) GROUP BY ALL)""")

oracle("q_index_readiness", f"""
SELECT ts, index, count(*) AS n_shards, bool_and(ready) AS ready FROM (
  SELECT ts, index, shard_id,
         coalesce(bool_or(role = 'primary' AND assigned AND active), false)
         AND (count(*) FILTER (WHERE role = 'replica') = 0
              OR count(*) FILTER (WHERE role = 'replica' AND assigned AND active) > 0) AS ready
  FROM ({SHARD_STATE}) GROUP BY ALL)
GROUP BY ts, index""")

oracle("q_stream_ingest", f"SELECT *, n_docs AS n_keys, 2::BIGINT AS n_batches FROM ({ORDERS_BY_SHARD})")

DOC_META_SHARD = shard_sql("doc_id::VARCHAR", SHARDS)
oracle("q_publish_rejects", f"""
SELECT shard_id, n_docs, n_rejected, n_rejected AS found, CASE WHEN n_rejected > 0 THEN 'bad_short' END AS reason
FROM (SELECT range::INT AS shard_id FROM range({SHARDS})) LEFT JOIN (
  SELECT {DOC_META_SHARD} AS shard_id, count(*) FILTER (n_chars <= 32767) AS n_docs,
         count(*) FILTER (n_chars > 32767) AS n_rejected FROM documents GROUP BY 1) USING (shard_id)""")

oracle("q_meta_import", """
SELECT 'name' AS name, 'string' AS type, count(*) AS n, 0 AS n_bad, NULL::BIGINT AS sum_short, count(*) AS n_str FROM customer
UNION ALL SELECT 'nation', 'short', count(*), 0, CAST(sum(c_nationkey) AS BIGINT), 0 FROM customer
UNION ALL SELECT 'acctbal', 'integer', count(*), count(*) FILTER (contains(c_acctbal::VARCHAR, '.')), NULL, 0 FROM customer
UNION ALL SELECT 'segment', 'string', count(*), 0, NULL, count(*) FROM customer""")

oracle("q_published_postings", f"""
SELECT 'status' AS field, lower(o_orderstatus) AS term, {shard_sql('o_orderkey::VARCHAR', SHARDS)} AS shard_id,
       count(*) AS df, count(*) AS ttf
FROM orders GROUP BY 2, 3""")

oracle("q_published_doc_values", f"""
SELECT {shard_sql('o_orderkey::VARCHAR', SHARDS)} AS shard_id, count(*) AS n_docs,
       min(o_totalprice) AS min_total, max(o_totalprice) AS max_total, count(o_custkey) AS n_cust
FROM orders GROUP BY 1""")


def _li_json_head() -> str:
    d = epoch_days_sql("l_shipdate")
    return ("'{\"qty\":', l_quantity::VARCHAR, ',\"line\":', l_linenumber, ',\"part\":', l_partkey, "
            "',\"disc\":', CAST(l_discount AS FLOAT)::VARCHAR, ',\"tax\":', CAST(l_tax AS FLOAT)::VARCHAR, "
            "',\"flag\":', to_json(l_returnflag), ',\"price\":', l_extendedprice::VARCHAR, "
            f"',\"ship\":', {d}, ',\"status\":', to_json(l_linestatus), "
            "',', to_json('col_' || l_returnflag), ':1'")


oracle("q_source_dup", f"""
SELECT {LI_ID} AS _id,
       concat({_li_json_head()}, ',"code":', to_json(l_returnflag),
              ',"num":', CAST(trunc(l_quantity) AS INTEGER), '}}') AS src_last,
       concat({_li_json_head()}, ',"code":[', to_json(l_returnflag), ',', to_json(l_linestatus), ',',
              to_json(l_returnflag), '],"num":[', l_linenumber, ',', CAST(trunc(l_quantity) AS INTEGER), ']}}')
         AS src_array
FROM lineitem""")

oracle("q_range_wide", ORACLES["q_range"])


# --- lookups, search and verification on published builds ----------------------

ORDER_SHARD = shard_sql("o_orderkey::VARCHAR", SHARDS)

oracle("q_lookup_ids", f"""
SELECT o_orderkey::VARCHAR AS _id, {ORDER_SHARD} AS shard_id, 5 AS n_fields FROM orders WHERE o_orderkey IN (42, 777, 14999)""")

oracle("q_lookup_join", f"""
SELECT o_orderkey::VARCHAR AS _id, {ORDER_SHARD} AS shard_id, 5 AS n_fields
FROM orders WHERE o_orderkey IN (SELECT c_custkey FROM customer)""")

oracle("q_search", f"""
SELECT p_partkey::VARCHAR AS _id, {PART_SHARD} AS shard_id FROM part
WHERE list_contains(regexp_extract_all(lower(p_type), '{TOKEN_RE}'), 'economy') AND p_size >= 10 AND p_size < 30
  AND CAST(p_retailprice AS FLOAT) BETWEEN CAST(850 AS FLOAT) AND CAST(1150 AS FLOAT)""")

oracle("q_search_common", f"""
SELECT o_orderkey::VARCHAR AS _id, {ORDER_SHARD} AS shard_id FROM orders
WHERE lower(o_orderstatus) = 'o' AND o_totalprice > 200000 AND {epoch_days_sql('o_orderdate')} <= 9800""")

oracle("q_build_files", f"SELECT *, 0::BIGINT AS n_faults FROM ({ORDERS_BY_SHARD})")

oracle("q_stream_publish", f"SELECT *, n_docs AS n_keys, 2::BIGINT AS n_epochs FROM ({ORDERS_BY_SHARD})")

oracle("q_wide_discovered", """
SELECT o_orderkey::VARCHAR AS _id, CAST(o_orderkey % 3 AS INTEGER) AS "N", CAST(CASE WHEN o_orderkey % 2 = 0
    THEN (9007199254740992 + o_orderkey % 7)::VARCHAR ELSE '0.5' END AS VARCHAR) AS big, CAST(o_orderkey % 100 AS BIGINT) AS n__2,
  CASE WHEN o_orderkey % 2 = 0 THEN 'a' || (o_orderkey % 5)::VARCHAR ELSE '7' END AS s, (o_orderkey % 8) / 4.0::DOUBLE AS x,
  CAST(o_orderkey % 90 AS FLOAT) AS y, CAST(o_orderkey % 80 AS DOUBLE) AS z
FROM orders""")

oracle("q_discover_schema", """
SELECT name, joined, n_types, (SELECT count(*) FROM orders) AS n_values
FROM (VALUES ('N', 'integer', 1::BIGINT), ('big', 'string', 2), ('n', 'long', 3), ('s', 'string', 2), ('x', 'double', 2), ('y', 'float', 2),
  ('z', 'double', 2)) t(name, joined, n_types)""")

# The same words for the scripts of ``documents``: chains of letters and of numbers, as RE2 has no look-behind.
WORD_RE = r"_*(?:\p{L}+(?:[.:''’]\p{L}+)*|\p{Nd}+(?:[.,;''’]\p{Nd}+)*|_+)+"

oracle("q_word_terms", rf"""
SELECT term, count(DISTINCT doc_id) AS df, count(*) AS ttf
FROM (SELECT doc_id, lower(unnest(regexp_extract_all(text, '{WORD_RE}'))) AS term FROM documents)
WHERE regexp_matches(term, '[\p{{L}}\p{{Nd}}]') GROUP BY term""")

oracle("q_stored_field_stats", f"""
SELECT name, type, (SELECT count(*) FROM orders) AS max_doc, count(*) AS doc_count, count(*) AS sum_doc_freq, count(*) AS sum_total_term_freq,
  CAST(min(CASE WHEN type IN ('long', 'integer') THEN num END) AS BIGINT) AS min_l,
  CAST(max(CASE WHEN type IN ('long', 'integer') THEN num END) AS BIGINT) AS max_l,
  min(CASE WHEN type = 'double' THEN num END) AS min_d, max(CASE WHEN type = 'double' THEN num END) AS max_d
FROM ({orders_fields()}) GROUP BY name, type""")

oracle("q_stored_term_stats", f"""
SELECT 'status' AS field, lower(o_orderstatus) AS term, count(*) AS df, count(*) AS ttf
FROM orders WHERE {ORDER_SHARD} IN (1, 3) GROUP BY o_orderstatus""")

oracle("q_placed_by_bytes", f"""
SELECT shard_id, _id, CAST(octet_length(encode(payload)) AS BIGINT) AS bytes, row_number() OVER (PARTITION BY shard_id ORDER BY _id DESC) AS rank
FROM (SELECT {shard_sql('doc_id::VARCHAR', SHARDS)} AS shard_id, doc_id::VARCHAR AS _id, replace(text, chr(9), ' ') AS payload FROM documents)""")
