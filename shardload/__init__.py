"""shardload: build sharded, searchable document datasets with Spark.

Input is delimited text whose cells describe their own columns
(``name:value:type``).  Every line becomes a typed, multi-valued document;
documents are routed to shards with a stable hash and published as a whole.
All work is DataFrame code; see ``README.md`` for the module map.
"""

DEFAULT_DELIM = "\t"
DEFAULT_SHARDS = 5
DEFAULT_TYPE = "doc"
