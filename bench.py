"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line: ``{"metric", "value", "unit", "queries", "sf"}``.
Every query runs to completion through a no-op sink (no collect to the
driver); ``import_*`` runs the whole sharded build and writes it.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from shardload.plans import queries as Q  # noqa: E402
from shardload.plans.build import shard_docs  # noqa: E402
from shardload.plans.publish import publish, write_sharded  # noqa: E402
from shardload.session import checkpoint_dir, get_spark, purge_scratch  # noqa: E402
from shardload.sources.tables import lineitem_lines, orders_lines  # noqa: E402

HEADLINE = [
    "q_shard_hist", "q_typed_fields", "q_route", "q_source_json", "q_field_names", "q_docvalues_num",
    "q_term_stats", "q_postings", "q_num_terms", "q_field_stats", "q_range", "q_duplicate_ids",
    "q_manifest", "q_shard_skew", "q_rejects", "q_publish_rejects", "q_split_order", "q_sort_double",
    "q_lookup_ids", "q_search_common", "q_build_files", "q_stream_publish", "q_wide_discovered", "q_word_terms", "q_stored_field_stats",
    "q_placed_by_bytes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="shardload-bench-")
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g"),
                             "spark.local.dir": scratch})
    checkpoint_dir(spark, fallback_root=os.path.join(scratch, "ckpt"))
    out = os.path.join(scratch, "out")

    # Warm the JVM (code generation, JIT) and the Python workers once on the
    # smallest tables, untimed, so the timings below are steady-state work.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        write_sharded(shard_docs(lineitem_lines(spark, warm_dir), "w", "w", shards=Q.SHARDS), f"{out}/warm")
        for name in HEADLINE:
            Q.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    else:
        Q.q_route(spark, sf_dir).limit(10).collect()

    times = {}

    def timed(name, fn):
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name} {times[name]}", file=sys.stderr, flush=True)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    timed("import_lineitem", lambda: write_sharded(
        shard_docs(lineitem_lines(spark, sf_dir), "lineitem", "item", shards=Q.SHARDS), f"{out}/lineitem"))
    timed("publish_lineitem", lambda: publish(
        shard_docs(lineitem_lines(spark, sf_dir), "lineitem", "item", shards=Q.SHARDS, split=2),
        f"{out}/published", shards=Q.SHARDS, with_postings=True, split=2,
        doc_value_schema={"qty": "double", "ship": "short", "code": "string", "num": "integer"}))
    timed("import_orders", lambda: write_sharded(
        shard_docs(orders_lines(spark, sf_dir), "orders", "order", shards=Q.SHARDS), f"{out}/orders"))
    for name in HEADLINE:
        timed(name, lambda n=name: noop(Q.QUERIES[n](spark, sf_dir)))

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus}))
    purge_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
