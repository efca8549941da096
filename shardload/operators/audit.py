"""Delivery and readiness audits (H5, H6, G4) over log tables.

The reference checks these rules in its driver and task committer while it
copies shard files to hosts; here they are aggregations over the delivery
log (``transfer_log``) and the shard placement records (``shard_state``),
so they run over any number of builds at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Outcomes of the accept rule.
ACCEPTED, PARTIAL, FAILED = "accepted", "partial", "failed"


def host_outcomes(log: DataFrame) -> DataFrame:
    """A host received a shard when every file sent to it arrived complete."""
    return (log.groupBy("build_id", "index", "shard_id", "host", "is_primary")
            .agg(F.bool_and("ok").alias("host_ok"), F.count(F.lit(1)).alias("n_files")))


def transfer_acceptance(log: DataFrame) -> DataFrame:
    """H5: per build and shard — the primary must succeed; when replicas
    exist at least one must succeed; fewer than all is ``partial``."""
    h = host_outcomes(log)
    rep = ~F.col("is_primary")
    per = (h.groupBy("build_id", "index", "shard_id")
           .agg(F.coalesce(F.bool_or(F.col("is_primary") & F.col("host_ok")), F.lit(False)).alias("primary_ok"),
                F.count(F.when(rep, 1)).alias("n_replicas"),
                F.count(F.when(rep & F.col("host_ok"), 1)).alias("n_replicas_ok")))
    status = (F.when(~F.col("primary_ok"), F.lit(FAILED))
              .when((F.col("n_replicas") > 0) & (F.col("n_replicas_ok") == 0), F.lit(FAILED))
              .when(F.col("n_replicas_ok") < F.col("n_replicas"), F.lit(PARTIAL))
              .otherwise(F.lit(ACCEPTED)))
    return per.withColumn("status", status)


def shard_readiness(state: DataFrame) -> DataFrame:
    """Per snapshot, index and shard — primary assigned and active,
    and at least one active replica where replicas exist; the active replica
    hosts comma-joined (distinct hosts, sorted: bounded by the cluster size)."""
    up = F.col("assigned") & F.col("active")
    rep = F.col("role") == "replica"
    per = (state.groupBy("ts", "index", "shard_id")
           .agg(F.coalesce(F.bool_or((F.col("role") == "primary") & up), F.lit(False)).alias("primary_ok"),
                F.count(F.when(rep, 1)).alias("n_replicas"),
                F.count(F.when(rep & up, 1)).alias("n_active_replicas"),
                F.array_join(F.array_sort(F.collect_set(F.when(rep & up, F.col("host")))), ",")
                .alias("replica_hosts")))
    return per.withColumn("ready", F.col("primary_ok") & ((F.col("n_replicas") == 0)
                                                          | (F.col("n_active_replicas") > 0)))


def index_readiness(state: DataFrame) -> DataFrame:
    """H6: an index snapshot is ready when all of its shards are."""
    return (shard_readiness(state).groupBy("ts", "index")
            .agg(F.count(F.lit(1)).alias("n_shards"), F.bool_and("ready").alias("ready")))
