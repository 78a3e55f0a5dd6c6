"""Ranked picks with total orders, so that ties never decide by chance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_per(df: DataFrame, keys: list, order: list, n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group by ``order``, which must be total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def best_listing(scored: DataFrame, least: float = 0.2) -> DataFrame:
    """The best-scored listing per query and platform (earliest of ties), if it is relevant enough."""
    best = first_per(scored, ["query", "platform"], [F.desc("score"), F.asc("ord")])
    return best.where(F.col("score") >= least).withColumn("match_percentage", F.bround(F.col("score") * 100).cast("int"))


def relinked(prices: DataFrame) -> DataFrame:
    """Prices of a cluster (canonical_id, medicine_id, platform): the canonical keeps its own; else the first duplicate's moves."""
    own = F.when(F.col("medicine_id") == F.col("canonical_id"), 0).otherwise(1)
    kept = first_per(prices, ["canonical_id", "platform"], [own, F.asc("medicine_id")])
    return kept.withColumn("moved", F.col("medicine_id") != F.col("canonical_id"))


def keep_first(prices: DataFrame, order: list) -> DataFrame:
    """One row per (medicine, platform in lower case); a row that already is in lower case goes first."""
    low = F.lower("platform")
    return first_per(prices, ["medicine_id", low], [(F.col("platform") != low).cast("int"), *order]).withColumn("platform", low)


def claim(state: DataFrame, shards: int, n: int, shard: Column) -> DataFrame:
    """Up to ``n`` READY rows a shard, the longest unsynced first."""
    ready = state.where("status = 'READY'").withColumn("shard_id", shard)
    return first_per(ready, ["shard_id"], [F.asc_nulls_first("last_synced_at"), F.asc("id")], n)
