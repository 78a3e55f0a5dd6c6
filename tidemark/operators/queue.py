"""Work queue: lease transitions, stale leases, demand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEASE_SECONDS, MAX_FAILURES = 1200, 5


def swept(state: DataFrame, now: Column) -> DataFrame:
    """Leases without a heartbeat for LEASE_SECONDS become READY again."""
    stale = (F.col("status") == "IN_PROGRESS") & (F.col("heartbeat_at") < now - F.expr(f"INTERVAL {LEASE_SECONDS} SECONDS"))
    return state.withColumn("status", F.when(stale, "READY").otherwise(F.col("status"))).withColumn("run_id", F.when(stale, None).otherwise(F.col("run_id")))


def transition(state: DataFrame, events: DataFrame) -> DataFrame:
    """State after one event per id: (id, run_id, event) with event claim, heartbeat, success or failure.

    Only the run that holds the lease moves it on; the fifth failure in a row is FAILED for good.
    """
    e = events.select("id", F.col("run_id").alias("_run"), "event")
    both = state.join(e, "id", "left")
    owns = (F.col("status") == "IN_PROGRESS") & (F.col("run_id") == F.col("_run"))
    failures = F.when(owns & (F.col("event") == "failure"), F.col("failures") + 1).when(owns & (F.col("event") == "success"), 0).otherwise(F.col("failures"))
    outcome = (
        F.when(F.col("event").isNull(), "NONE")
        .when((F.col("event") == "claim") & (F.col("status") == "READY"), "CLAIMED")
        .when(owns, F.when(F.col("event") == "heartbeat", "TOUCHED").when(F.col("event") == "success", "DONE").when(F.col("event") == "failure", "RETRY").otherwise("IGNORED"))
        .when(F.col("event") == "claim", "IGNORED")
        .otherwise("OWNERSHIP_LOST_ABORTED")
    )
    moved = both.withColumn("outcome", outcome).withColumn("_failures", failures)
    status = F.when(F.col("outcome") == "CLAIMED", "IN_PROGRESS").when(F.col("outcome") == "DONE", "SUCCESS").when(F.col("outcome") == "RETRY", F.when(F.col("_failures") >= MAX_FAILURES, "FAILED").otherwise("READY")).otherwise(F.col("status"))
    run = F.when(F.col("outcome") == "CLAIMED", F.col("_run")).when(F.col("outcome").isin("DONE", "RETRY"), None).otherwise(F.col("run_id"))
    return moved.select("id", status.alias("status"), run.alias("run_id"), F.col("_failures").alias("failures"), "outcome")


def weekly_demand(buckets: DataFrame, as_of: Column) -> DataFrame:
    """(medicine_id, d7, prior): hits of the last seven days and of the seven before, where there are any."""
    d7, d14 = F.date_sub(as_of, 7), F.date_sub(as_of, 14)
    last = F.sum(F.when(F.col("date") >= d7, F.col("search_hits")).otherwise(0))
    prior = F.sum(F.when((F.col("date") >= d14) & (F.col("date") < d7), F.col("search_hits")).otherwise(0))
    return buckets.where(F.col("date") >= d14).groupBy("medicine_id").agg(last.alias("d7"), prior.alias("prior")).where("d7 > 0")
