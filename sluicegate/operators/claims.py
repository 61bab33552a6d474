"""Claims on ready batches: taken from the head of the queue, then committed, rolled back or abandoned, once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.operators.batching import claim

#: The states of a claim.
CLAIMED, COMMITTED, ROLLED_BACK, ABANDONED = "CLAIMED", "COMMIT_CONFIRMED", "ROLLBACK_CONFIRMED", "ABANDONED"


def resolved(claims: DataFrame, resolutions: DataFrame, order: str = "at") -> DataFrame:
    """claims with state: that of their first resolution in order; later ones and those of unknown claims are ignored.

    claims: claim_id and whatever else (one row for each batch of a claim). resolutions: claim_id, state and order; rows
    with null or other states are none. Equal places in order: the smaller state by name counts.
    """
    known = resolutions.where(F.col("state").isin(COMMITTED, ROLLED_BACK, ABANDONED) & F.col("claim_id").isNotNull())
    first = known.groupBy("claim_id").agg(F.min(F.struct(F.col(order).alias("at"), "state")).alias("_first"))
    rows = claims.drop("state").join(first, "claim_id", "left")
    return rows.withColumn("state", F.coalesce("_first.state", F.lit(CLAIMED))).drop("_first")


def records(claims: DataFrame, ids: DataFrame) -> DataFrame:
    """The claims whose claim_id is among ids."""
    return claims.join(ids.select("claim_id"), "claim_id", "left_semi")


def queue(ready: DataFrame, claims: DataFrame) -> DataFrame:
    """The ready batches that can be claimed, in the order of ready_no.

    claims: ready_no, state, for every claim there was. A batch of an open or committed claim isn't in the queue; one that
    every claim of it gave back is at its old place again, before all that were never claimed. Rows of ready stay as they are.
    """
    held = claims.where(F.col("state").isin(CLAIMED, COMMITTED)).select("ready_no")
    return ready.join(held, "ready_no", "left_anti")


def next_claim(ready: DataFrame, claims: DataFrame, claim_id: str, max_batches: int = 32, max_events: int = 10_000, max_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """The batches that the next claim takes, with claim_id and the state CLAIMED."""
    taken = claim(queue(ready, claims), max_batches, max_events, max_bytes)
    return taken.select("ready_no", "event_count", "payload_bytes", F.lit(claim_id).alias("claim_id"), F.lit(CLAIMED).alias("state"))


def snapshot(claims: DataFrame) -> DataFrame:
    """(state, claims, batches) of now."""
    return claims.groupBy("state").agg(F.count_distinct("claim_id").alias("claims"), F.count(F.lit(1)).alias("batches"))
