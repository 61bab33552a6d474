"""Captures to batches and acknowledgements, by one set of settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.config import Settings
from sluicegate.operators import batching, filter, keys, ledger, reporting
from sluicegate.shipping import ship
from sluicegate.sources import framing


@dataclass(frozen=True)
class Result:
    """frames of all connections, decisions on their events, batches with attributes, acknowledgements once these are committed."""

    frames: DataFrame
    decisions: DataFrame
    batches: DataFrame
    acks: DataFrame


def process(captures: DataFrame, settings: Settings = Settings(), metrics: dict[str, object] | None = None, limit_active: bool = False) -> Result:
    """captures: capture_id, conn_id, data and, as far as known, listener, remote_address, remote_port, received_ts, tls_subject, tls_issuer.

    Each listener batches what it received itself, so keys that all events share are one task for each listener only. Of
    several captures of a connection the first by capture_id tells its sender. Payloads stay as they came, UTF-8 or
    not; with rules those that aren't are errors, which the policy decides on. metrics: values of attributes, as Listener.metrics() gives.
    limit_active: a listener holds maximum-active-batch-keys open batches at most, which makes it one ordered task.

    Windows and their ends are told before rules drop events, so a window whose last event is dropped ends no
    batch. Events up to the first break of a connection count; dropped ones are acknowledged like committed
    ones, in order. Connections are interleaved by the place of their frames.
    """
    ship(captures.sparkSession)
    frames = framing.decode(captures, settings.frame_limits)
    told = ledger.assign_windows(frames, settings["maximum-events-per-window"])
    given = {c: captures[c] if c in captures.columns else F.lit(None).cast(k) for c, k in (("listener", "string"), ("remote_address", "string"), ("remote_port", "int"), ("tls_subject", "string"), ("tls_issuer", "string"), ("received_ts", "timestamp"))}
    first = F.min(F.struct("capture_id", *[x.alias(c) for c, x in given.items()])).alias("first")
    senders = captures.groupBy("conn_id").agg(first).select("conn_id", *[f"first.{c}" for c in given])
    events = told.where("type = 'J'").join(senders, "conn_id", "left").select(
        "conn_id", "sequence", "window_id", "offset", "window_complete", "frame_no", F.struct("frame_no", "conn_id").alias("arrival"), *given, F.col("payload").cast("string").alias("raw")
    )
    strategy = settings["batching-strategy"]
    pointers = keys.needed_pointers(strategy, settings.pointers)
    limits = {"max_rules": settings["maximum-filter-rules"], "max_unindexed": settings["maximum-unindexed-filter-rules"]}
    decisions = filter.apply_filter(events, settings.active_rules, settings["filter-evaluation-error-policy"], order="frame_no", batch_pointers=pointers, **limits)
    kept = keys.with_batch_key(
        decisions.where("not drop"), strategy, settings.pointers, settings["missing-key-policy"], settings["default-batch-bucket"], settings["hash-batch-keys"], settings["maximum-batch-key-length"],
        values="batch_values" if settings.active_rules and pointers else None,
    )
    kept_events = kept.drop("batch_values", "valid")
    if limit_active:
        assigned = batching.assign_limited(kept_events, settings.batch_limits, settings["maximum-active-batch-keys"], shard="listener")
    else:
        assigned = batching.assign_batches(kept_events, settings.batch_limits, shard="listener")
    batches = batching.collect_batches(assigned, shard="listener")
    batches = reporting.attributes(batches, strategy, settings["listening-port"], settings["metrics-attribute-detail"], metrics)
    done = kept.select("conn_id", "window_id", "offset").withColumn("_kept", F.lit(True))
    state = decisions.join(done, ["conn_id", "window_id", "offset"], "left").withColumn("committed", F.col("drop") | F.coalesce("_kept", F.lit(False)))
    opened = told.where("type = 'W'").select("conn_id", "window_id", F.col("window_size").alias("advertised"))
    return Result(frames, decisions, batches, ledger.frontier(state, opened))
