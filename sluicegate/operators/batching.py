"""Keyed batches: bounded by count, bytes, age and idle time, closed by window ends."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    """When a batch is full. Times in microseconds; timers=False leaves out age and idle time."""

    events: int = 10_000
    bytes: int = 8 * 1024 * 1024
    age: int = 1_000_000
    idle: int = 250_000
    strategy: str = "SIZE_TIME"
    timers: bool = True


@dataclass
class Open:
    """A batch that isn't full yet: what later events of its key need to know of it."""

    number: int = 0
    events: int = 0
    bytes: int = 0
    created: int = 0
    last: int = 0

    def due(self, limits: Limits) -> tuple[int, str]:
        """When timers end it, and why; age comes before idle time."""
        age, idle = self.created + limits.age, self.last + limits.idle
        return (age, "maximum-age") if age <= idle else (idle, "idle")


def runs(sizes: np.ndarray, ends: np.ndarray, at: np.ndarray, limits: Limits, held: Open) -> Iterator[tuple[int, int, int, str | None]]:
    """Cuts a key's events, in their order, into batches: (number, from, to, reason); the last may stay open (None).

    sizes, ends, at: bytes, whether a window ends, microseconds. held: the batch left open by the events before, and after
    the call the one that these leave open; an event list that starts by ending it gives an empty run from == to. Each batch is found by
    searches in running sums, so the work is in batches, not in events.
    """
    n, at_event = len(sizes), 0
    total = np.concatenate([[0], np.cumsum(sizes)])
    window = np.flatnonzero(ends) if limits.strategy == "WINDOW" else np.zeros(0, dtype=np.int64)
    # where the time to the event before is so long that idle time ends the batch
    gaps = np.flatnonzero(np.diff(at) >= limits.idle) + 1 if limits.timers else np.zeros(0, dtype=np.int64)
    while at_event < n:
        start = at_event
        if held.events and limits.timers and at[start] >= held.due(limits)[0]:
            yield held.number, start, start, held.due(limits)[1]
            held.number, held.events, held.bytes = held.number + 1, 0, 0
        if held.events and held.bytes + sizes[start] > limits.bytes:
            yield held.number, start, start, "byte-count"
            held.number, held.events, held.bytes = held.number + 1, 0, 0
        if not held.events:
            held.created = int(at[start])
        # after: the place behind the batch's last event, for each way to end it
        if limits.strategy == "NONE":
            after, reason = start + 1, "none"
        else:
            options = [(n, 9, None)]
            if (i := int(np.searchsorted(window, start))) < len(window):
                options.append((int(window[i]) + 1, 0, "window-boundary"))
            options.append((start + limits.events - held.events, 1, "event-count"))
            room = limits.bytes - held.bytes + total[start]
            options.append((int(np.searchsorted(total, room, side="left")), 2, "byte-count"))
            over = int(np.searchsorted(total, room, side="right")) - 1  # the next event doesn't fit
            if start < over < n:
                options.append((over, 4, "byte-count"))
            if limits.timers:
                old = int(np.searchsorted(at, held.created + limits.age, side="left"))
                gap = int(gaps[i]) if (i := int(np.searchsorted(gaps, start, side="right"))) < len(gaps) else n + 1
                for place in sorted({old, gap}):
                    if start < place < n:
                        due = Open(created=held.created, last=int(at[place - 1])).due(limits)
                        if at[place] >= due[0]:
                            options.append((place, 3, due[1]))
            after, _, reason = min((o for o in options if o[0] > start), key=lambda o: o[:2])
            if after > n:
                after, reason = n, None
        yield held.number, start, after, reason
        if reason:
            held.number, held.events, held.bytes = held.number + 1, 0, 0
        else:
            held.events, held.bytes = held.events + after - start, held.bytes + int(total[after] - total[start])
        held.last = int(at[after - 1])
        at_event = after


def assign_batches(events: DataFrame, limits: Limits = Limits(), key: str = "batch_key", order: str = "arrival", shard: str | None = None, closing: str | None = "service-disabled") -> DataFrame:
    """events with batch_no and flush_reason (null for a batch that stays open; closing if that is given).

    Events of a key are taken in order. shard: a column by which keys are separate as well, such as
    the listener that received an event; a key's batches follow from one another, so a key (of a shard) is one
    task, which keeps only its open batch. Timers are replayed: a batch ends at its due time if the next event comes
    then or later.
    """
    keys = [*([shard] if shard else []), key]
    columns = events.columns
    schema = events.select("*", F.lit(0).cast("long").alias("batch_no"), F.lit("").alias("flush_reason")).schema
    schema["flush_reason"].nullable = True
    size = F.octet_length("raw").cast("long")
    time = F.unix_micros("received_ts") if "received_ts" in columns else F.lit(0).cast("long")
    end = F.coalesce("window_complete", F.lit(False)) if "window_complete" in columns else F.lit(False)
    rows = events.select("*", F.coalesce(size, F.lit(0)).alias("_size"), F.coalesce(time, F.lit(0)).alias("_at"), end.alias("_end"))
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, waiting = None, Open(), []

        def given(rows: pa.RecordBatch, number: int, reason: str | None) -> pa.RecordBatch:
            n = len(rows)
            made = [pa.array([number] * n, type=pa.int64()), pa.array([reason] * n, type=pa.string())]
            return pa.RecordBatch.from_arrays([*(rows.column(c) for c in columns), *made], names=[*columns, "batch_no", "flush_reason"])

        def released(reason: str | None) -> Iterator[pa.RecordBatch]:
            for rows in waiting:
                yield given(rows, held.number, reason)
            waiting.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = list(zip(*(batch.column(k).to_pylist() for k in keys)))
            cuts = [0, *[i for i in range(1, len(ids)) if ids[i] != ids[i - 1]], len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                if ids[a] != now:
                    yield from released(closing)
                    now, held = ids[a], Open()
                own = batch.slice(a, b - a)
                arrays = [own.column(c).to_numpy(zero_copy_only=False) for c in ("_size", "_end", "_at")]
                for number, start, to, reason in runs(*arrays, limits, held):
                    if reason:
                        for rows in waiting:
                            yield given(rows, number, reason)
                        waiting.clear()
                        if to > start:
                            yield given(own.slice(start, to - start), number, reason)
                    else:
                        waiting.append(own.slice(start, to - start))
        yield from released(closing)

    return rows.mapInArrow(run, schema)


def assign_limited(events: DataFrame, limits: Limits = Limits(), max_active: int = 2048, key: str = "batch_key", order: str = "arrival", shard: str | None = None, closing: str | None = "service-disabled") -> DataFrame:
    """Like assign_batches, where a listener (shard) holds max_active open batches at most.

    The event of a key without an open batch ends the batch that was opened first, if there are so many ("active-key-limit").
    Timers end batches as time goes on, whatever key the next event has. As all keys of a listener bear on each other, its events are
    one ordered task, which keeps counters of open batches only; batch_no counts the batches of a listener in the order in
    which they were opened.
    """
    columns, own = events.columns, F.col(shard) if shard else F.lit(0)
    time = F.unix_micros("received_ts") if "received_ts" in columns else F.lit(0).cast("long")
    end = F.coalesce("window_complete", F.lit(False)) if "window_complete" in columns else F.lit(False)
    rows = events.select(*columns, own.alias("_shard"), F.coalesce(F.octet_length("raw").cast("long"), F.lit(0)).alias("_size"), F.coalesce(time, F.lit(0)).alias("_at"), end.alias("_end"))
    rows = rows.repartition("_shard").sortWithinPartitions("_shard", order)
    schema = rows.select(*columns, "_shard", F.lit(0).cast("long").alias("batch_no"), F.lit("").alias("_reason")).schema
    for f in schema.fields:
        f.nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, opened, ended = None, 0, []
        active: dict[object, Open] = {}  # in the order of opening

        def close(k: object, reason: str | None) -> None:
            ended.append((now, active.pop(k).number, reason))

        def told(like: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            """The batches that ended, as rows without an event."""
            if ended:
                shards, numbers, reasons = zip(*ended)
                made = [pa.nulls(len(ended), like.schema.field(c).type) for c in columns]
                yield pa.RecordBatch.from_arrays([*made, pa.array(shards, type=like.schema.field("_shard").type), pa.array(numbers, type=pa.int64()), pa.array(reasons, type=pa.string())], names=[*columns, "_shard", "batch_no", "_reason"])
                ended.clear()

        last = None
        for batch in batches:
            last, out = batch, []
            for s, k, size, at, window in zip(*(batch.column(c).to_pylist() for c in ("_shard", key, "_size", "_at", "_end"))):
                if s != now:
                    for x in list(active):
                        close(x, closing)
                    now, opened = s, 0
                if limits.timers:
                    for x in [x for x, o in active.items() if o.due(limits)[0] <= at]:
                        close(x, active[x].due(limits)[1])
                if k in active and active[k].bytes + size > limits.bytes:
                    close(k, "byte-count")
                if k not in active:
                    if len(active) >= max_active:
                        close(next(iter(active)), "active-key-limit")
                    active[k] = Open(opened, created=at)
                    opened += 1
                o = active[k]
                o.events, o.bytes, o.last = o.events + 1, o.bytes + size, at
                out.append(o.number)
                if limits.strategy == "NONE":
                    close(k, "none")
                elif limits.strategy == "WINDOW" and window:
                    close(k, "window-boundary")
                elif o.events >= limits.events:
                    close(k, "event-count")
                elif o.bytes >= limits.bytes:
                    close(k, "byte-count")
            made = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*made, batch.column("_shard"), pa.array(out, type=pa.int64()), pa.array([""] * len(out), type=pa.string())], names=[*columns, "_shard", "batch_no", "_reason"])
            yield from told(batch)
        if last is not None:
            for x in list(active):
                close(x, closing)
            yield from told(last)

    folded = rows.mapInArrow(run, schema)
    events_of, ends_of = folded.where("_reason = ''"), folded.where("_reason is null or _reason <> ''").select(F.col("_shard").alias("_s"), F.col("batch_no").alias("_n"), F.col("_reason").alias("flush_reason"))
    both = events_of.drop("_reason").join(ends_of, F.col("_shard").eqNullSafe(F.col("_s")) & (F.col("batch_no") == F.col("_n")), "left")
    return both.select(*columns, "batch_no", "flush_reason")


def count_batches(events: DataFrame, max_events: int, key: str = "batch_key", order: str = "arrival") -> DataFrame:
    """events with batch_no where only the number of events ends a batch: a window function does."""
    return events.selectExpr("*", f"cast((row_number() over (partition by `{key}` order by `{order}`) - 1) div {max_events} as long) as batch_no")


def collect_batches(assigned: DataFrame, key: str = "batch_key", order: str = "arrival", shard: str | None = None) -> DataFrame:
    """One row per batch (of a shard): flush_reason, counts, bytes, ndjson, runs, what its events have in common.

    ndjson is every raw text as it came, each followed by a line end. runs are stretches of consecutive sequences
    (modulo 2^32) of a connection's window in the order of arrival: first and count.
    A batch is bounded by its limits, so its texts meet in one task.
    """
    keys = [*([shard] if shard else []), key, "batch_no"]
    wide = f"partition by {', '.join(f'`{k}`' for k in keys)} order by `{order}`"
    rows = assigned.selectExpr("*", f"lag(struct(conn_id, window_id, sequence)) over ({wide}) as _prev")
    follows = "_prev is not null and _prev.conn_id <=> conn_id and _prev.window_id <=> window_id and sequence = ((_prev.sequence + 1) & 4294967295)"
    rows = rows.selectExpr("*", f"sum(case when {follows} then 0 else 1 end) over ({wide}) as _run")
    place = F.struct(F.col(order).alias("o"), "raw")
    per_run = rows.groupBy(*keys, "_run").agg(
        F.min(order).alias("_first"),
        F.max(order).alias("_last"),
        F.first("flush_reason").alias("flush_reason"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length("raw")).alias("payload"),
        F.array_sort(F.collect_list(place)).alias("texts"),
        F.first("conn_id").alias("conn_id"),
        F.first("window_id").alias("window_id"),
        F.min_by("sequence", order).alias("first_seq"),
        F.max_by("sequence", order).alias("last_seq"),
        F.min("received_ts").alias("oldest"),
        *[F.min(c).alias(f"low_{c}") for c in _COMMON],
        *[F.max(c).alias(f"high_{c}") for c in _COMMON],
        *[F.count_if(F.col(c).isNull()).alias(f"none_{c}") for c in _COMMON],
    )
    common = {c: F.when((F.min(f"low_{c}") == F.max(f"high_{c}")) & (F.sum(f"none_{c}") == 0), F.min(f"low_{c}")) for c in _COMMON}
    one_conn = F.min("conn_id") == F.max("conn_id")
    one_window = one_conn & (F.min("window_id") == F.max("window_id"))
    texts = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_first", "texts"))), lambda x: x["texts"]))
    run = F.struct("_first", F.struct("conn_id", "window_id", "first_seq", F.col("n").alias("count")).alias("run"))
    return per_run.groupBy(*keys).agg(
        F.first("flush_reason").alias("flush_reason"),
        F.sum("n").cast("int").alias("event_count"),
        F.sum("payload").alias("payload_bytes"),
        (F.sum("payload") + F.sum("n")).alias("encoded_bytes"),
        F.concat(F.array_join(F.transform(texts, lambda x: F.coalesce(x["raw"], F.lit(""))), "\n"), F.lit("\n")).alias("ndjson"),
        F.transform(F.array_sort(F.collect_list(run)), lambda x: x["run"]).alias("runs"),
        F.min("oldest").alias("oldest_received_ts"),
        F.when(one_conn, F.min("conn_id")).alias("conn_id"),
        F.when(one_window, F.min("window_id")).alias("window_id"),
        F.when(one_window, F.min_by("first_seq", "_first")).alias("first_sequence"),
        F.when(one_window, F.max_by("last_seq", "_last")).alias("last_sequence"),
        *[x.alias(c) for c, x in common.items()],
    )


_COMMON = ("remote_address", "remote_port", "tls_subject", "tls_issuer")


def claim(batches: DataFrame, max_batches: int = 32, max_events: int = 10_000, max_bytes: int = 64 * 1024 * 1024, order: str = "ready_no") -> DataFrame:
    """The first batches in order that stay within all three limits; the first is always taken.

    A claim ends before the first batch that would pass a limit. At most max_batches + 1 rows are looked at.
    """
    head = batches.orderBy(order).limit(max_batches)
    wide = f"order by `{order}` rows unbounded preceding"
    sums = head.selectExpr("*", f"sum(event_count) over ({wide}) as _e", f"sum(payload_bytes) over ({wide}) as _b", f"row_number() over (order by `{order}`) as _n")
    fits = F.expr(f"_n = 1 or (_e <= {max_events} and _b <= {max_bytes})")
    stop = sums.withColumn("_fits", fits).selectExpr("*", f"min(_fits) over ({wide}) as _all")
    return stop.where("_all").select(*batches.columns)
