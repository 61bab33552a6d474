"""Windows, sequences and acknowledgements of connections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.operators.filter import cut_connections
from sluicegate.sources.framing import ack_column

#: Sequences are unsigned 32-bit numbers.
MASK = 4294967295
MAX_WINDOW, MAX_EVENTS, MAX_BYTES = 4096, 16_384, 32 * 1024 * 1024


def assign_windows(frames: DataFrame, max_window: int = MAX_WINDOW, cut: bool = True) -> DataFrame:
    """Event frames with window_id, offset, advertised, window_complete and error.

    frames: conn_id, frame_no, type (W, J, error), window_size, sequence and any other columns. A connection breaks
    at an event before any window, past the end of its window, or whose sequence doesn't follow the one before in
    the window; at a window that is too large or comes before the one before is complete; at an error frame. With
    cut, its frames from there on go, those before stay; else error names the first break at each frame.
    """
    conn = "partition by conn_id order by frame_no"
    rows = frames.selectExpr("*", f"sum(case when type = 'W' then 1 else 0 end) over ({conn}) as window_id")
    own = "partition by conn_id, window_id order by frame_no"
    rows = rows.selectExpr(
        "*",
        f"first(window_size) over ({own}) as advertised",
        f"sum(case when type = 'J' then 1 else 0 end) over ({own}) - 1 as offset",
        f"lag(case when type = 'J' then sequence end) over ({own}) as _prev",
    )
    rows = rows.selectExpr("*", f"lag(struct(type, offset, advertised)) over ({conn}) as _before")
    error = f"""case
      when type = 'error' then 'protocol error'
      when type = 'W' and (window_size > {max_window} or window_size < 0) then 'window exceeds maximum'
      when type = 'W' and _before is not null and coalesce(_before.offset + 1 < _before.advertised, false) then 'previous window incomplete'
      when type = 'J' and window_id = 0 then 'event before window'
      when type = 'J' and offset >= advertised then 'event past window'
      when type = 'J' and _prev is not null and sequence <> ((_prev + 1) & {MASK}) then 'sequence gap' end"""
    rows = rows.selectExpr("*", f"{error} as error_text").withColumn("window_complete", F.col("offset") + 1 == F.col("advertised"))
    if cut:
        rows = cut_connections(rows, F.col("error_text").isNotNull(), "conn_id", "frame_no")
    return rows.drop("_prev", "_before").withColumnRenamed("error_text", "ledger_error")


def coalesce_runs(events: DataFrame, order: str = "arrival", by: tuple[str, ...] = ("conn_id", "window_id")) -> DataFrame:
    """(by..., first_seq, count, first_arrival): stretches of consecutive sequences in the order of arrival, modulo 2^32."""
    wide = f"partition by {', '.join(by)} order by `{order}`"
    rows = events.selectExpr("*", f"case when sequence = ((lag(sequence) over ({wide}) + 1) & {MASK}) then 0 else 1 end as _new")
    rows = rows.selectExpr("*", f"sum(_new) over ({wide}) as _run")
    return rows.groupBy(*by, "_run").agg(F.min_by("sequence", order).alias("first_seq"), F.count(F.lit(1)).alias("count"), F.min(order).alias("first_arrival")).drop("_run")


def sequence_gaps(events: DataFrame) -> DataFrame:
    """Events whose sequence doesn't follow the one before in their window, with the one expected."""
    rows = events.selectExpr("*", f"(lag(sequence) over (partition by conn_id, window_id order by arrival) + 1) & {MASK} as expected")
    return rows.where("expected is not null and expected <> sequence")


def commit(ledger: DataFrame, runs: DataFrame) -> DataFrame:
    """ledger with committed set for events in runs (conn_id, window_id, first_seq, count).

    Runs of unknown windows change nothing, neither do repeated ones; runs that reach past what was received are
    clipped. Both sides meet on connection and window, whose events are bounded.
    """
    r = runs.select("conn_id", "window_id", "first_seq", "count").distinct()
    key = ["conn_id", "window_id", "sequence"]
    hit = ledger.select(*key).join(r, ["conn_id", "window_id"]).where(f"((sequence - first_seq) & {MASK}) < count").select(*key).distinct()
    out = ledger.join(hit.withColumn("_hit", F.lit(True)), key, "left")
    return out.select(*[F.col(c) for c in ledger.columns if c != "committed"], (F.col("committed") | F.coalesce("_hit", F.lit(False))).alias("committed"))


def frontier(ledger: DataFrame, windows: DataFrame) -> DataFrame:
    """Acknowledgements: for every window that the committed prefix reaches, the last sequence in it.

    ledger: conn_id, window_id, offset, sequence, committed, received_ts. windows: conn_id, window_id, advertised.
    A window is reached if all before it are received in full and committed. A window of no events is
    acknowledged with the sequence 0 in its place.
    """
    received = ledger.groupBy("conn_id", "window_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("committed")).alias("open"))
    state = windows.join(received, ["conn_id", "window_id"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    stuck = "case when n < advertised or coalesce(open, 0) > 0 then 1 else 0 end"
    before = "partition by conn_id order by window_id rows between unbounded preceding and 1 preceding"
    state = state.selectExpr("conn_id", "window_id", "advertised", f"coalesce(sum({stuck}) over ({before}), 0) as stuck").where("stuck = 0")
    rows = ledger.join(state, ["conn_id", "window_id"]).selectExpr("*", "sum(case when committed then 0 else 1 end) over (partition by conn_id, window_id order by offset) as _open").where("_open = 0")
    own = rows.groupBy("conn_id", "window_id").agg(F.max_by("sequence", "offset").alias("ack_sequence"), F.count(F.lit(1)).alias("events_advanced"), F.min("received_ts").alias("oldest_received_ts"))
    none = state.where("advertised = 0").select("conn_id", "window_id", F.lit(0).cast("long").alias("ack_sequence"), F.lit(0).cast("long").alias("events_advanced"), F.lit(None).cast("timestamp").alias("oldest_received_ts"))
    acks = own.union(none)
    return acks.selectExpr("conn_id", "cast(row_number() over (partition by conn_id order by window_id) as long) as ack_no", "window_id", "ack_sequence", "events_advanced", "oldest_received_ts").withColumn("ack", ack_column(F.col("ack_sequence")))


def outstanding(ledger: DataFrame, max_events: int = MAX_EVENTS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """ledger with the events and bytes of its connection that are open at each event, and whether a cap is passed."""
    wide = "partition by conn_id order by arrival rows unbounded preceding"
    rows = ledger.selectExpr("*", f"sum(case when committed then 0 else 1 end) over ({wide}) as open_events", f"sum(case when committed then 0 else payload_bytes end) over ({wide}) as open_bytes")
    return rows.withColumn("over_cap", (F.col("open_events") > max_events) | (F.col("open_bytes") > max_bytes))


def disconnected(ledger: DataFrame, closed: DataFrame) -> DataFrame:
    """Per closed connection, the unacknowledged events by whether their commit came first."""
    rows = ledger.join(closed.select("conn_id"), "conn_id").where("not acknowledged")
    return rows.groupBy("conn_id").agg(F.count_if(F.col("committed")).alias("after_commit"), F.count_if(~F.col("committed")).alias("before_commit"))
