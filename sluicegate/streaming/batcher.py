"""Keyed batches of a stream: state per key, processing-time timers, an idempotent NDJSON sink."""

from __future__ import annotations

import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sluicegate.operators.batching import Limits, Open, runs

OUT = "batch_key string, batch_no long, flush_reason string, event_count int, payload_bytes long, encoded_bytes long, ndjson binary"
_STATE = "number long, events long, bytes long, created long, last long"


class Batcher(StatefulProcessor):
    """The open batch of a key: its counters in one value, its texts in a list that is only appended to, one timer at its due time.

    forget: a key whose batch ended doesn't come again, as with keys of single events or windows, and leaves nothing behind.
    """

    def __init__(self, limits: Limits, forget: bool = False) -> None:
        self.limits, self.forget = limits, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", _STATE)
        self.texts = handle.getListState("texts", "raw binary")

    def _out(self, key: str, number: int, texts: list[bytes], reason: str) -> dict:
        size = sum(map(len, texts))
        return {"batch_key": key, "batch_no": number, "flush_reason": reason, "event_count": len(texts), "payload_bytes": size, "encoded_bytes": size + len(texts), "ndjson": b"".join(t + b"\n" for t in texts)}

    def _open(self) -> Open:
        return Open(*self.held.get()) if self.held.exists() else Open()

    def _taken(self) -> list[bytes]:
        """The texts so far, which leave the state."""
        texts = [bytes(r[0]) for r in self.texts.get()] if self.texts.exists() else []
        self.texts.clear()
        return texts

    def _keep(self, held: Open) -> None:
        if self.forget and not held.events:
            self.held.clear()
        else:
            self.held.update((held.number, held.events, held.bytes, held.created, held.last))
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        if held.events and self.limits.timers:
            self.handle.registerTimer(held.due(self.limits)[0] // 1000 + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self._open()
        stored, fresh, out = held.events > 0, [], []
        now = timerValues.getCurrentProcessingTimeInMs() * 1000
        for part in rows:
            part = part.sort_values("arrival")
            raw = [bytes(x) if x is not None else b"" for x in part["raw"]]
            sizes = np.array([len(t) for t in raw], dtype=np.int64)
            ends = part["window_complete"].fillna(False).to_numpy(dtype=bool) if "window_complete" in part else np.zeros(len(raw), dtype=bool)
            for number, a, b, reason in runs(sizes, ends, np.full(len(raw), now), self.limits, held):
                fresh += raw[a:b]
                if reason:
                    out.append(self._out(key[0], number, (self._taken() if stored else []) + fresh, reason))
                    stored, fresh = False, []
        if fresh:
            self.texts.appendList([(t,) for t in fresh])
        self._keep(held)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held, out = self._open(), []
        if held.events:
            out.append(self._out(key[0], held.number, self._taken(), held.due(self.limits)[1]))
            held = Open(number=held.number + 1)
        self._keep(held)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])

    def close(self) -> None:
        pass


def batched(events: DataFrame, limits: Limits = Limits(), forget: bool = False) -> DataFrame:
    """A stream of batches from a stream with batch_key, arrival, raw and window_complete.

    Needs the RocksDB state store. Timers fire with the micro-batches, so a batch ends by age or idle time at the first trigger after its due time.
    Payloads may be any bytes; ndjson holds them as they came. forget: see Batcher; right for the strategies NONE and WINDOW.
    """
    rows = events.select("batch_key", "arrival", F.col("raw").cast("binary").alias("raw"), *(["window_complete"] if "window_complete" in events.columns else []))
    made = rows.groupBy("batch_key").transformWithStateInPandas(Batcher(limits, forget), OUT, "append", "ProcessingTime")
    return made.withColumn("ndjson", F.col("ndjson").cast("string"))


def write_batches(batches: DataFrame, path: str, checkpoint: str, **options: str):
    """Starts a query that writes each micro-batch under its own number, so that a replay replaces it and adds no file."""

    def sink(df: DataFrame, number: int) -> None:
        df.withColumn("written_ts", F.lit(time.time()).cast("timestamp")).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return batches.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**options).start()
