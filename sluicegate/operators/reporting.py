"""Counters, latencies, close reasons and output attributes."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from time import monotonic

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from sluicegate.plans.analysis import compile_rules

#: Samples that a latency summary looks back on.
SAMPLES = 2048
PREFIX = "beats."
#: Names of output attributes, without PREFIX.
BASIC = """active.connections pending.records pending.bytes pressure.paused ack.failures queue.age.avg.ms queue.age.max.ms
commit.latency.avg.ms commit.latency.max.ms ack.latency.avg.ms ack.latency.max.ms disconnected.before.commit disconnected.after.commit
filter.mode filter.rules.configured filter.rules.indexed filter.rules.unindexed filter.paths.referenced filter.paths.anchors
filter.paths.batch filter.candidate.rules.avg filter.rules.evaluated.avg filter.json.passes.avg filter.values.extracted.avg
filter.events.input filter.events.kept filter.events.dropped filter.bytes.dropped filter.evaluation.errors""".split()
FULL = """active.batches ready.batches claimed.batches processing.tasks processing.bytes partial.frame.reserved.bytes deferred.frames
accept.paused ack.sent queue.age.p50.ms queue.age.p95.ms queue.age.p99.ms commit.latency.p50.ms commit.latency.p95.ms
commit.latency.p99.ms ack.latency.p50.ms ack.latency.p95.ms ack.latency.p99.ms events.accepted.per.second events.committed.per.second
payload.accepted.bytes.per.second payload.committed.bytes.per.second keepalive.sent keepalive.failures ack.write.timeouts
ack.write.pending frame.assembly.timeouts processing.executor.pending.tasks processing.executor.hottest.queue
processing.executor.rejections cleanup.pending.tasks cleanup.pending.tasks.max cleanup.rejections cleanup.emergency.submitted
cleanup.pressure.active tls.handshakes.current tls.handshakes.peak tls.handshake.timeouts tls.handshake.latency.p50.ms
tls.handshake.latency.p95.ms tls.handshake.latency.p99.ms first.byte.timeouts idle.connection.timeouts event.loop.lag.current.ms
event.loop.lag.max.ms event.loop.lag.over.50ms event.loop.lag.over.100ms event.loop.lag.over.1000ms filter.events.evaluated
filter.candidate.rules.selected filter.rule.evaluations filter.json.passes filter.values.extracted""".split()


def latency_summary(samples: DataFrame, value: str, order: str) -> DataFrame:
    """count, mean (whole), max of all values; p50, p95, p99 by nearest rank over the last SAMPLES in order."""
    overall = samples.agg(F.count(value).alias("count"), F.floor(F.avg(value)).cast("long").alias("mean"), F.max(value).alias("max"))
    last = samples.where(F.col(value).isNotNull()).orderBy(F.desc(order), F.desc(value)).limit(SAMPLES)
    rank = last.selectExpr(*[f"cast(percentile_disc({p}) within group (order by `{value}`) as long) as p{round(p * 100)}" for p in (0.5, 0.95, 0.99)])
    return overall.crossJoin(rank)  # one row each


def rates(totals: DataFrame, seconds: float) -> DataFrame:
    """Every numeric column of a row of totals over the seconds of a lifetime."""
    kinds = dict(totals.dtypes)
    return totals.select(*[(F.col(c) / F.lit(max(seconds, 1e-9))).alias(f"{c}_per_second") for c, k in kinds.items() if k in ("bigint", "int", "double")])


def close_reason(message: Column) -> Column:
    """The reason that the text of a protocol error tells; null: an unknown violation."""
    m = F.lower(F.coalesce(message, F.lit("")))
    has = lambda *words: F.greatest(*[m.contains(w) for w in words], F.lit(False))
    too_much = has("maximum", "too large", "exceed")
    return (
        F.when(m.contains("frame") & has("maximum", "too large", "exceeds"), "FRAME_TOO_LARGE")
        .when(m.contains("window") & too_much, "WINDOW_TOO_LARGE")
        .when(has("outstanding unacknowledged", "per-connection maximum"), "PER_CONNECTION_MEMORY_LIMIT")
        .when(has("did not complete within", "assembly timeout"), "PARTIAL_FRAME_TIMEOUT")
        .otherwise("PROTOCOL_VIOLATION")
    )


def filter_metrics(decisions: DataFrame, raw: str = "raw") -> DataFrame:
    """One row of counters over the decisions of a filter; each event counts once, however often its task ran."""
    size = F.octet_length(raw).cast("long")
    return decisions.agg(
        F.count(F.lit(1)).alias("filter_events_input"),
        F.count_if(~F.col("drop")).alias("filter_events_kept"),
        F.count_if("drop").alias("filter_events_dropped"),
        F.coalesce(F.sum(F.when(F.col("drop"), size)), F.lit(0)).alias("filter_bytes_dropped"),
        F.count_if("evaluation_error").alias("filter_evaluation_errors"),
    )


def filter_averages(decisions: DataFrame, rules: Mapping[str, str], batch_paths: int = 0) -> DataFrame:
    """One row of means over the events that rules were tried on, by the names of the output attributes with _ for a dot.

    decisions: of apply_filter over events with the candidates of filter.candidates. An event's candidates are the indexed rules
    that its values point to and all rules without an index; it was tried on those up to the one that dropped it. It is
    read in one pass, which takes a value for each path of the rules and of the batch key.
    """
    found = compile_rules(rules)
    place = F.coalesce(F.create_map(*[F.lit(x) for i, r in enumerate(found.rules) for x in (r.name, i)])[F.col("rule_name")], F.lit(len(found.rules))) if found.rules else F.lit(0)
    without = F.array(*[F.lit(i) for i, r in enumerate(found.rules) if not r.indexed]).cast("array<int>")
    tried = F.array_distinct(F.concat("candidates", without))
    read = decisions.where("valid").select(F.size(tried).alias("candidates"), F.size(F.filter(tried, lambda i: i <= place)).alias("evaluated"))
    return read.agg(
        F.avg("candidates").alias("filter_candidate_rules_avg"),
        F.avg("evaluated").alias("filter_rules_evaluated_avg"),
        F.avg(F.lit(1.0)).alias("filter_json_passes_avg"),
        F.avg(F.lit(float(len(found.paths) + batch_paths))).alias("filter_values_extracted_avg"),
    )


def log_line(metrics: Mapping[str, object]) -> str:
    """One line of all metrics, by name."""
    return "listener metrics: " + ", ".join(f"{k}={v}" for k, v in sorted(metrics.items()))


class MetricsLog(StreamingQueryListener):
    """Logs a line of metrics after a micro-batch, every interval seconds at most: spark.streams.addListener(MetricsLog(source.metrics))."""

    def __init__(self, metrics: Callable[[], Mapping[str, object]] = dict, interval: float = 30.0, log: Callable[[str], None] = logging.getLogger("sluicegate").info) -> None:
        self.metrics, self.interval, self.log, self.last = metrics, interval, log, float("-inf")

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        if monotonic() - self.last >= self.interval:
            self.last, p = monotonic(), event.progress
            self.log(log_line({"batch": p.batchId, "rows": p.numInputRows, "rows.per.second": round(p.processedRowsPerSecond or 0.0, 1), **self.metrics()}))

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def batch_metrics(batches: DataFrame) -> DataFrame:
    """(flush_reason, batches, events, payload_bytes)."""
    return batches.groupBy("flush_reason").agg(F.count(F.lit(1)).alias("batches"), F.sum(F.col("event_count").cast("long")).alias("events"), F.sum("payload_bytes").alias("payload_bytes"))


def attributes(batches: DataFrame, strategy: str, port: int, detail: str = "BASIC", metrics: dict[str, object] | None = None, rule_matches: dict[str, int] | None = None, closes: dict[str, int] | None = None) -> DataFrame:
    """batches with attributes (MAP) and transit_uri.

    detail: NONE, BASIC or FULL; metrics: values by attribute name without its prefix, 0 where absent. What is not the
    same for all events of a batch has no attribute.
    """
    known, given = {}, metrics or {}
    for name in {"NONE": [], "BASIC": BASIC, "FULL": [*BASIC, *FULL]}[detail]:
        x = given.get(name, 0)
        known[PREFIX + name] = str(x).lower() if isinstance(x, bool) else str(x)
    if detail == "FULL":
        safe = lambda s: "".join(c if c.isalnum() or c in "_.-" else "_" for c in s)
        known |= {f"{PREFIX}filter.rule.{safe(k)}.matches": str(n) for k, n in (rule_matches or {}).items()}
        known |= {f"{PREFIX}connections.closed.reason.{k}": str(n) for k, n in (closes or {}).items() if n}
    one_conn, one_window = F.col("conn_id").isNotNull(), F.col("window_id").isNotNull()
    text = lambda c: F.col(c).cast("string")
    base = {
        "mime.type": F.lit("application/x-ndjson"),
        f"{PREFIX}protocol.version": F.lit("2"),
        f"{PREFIX}event.count": text("event_count"),
        f"{PREFIX}uncompressed.bytes": text("payload_bytes"),
        f"{PREFIX}encoded.bytes": text("encoded_bytes"),
        f"{PREFIX}batch.strategy": F.lit(strategy),
        f"{PREFIX}batch.key": text("batch_key"),
        f"{PREFIX}batch.flush.reason": text("flush_reason"),
        f"{PREFIX}ack.policy": F.lit("AFTER_SESSION_COMMIT"),
        "record.count": text("event_count"),
        f"{PREFIX}listener.port": F.lit(str(port)),
        **{k: F.lit(x) for k, x in known.items()},
        f"{PREFIX}sender": text("remote_address"),
        f"{PREFIX}sender.port": F.when(one_conn, text("remote_port")),
        f"{PREFIX}window.id": F.when(one_window, text("window_id")),
        f"{PREFIX}sequence.first": F.when(one_window, text("first_sequence")),
        f"{PREFIX}sequence.last": F.when(one_window, text("last_sequence")),
        f"{PREFIX}tls.client.subject": F.when(one_conn, F.col("tls_subject")),
        f"{PREFIX}tls.client.issuer": F.when(one_conn & F.col("tls_subject").isNotNull(), F.col("tls_issuer")),
    }
    made = F.create_map(*[x for k, c in base.items() for x in (F.lit(k), c)])
    uri = F.concat(F.lit("beats://"), F.coalesce("remote_address", F.lit("multiple")), F.lit(f":{port}"))
    return batches.withColumn("attributes", F.map_filter(made, lambda _, x: x.isNotNull())).withColumn("transit_uri", uri)
