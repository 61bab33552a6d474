"""The settings of a listener, with their defaults and the checks between them."""

from __future__ import annotations

from dataclasses import dataclass, field

from sluicegate.operators.batching import Limits
from sluicegate.operators.filter import POLICIES
from sluicegate.operators.keys import STRATEGIES, needed_pointers
from sluicegate.plans.analysis import compile_rules
from sluicegate.sources.framing import FrameLimits

KB, MB, GB = 1024, 1024**2, 1024**3
#: Names and defaults of the settings; sizes in bytes, times in milliseconds.
DEFAULTS: dict[str, object] = {
    "listening-port": 5044, "local-interface": None, "worker-threads": 8, "event-processing-threads": 8, "event-processing-queue-capacity": 1024,
    "event-processing-queue-high-water-percent": 70, "event-processing-queue-low-water-percent": 40, "maximum-event-processing-bytes": 256 * MB,
    "cleanup-worker-threads": 4, "maximum-cleanup-pending-tasks": 60_000, "cleanup-queue-high-water-percent": 70, "cleanup-queue-low-water-percent": 40,
    "socket-receive-buffer": 64 * KB, "receive-frame-buffer": 64 * KB, "listen-backlog": 8192, "tcp-keepalive": True, "first-protocol-byte-timeout": 30_000,
    "idle-timeout": 0, "frame-assembly-timeout": 30_000, "event-loop-lag-probe-interval": 100, "maximum-connections": 30_000,
    "maximum-connections-per-source": 1000, "maximum-connection-attempts-per-second": 100_000, "maximum-connection-attempts-per-source-per-second": 0,
    "maximum-protocol-frames-per-second": 100_000, "pooled-direct-buffers": True, "ssl-context-service": None, "client-authentication": "NONE",
    "tls-handshake-timeout": 10_000, "maximum-concurrent-handshakes": 256, "maximum-frame-size": 16 * MB, "maximum-compressed-frame-size": 8 * MB,
    "maximum-decompressed-size": 64 * MB, "maximum-compression-ratio": 100, "maximum-frames-per-compressed-envelope": 10_000,
    "maximum-events-per-window": 4096, "maximum-outstanding-events-per-connection": 16_384, "maximum-outstanding-bytes-per-connection": 32 * MB,
    "ack-write-timeout": 15_000, "protocol-keepalive-interval": 0, "maximum-queued-events": 250_000, "maximum-queued-bytes": GB,
    "queue-high-water-percent": 80, "queue-low-water-percent": 60, "event-filtering": "DISABLED", "filter-evaluation-error-policy": "KEEP_EVENT",
    "dropped-event-audit-mode": "COUNTERS_ONLY", "maximum-filter-rules": 500, "maximum-unindexed-filter-rules": 25, "batching-strategy": "SIZE_TIME",
    "json-batch-key": "", "missing-key-policy": "DEFAULT_BUCKET", "default-batch-bucket": "_missing", "maximum-batch-key-length": 256,
    "hash-batch-keys": False, "maximum-active-batch-keys": 2048, "batch-coordinator-partitions": 16, "maximum-events-per-batch": 10_000,
    "maximum-bytes-per-batch": 8 * MB, "maximum-batch-age": 1000, "maximum-batch-idle-time": 250, "maximum-ready-batches": 2048,
    "shutdown-drain-timeout": 30_000, "metrics-attribute-detail": "BASIC", "metrics-log-interval": 30_000,
}


@dataclass(frozen=True)
class Settings:
    """given: settings that differ from the defaults; rules: expressions by name. Wrong ones raise ValueError."""

    given: dict[str, object] = field(default_factory=dict)
    rules: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if unknown := set(self.given) - set(DEFAULTS):
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        wrong = [said for holds, said in self._checks() if not holds]
        if wrong:
            raise ValueError("; ".join(wrong))
        compile_rules(self.rules, self["maximum-filter-rules"], self["maximum-unindexed-filter-rules"])
        needed_pointers(self["batching-strategy"], self.pointers)

    def __getitem__(self, name: str):
        return self.given.get(name, DEFAULTS[name])

    def _checks(self) -> list[tuple[bool, str]]:
        low_high = [(n, n.replace("low", "high")) for n in DEFAULTS if n.endswith("low-water-percent")]
        return [
            *((self[low] < self[high], f"{low} must be below {high}") for low, high in low_high),
            (self["maximum-compressed-frame-size"] <= self["maximum-decompressed-size"], "compressed frames may not be larger than inflated ones"),
            (self["maximum-outstanding-events-per-connection"] >= self["maximum-events-per-window"], "outstanding events must hold a window"),
            (self["maximum-outstanding-bytes-per-connection"] >= self["maximum-frame-size"], "outstanding bytes must hold a frame"),
            (self["maximum-bytes-per-batch"] <= self["maximum-queued-bytes"], "a batch may not be larger than the queue"),
            (self["maximum-ready-batches"] <= self["maximum-queued-events"], "more ready batches than queued events"),
            (self["client-authentication"] == "NONE" or self["ssl-context-service"] is not None, "client authentication needs TLS"),
            (self["batching-strategy"] in STRATEGIES, "unknown batching strategy"),
            (self["filter-evaluation-error-policy"] in POLICIES, "unknown error policy"),
            (self["event-filtering"] in ("DISABLED", "DROP_MATCHING"), "unknown filtering mode"),
            (self["metrics-attribute-detail"] in ("NONE", "BASIC", "FULL"), "unknown attribute detail"),
        ]

    @property
    def pointers(self) -> list[str]:
        return [p.strip() for p in str(self["json-batch-key"]).split(",") if p.strip()]

    @property
    def active_rules(self) -> dict[str, str]:
        return self.rules if self["event-filtering"] == "DROP_MATCHING" else {}

    @property
    def frame_limits(self) -> FrameLimits:
        names = ("maximum-frame-size", "maximum-compressed-frame-size", "maximum-decompressed-size", "maximum-compression-ratio", "maximum-frames-per-compressed-envelope")
        return FrameLimits(*(self[n] for n in names))

    @property
    def batch_limits(self) -> Limits:
        ms = 1000
        return Limits(self["maximum-events-per-batch"], self["maximum-bytes-per-batch"], self["maximum-batch-age"] * ms, self["maximum-batch-idle-time"] * ms, self["batching-strategy"])
