import datetime as dt

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sluicegate.operators import batching, keys, ledger
from sluicegate.operators.batching import Limits, Open, runs


def slow(sizes, ends, at, limits):
    """The rules of a batch, event by event."""
    out, number, held, size, created, last = [], 0, [], 0, 0, 0

    def flush(reason):
        nonlocal number, held, size
        out.append((number, tuple(held), reason))
        number, held, size = number + 1, [], 0

    for i, (n, end, t) in enumerate(zip(sizes, ends, at)):
        if held and limits.timers and t >= min(created + limits.age, last + limits.idle):
            flush("maximum-age" if created + limits.age <= last + limits.idle else "idle")
        if held and size + n > limits.bytes:
            flush("byte-count")
        if not held:
            created = t
        held.append(i)
        size, last = size + n, t
        if limits.strategy == "NONE":
            flush("none")
        elif limits.strategy == "WINDOW" and end:
            flush("window-boundary")
        elif len(held) >= limits.events:
            flush("event-count")
        elif size >= limits.bytes:
            flush("byte-count")
    if held:
        out.append((number, tuple(held), None))
    return out


def fast(sizes, ends, at, limits, cut):
    held, groups, reasons = Open(), {}, {}
    for a, b in ((0, cut), (cut, len(sizes))):
        for number, start, to, reason in runs(np.array(sizes[a:b], dtype=np.int64), np.array(ends[a:b], dtype=bool), np.array(at[a:b], dtype=np.int64), limits, held):
            groups.setdefault(number, []).extend(range(a + start, a + to))
            reasons[number] = reason
    return [(n, tuple(groups[n]), reasons[n]) for n in groups]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.booleans(), st.integers(0, 5)), max_size=30), st.integers(1, 5), st.integers(1, 12), st.integers(1, 12), st.integers(1, 6), st.sampled_from(["NONE", "WINDOW", "SIZE_TIME"]), st.booleans(), st.integers(0, 30))
def test_runs_follow_the_rules(rows, most, size, age, idle, strategy, timers, cut):
    sizes, ends, steps = zip(*rows) if rows else ((), (), ())
    at = np.cumsum(steps).tolist()
    limits = Limits(most, size, age, idle, strategy, timers)
    assert fast(sizes, ends, at, limits, min(cut, len(sizes))) == slow(sizes, ends, at, limits)


def events(spark, rows):
    t = dt.datetime(2024, 1, 1)
    data = [(c, s, w, done, "h", 1, None, None, t, raw, i) for i, (c, s, w, done, raw) in enumerate(rows)]
    return spark.createDataFrame(data, "conn_id string, sequence long, window_id long, window_complete boolean, remote_address string, remote_port int, tls_subject string, tls_issuer string, received_ts timestamp, raw string, arrival long")


def test_byte_guard(spark):
    e = events(spark, [("c", i, 1, False, "x" * n) for i, n in enumerate([5, 5, 5, 20, 1, 9, 1])])
    got = batching.assign_batches(keys.with_batch_key(e, "SIZE_TIME"), Limits(bytes=10, timers=False), closing=None).orderBy("arrival").collect()
    assert [r.batch_no for r in got] == [0, 0, 1, 2, 3, 3, 4]
    assert [r.flush_reason for r in got] == ["byte-count"] * 6 + [None]


def test_batches_keep_bytes_and_runs(spark):
    top = 2**32
    rows = [("c", top - 2, 1, False, '{"a":1}'), ("c", top - 1, 1, False, '{\n"b":2}'), ("c", 0, 1, False, "x"), ("c", 1, 1, True, "ß"), ("d", 7, 1, False, "y")]
    got = batching.collect_batches(batching.assign_batches(keys.with_batch_key(events(spark, rows), "CONNECTION"), Limits(timers=False))).orderBy("batch_key").collect()
    assert got[0].ndjson == '{"a":1}\n{\n"b":2}\nx\nß\n'
    assert [(r.first_seq, r["count"]) for r in got[0].runs] == [(top - 2, 4)]
    assert (got[0].payload_bytes, got[0].encoded_bytes, got[0].event_count) == (18, 22, 4)
    assert (got[0].first_sequence, got[0].last_sequence, got[0].remote_address) == (top - 2, 1, "h")


def test_keys(spark):
    e = events(spark, [("c", 1, 1, False, '{"a":" ","b":"x"}'), ("c", 2, 1, False, '{"a":"p","b":"q"}'), ("d", 3, 1, False, "broken"), ("d", 4, 1, False, '{"a":"p","b":"q"}')])
    got = keys.with_batch_key(e, "JSON_KV", ["/a", "/b"]).orderBy("arrival").collect()
    assert [(r.sequence, r.batch_key) for r in got] == [(1, "_missing"), (2, "p\u001fq")]
    assert [r.sequence for r in keys.with_batch_key(e, "JSON_KV", ["/a"], missing="REJECT").collect()] == []
    long = keys.with_batch_key(e.withColumn("conn_id", e.raw), "CONNECTION", max_bytes=10).orderBy("arrival").first()
    assert len(long.batch_key) == 64


def frames(spark, rows):
    return spark.createDataFrame([(c, i, k, w, s) for i, (c, k, w, s) in enumerate(rows)], "conn_id string, frame_no long, type string, window_size long, sequence long")


def test_windows(spark):
    ok = [("a", "W", 2, None), ("a", "J", None, 4294967295), ("a", "J", None, 0), ("a", "W", 0, None), ("a", "W", 1, None), ("a", "J", None, 9)]
    gap = [("b", "W", 3, None), ("b", "J", None, 1), ("b", "J", None, 3), ("c", "J", None, 1), ("d", "W", 2, None), ("d", "J", None, 1), ("d", "W", 1, None), ("e", "W", 5000, None)]
    got = ledger.assign_windows(frames(spark, ok + gap), cut=False).orderBy("frame_no").collect()
    assert [r.window_complete for r in got if r.conn_id == "a" and r.type == "J"] == [False, True, True]
    errors = {r.conn_id: r.ledger_error for r in got if r.ledger_error}
    assert errors == {"b": "sequence gap", "c": "event before window", "d": "previous window incomplete", "e": "window exceeds maximum"}
    kept = ledger.assign_windows(frames(spark, ok + gap)).groupBy("conn_id").count().collect()
    assert {r.conn_id: r["count"] for r in kept} == {"a": 6, "b": 2, "d": 2}


def test_frontier(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", 1, 0, 5, True), ("a", 1, 1, 6, True), ("a", 3, 0, 8, True), ("a", 3, 1, 9, False), ("b", 1, 0, 1, False), ("b", 1, 1, 2, True), ("c", 1, 0, 1, True), ("c", 2, 0, 2, True)]
    own = spark.createDataFrame([(*r, t) for r in rows], "conn_id string, window_id long, offset long, sequence long, committed boolean, received_ts timestamp")
    windows = spark.createDataFrame([("a", 1, 2), ("a", 2, 0), ("a", 3, 2), ("b", 1, 2), ("c", 1, 2), ("c", 2, 1)], "conn_id string, window_id long, advertised long")
    got = ledger.frontier(own, windows).orderBy("conn_id", "ack_no").collect()
    assert [(r.conn_id, r.window_id, r.ack_sequence, r.events_advanced) for r in got] == [("a", 1, 6, 2), ("a", 2, 0, 0), ("a", 3, 8, 1), ("c", 1, 1, 1)]
    assert bytes(got[0].ack) == b"2A\x00\x00\x00\x06"
    runs_ = spark.createDataFrame([("b", 1, 1, 9), ("z", 1, 1, 1)], "conn_id string, window_id long, first_seq long, count long")
    assert ledger.commit(own, runs_).where("conn_id = 'b' and committed").count() == 2


def test_claims_are_resolved_once(spark):
    from sluicegate.operators import claims

    ready = spark.createDataFrame([(i, 1, 10) for i in range(1, 7)], "ready_no long, event_count int, payload_bytes long")
    own = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "claim_id string, ready_no long")
    said = spark.createDataFrame([("a", "ROLLBACK_CONFIRMED", 1), ("a", "COMMIT_CONFIRMED", 2), ("b", "COMMIT_CONFIRMED", 1), ("z", "ABANDONED", 1), (None, "ABANDONED", 1), ("c", "odd", 0)], "claim_id string, state string, at long")
    state = claims.resolved(own, said)
    assert {(r.claim_id, r.state) for r in state.collect()} == {("a", "ROLLBACK_CONFIRMED"), ("b", "COMMIT_CONFIRMED"), ("c", "CLAIMED")}
    assert [r.ready_no for r in claims.next_claim(ready, state, "d", 3).orderBy("ready_no").collect()] == [1, 2, 5]
    again = claims.resolved(own.where("false"), said)
    assert again.count() == 0 and claims.queue(ready, again).count() == 6
    # a batch that was given back and claimed once more
    both = state.select("claim_id", "ready_no", "state").union(spark.createDataFrame([("d", 1, "CLAIMED")], "claim_id string, ready_no long, state string"))
    assert claims.queue(ready, both).orderBy("ready_no").first().ready_no == 2


def test_metrics_log():
    from types import SimpleNamespace

    from sluicegate.operators import reporting

    lines = []
    own = reporting.MetricsLog(lambda: {"ack.sent": 3}, 3600, lines.append)
    for i in range(2):
        own.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(batchId=i, numInputRows=5, processedRowsPerSecond=1.26)))
    assert lines == ["listener metrics: ack.sent=3, batch=0, rows=5, rows.per.second=1.3"]


def test_active_keys_are_limited(spark):
    rng = np.random.default_rng(1)
    rows = [(f"k{rng.integers(5)}", i, "x" * int(rng.integers(1, 9)), bool(rng.random() < 0.2), int(t)) for i, t in enumerate(np.cumsum(rng.integers(0, 30, 300)))]
    df = spark.createDataFrame(rows, "batch_key string, arrival long, raw string, window_complete boolean, t long").selectExpr("*", "timestamp_micros(t) as received_ts")
    for strategy in ("SIZE_TIME", "WINDOW", "NONE"):
        limits = Limits(events=6, bytes=30, age=150, idle=60, strategy=strategy)
        kinds = {}
        for name, got in (("free", batching.assign_batches(df, limits)), ("limited", batching.assign_limited(df, limits, 9))):
            groups = {}
            for r in got.collect():
                groups.setdefault((r.batch_key, r.batch_no), []).append((r.arrival, r.flush_reason))
            kinds[name] = sorted(sorted(g) for g in groups.values())
        for free, limited in zip(kinds["free"], kinds["limited"], strict=True):  # at the end other keys' events let time pass
            assert free == limited or (free[0][1] == "service-disabled" and [x for x, _ in free] == [x for x, _ in limited])
    few = batching.assign_limited(df, Limits(events=100, timers=False), 2).orderBy("arrival").collect()
    open_, seen = [], {}
    for r in few:  # the key that was opened first makes room
        if r.batch_key not in open_:
            open_ = [*open_[-1:], r.batch_key] if len(open_) == 2 else [*open_, r.batch_key]
            seen[r.batch_key] = r.batch_no
        assert seen[r.batch_key] == r.batch_no
    assert {r.flush_reason for r in few} == {"active-key-limit", "service-disabled"}
    assert batching.assign_limited(df.where("false")).count() == 0
