import pytest

from sluicegate.config import DEFAULTS, Settings
from sluicegate.engine import process
from sluicegate.sources import framing as f


def test_settings():
    assert len(DEFAULTS) == 65
    for wrong in ({"queue-low-water-percent": 90}, {"batching-strategy": "JSON_KV"}, {"client-authentication": "REQUIRED"}, {"maximum-events-per-window": 1 << 20}, {"none": 1}):
        with pytest.raises(ValueError):
            Settings(wrong)


def test_captures_to_acknowledgements(spark):
    one = f.window(3) + b"".join(f.event(i, b'{"k":%d,"t":"a"}' % i) for i in (1, 2, 3)) + f.window(0)
    two = f.envelope(f.window(2) + f.event(7, b'{"k":7,"t":"b"}') + f.event(9, b"{}"))
    captures = spark.createDataFrame([("x", "c1", one), ("x", "c2", two)], "capture_id string, conn_id string, data binary")
    settings = Settings({"event-filtering": "DROP_MATCHING", "batching-strategy": "JSON_KV", "json-batch-key": "/t"}, {"third": "k == 3"})
    got = process(captures, settings)
    batches = {r.batch_key: r for r in got.batches.collect()}
    assert {k: (r.event_count, r.ndjson) for k, r in batches.items()} == {"a": (2, '{"k":1,"t":"a"}\n{"k":2,"t":"a"}\n'), "b": (1, '{"k":7,"t":"b"}\n')}
    assert batches["a"].attributes["beats.sequence.last"] == "2" and batches["a"].attributes["record.count"] == "2"
    assert [(r.conn_id, r.window_id, r.ack_sequence) for r in got.acks.orderBy("conn_id", "window_id").collect()] == [("c1", 1, 3), ("c1", 2, 0), ("c2", 1, 7)]


def test_bytes_that_are_no_text(spark):
    """An event that isn't UTF-8 keeps its bytes; with rules the policy decides."""
    sent = [b'{"k":1}', b'{"k":"\xff\xfe"}', b'{"k":3}']
    data = f.window(3) + b"".join(f.event(i, x) for i, x in enumerate(sent))
    captures = spark.createDataFrame([("x", "c1", data, "n1")], "capture_id string, conn_id string, data binary, listener string")
    for policy, rules, kept in (("KEEP_EVENT", {}, sent), ("KEEP_EVENT", {"r": "k == 3"}, sent[:2]), ("DROP_EVENT", {"r": "k == 3"}, sent[:1]), ("CLOSE_CONNECTION", {"r": "k == 3"}, sent[:1])):
        settings = Settings({"event-filtering": "DROP_MATCHING", "filter-evaluation-error-policy": policy}, rules)
        got = process(captures, settings, {"pending.records": 7})
        rows = got.batches.selectExpr("cast(ndjson as binary) as ndjson", "listener", "attributes").collect()
        assert [bytes(r.ndjson) for r in rows] == [b"".join(x + b"\n" for x in kept)] and rows[0].listener == "n1" and rows[0].attributes["beats.pending.records"] == "7"
        assert [(r.conn_id, r.ack_sequence) for r in got.acks.collect()] == [("c1", 0 if policy == "CLOSE_CONNECTION" else 2)]


def test_listeners_batch_apart(spark):
    rows = [(f"{n}{i}", f"c{n}{i}", f.window(1) + f.event(1, b"{}"), f"n{n}", "h") for n in range(2) for i in range(2)]
    captures = spark.createDataFrame(rows, "capture_id string, conn_id string, data binary, listener string, remote_address string")
    got = process(captures, Settings()).batches.collect()
    assert sorted((r.listener, r.batch_key, r.event_count, r.remote_address) for r in got) == [("n0", "all", 2, "h"), ("n1", "all", 2, "h")]
    settings = Settings({"batching-strategy": "CONNECTION", "maximum-active-batch-keys": 1})
    limited = process(captures, settings, limit_active=True).batches.collect()
    assert sorted((r.listener, r.batch_key, r.flush_reason) for r in limited) == [("n0", "c00", "active-key-limit"), ("n0", "c01", "service-disabled"), ("n1", "c10", "active-key-limit"), ("n1", "c11", "service-disabled")]
