import socket
import ssl
import subprocess
import time

import pytest
from pyspark.sql import functions as F

from sluicegate.sources import framing as f
from sluicegate.sources.listener import Admission, Listener, ListenerLimits, ShipperSource, _Reader, tls_context
from sluicegate.sources.session import Session, SessionLimits


def until(holds, seconds=20):
    end = time.time() + seconds
    while not holds():
        assert time.time() < end
        time.sleep(0.01)


@pytest.fixture
def listen():
    made = []

    def start(**options):
        made.append(Listener(**options))
        return made[-1]

    yield start
    for own in made:
        own.close()


def connect(own):
    return socket.create_connection(("127.0.0.1", own.port), timeout=10)


def receive(s, n):
    out = b""
    while len(out) < n and (part := s.recv(n - len(out))):
        out += part
    return out


def test_acknowledgements_follow_windows_in_order():
    s = Session()
    assert s.opened(2) == [] and s.received(4294967295, 1) == (1, 0, False) and s.received(0, 1) == (1, 1, True)
    assert s.opened(0) == [] and s.opened(3) == []
    for i in range(3):
        s.received(10 + i, 1)
    s.committed(3, 0)
    s.committed(3, 2)
    assert s.acks() == [] and s.keepalive is None
    s.committed(1, 0)
    assert s.acks() == [4294967295] and s.keepalive == 4294967295 and s.acks() == []
    s.committed(1, 1)
    s.committed(1, 1)
    assert s.acks() == [0, 0, 10] and s.keepalive == 10
    s.committed(3, 1)
    assert s.acks() == [12] and s.keepalive is None and not s.sizes and not s.bytes
    assert s.opened(0) == [0]


@pytest.mark.parametrize("steps", [["w5"], ["e1"], ["w2", "e1", "e3"], ["w2", "e1", "w1"], ["w1", "e1", "e2"], ["w4", "e1", "e2", "e3", "e4"]])
def test_broken_rules(steps):
    s = Session(SessionLimits(window=4, events=3))
    with pytest.raises(f.FrameError):
        for x in steps:
            s.opened(int(x[1:])) if x[0] == "w" else s.received(int(x[1:]), 1)


def test_bytes_of_a_connection():
    s = Session(SessionLimits(bytes=10))
    s.opened(3)
    s.received(1, 6)
    s.committed(1, 0)
    s.received(2, 10)
    with pytest.raises(f.FrameError):
        s.received(3, 1)


def test_admission_reasons():
    a = Admission(ListenerLimits(connections=4, per_source=2, attempts=3, attempts_per_source=2))
    assert [a.reason(x, 1.0) for x in "aaab"] == [None, None, "PER_SOURCE_CONNECTION_LIMIT", None]
    assert a.reason("c", 1.5) == "GLOBAL_CONNECTION_RATE_LIMIT" and a.reason("c", 2.0) is None
    assert a.reason("d", 2.0) == "GLOBAL_CONNECTION_LIMIT"
    a.closed("a")
    a.closed("a")
    assert a.reason("a", 2.0) is None and a.reason("a", 2.0) is None and a.reason("b", 3.0) == "GLOBAL_CONNECTION_LIMIT"
    a.closed("a")
    a.closed("a")
    assert a.reason("a", 4.0) is None
    a.closed("a")
    assert a.reason("a", 4.0) is None
    a.closed("a")
    assert a.reason("a", 4.0) == "PER_SOURCE_CONNECTION_RATE_LIMIT"


def test_listener_acknowledges_after_commit(listen):
    own = listen()
    with connect(own) as s:
        s.sendall(f.window(2) + f.event(7, b"a") + f.event(8, b"\xff") + f.window(0))
        until(lambda: own.end == 2)
        own.commit(2)  # nothing was given to a reader yet
        assert own.end == 2 and len(own.between(0, 2)) == 2
        assert [(*r[4:8], r[9]) for r in own.between(0, 2)] == [(1, 0, 7, False, b"a"), (1, 1, 8, True, b"\xff")]
        own.commit(1)
        assert receive(s, 6) == f.ack(7)
        own.keepalive()
        assert receive(s, 6) == f.ack(7)
        own.commit(2)
        assert receive(s, 12) == f.ack(8) + f.ack(0)
        assert own.between(0, 2) == [] and own.metrics()["events.committed"] == 2 and own.metrics()["active.connections"] == 1


def test_a_restart_loses_nothing(listen):
    """A checkpoint of an earlier life holds 5; of seven events sent now none is skipped, and none is acknowledged before its commit."""
    own = listen()
    reader = _Reader(lambda: own)
    old = {"life": "earlier", "event": 5}
    with connect(own) as s:
        s.sendall(f.window(7) + b"".join(f.event(i, b"%d" % i) for i in range(1, 8)))
        until(lambda: own.end == 7)
        assert list(reader.readBetweenOffsets({"life": "earlier", "event": 0}, old)) == []
        reader.commit(old)
        rows, end = reader.read(old)
        assert [r[-1] for r in rows] == [b"%d" % i for i in range(1, 8)]
        assert [r[-1] for r in reader.readBetweenOffsets(old, end)] == [b"%d" % i for i in range(1, 8)]
        reader.commit(end)
        assert receive(s, 6) == f.ack(7)


def test_protocol_errors_close_a_connection(listen):
    own = listen(session=SessionLimits(window=10), limits=ListenerLimits(first_byte=0.3, assembly=0.3, idle=0.3, frames=50))
    sent = {
        f.window(2) + f.event(1, b"a") + f.event(3, b"b"): "PROTOCOL_VIOLATION", f.window(11): "WINDOW_TOO_LARGE", b"9": "PROTOCOL_VIOLATION",
        b"": "FIRST_BYTE_TIMEOUT", f.window(1)[:3]: "PARTIAL_FRAME_TIMEOUT", f.window(0): "IDLE_TIMEOUT", f.window(0) * 60: "FRAME_RATE_LIMIT",
    }
    for data, reason in sent.items():
        before = own.closes[reason]
        with connect(own) as s:
            s.sendall(data)
            until(lambda: own.closes[reason] == before + 1)
    own.limits = own.admission.limits = ListenerLimits(connections=0)
    with connect(own) as s:
        assert s.recv(1) == b"" and own.closes["GLOBAL_CONNECTION_LIMIT"] == 1


def test_a_full_queue_holds_senders_up(listen):
    own = listen(limits=ListenerLimits(queued_events=10))
    with connect(own) as s:
        s.sendall(f.window(9) + b"".join(f.event(i, b"x") for i in range(9)))
        until(lambda: own.paused)
        s.sendall(f.window(1) + f.event(9, b"y"))
        time.sleep(0.1)
        own.between(0, 9)
        own.commit(9)
        assert receive(s, 6) == f.ack(8)
        until(lambda: own.end == 10)
        assert not own.paused


def test_tls(listen, tmp_path):
    done = subprocess.run(["openssl", "req", "-x509", "-newkey", "rsa:2048", "-nodes", "-keyout", "k", "-out", "c", "-days", "2", "-subj", "/CN=localhost"], cwd=tmp_path, capture_output=True)
    if done.returncode:
        pytest.skip("no certificate can be made here")
    own = listen(tls=tls_context(str(tmp_path / "c"), str(tmp_path / "k")))
    trust = ssl.create_default_context(cafile=str(tmp_path / "c"))
    with trust.wrap_socket(connect(own), server_hostname="localhost") as s:
        s.sendall(f.window(1) + f.event(1, b"secret"))
        until(lambda: own.end == 1)
        own.between(0, 1)
        own.commit(1)
        assert receive(s, 6) == f.ack(1)


def test_stream_delivers_and_acknowledges_over_a_restart(spark, tmp_path):
    spark.dataSource.register(ShipperSource)
    with socket.socket() as free:
        free.bind(("127.0.0.1", 0))
        port = free.getsockname()[1]
    out, seen = str(tmp_path / "out"), 0
    for life in range(2):
        events = spark.readStream.format("shipper").option("port", port + life).load()
        query = events.select("sequence", F.col("raw").cast("string").alias("raw")).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "check")).start()
        try:
            for _ in range(300):
                try:
                    s = socket.create_connection(("127.0.0.1", port + life), timeout=60)
                    break
                except OSError:
                    assert query.exception() is None
                    time.sleep(0.1)
            with s:
                for i in range(3):
                    s.sendall(f.window(2) + f.event(2 * i + 1, b"a%d" % seen) + f.event(2 * i + 2, b"b%d" % seen))
                    told = b""
                    while f.ack(2 * i + 2) not in told:  # perhaps after one of the first event alone
                        told += receive(s, 6)
                        s.sendall(b"")
                    seen += 1
        finally:
            query.stop()
    got = sorted(r.raw for r in spark.read.parquet(out).collect())
    assert got == sorted(f"{x}{i}" for x in "ab" for i in range(6))
