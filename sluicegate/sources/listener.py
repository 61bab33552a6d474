"""A TCP listener as a streaming source: frames in, acknowledgements out after a batch is committed."""

from __future__ import annotations

import asyncio
import ssl
import threading
import uuid
from collections import Counter, deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from time import monotonic, time

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

from sluicegate.sources.framing import Decoder, FrameError, FrameLimits, ack
from sluicegate.sources.session import Session, SessionLimits

SCHEMA = "arrival long, conn_id string, remote_address string, remote_port int, window_id long, offset long, sequence long, window_complete boolean, received_ts timestamp, raw binary"


@dataclass(frozen=True)
class ListenerLimits:
    """Counts, bytes and seconds; 0 as a rate or a time means no limit."""

    connections: int = 30_000
    per_source: int = 1000
    attempts: int = 100_000
    attempts_per_source: int = 0
    frames: int = 100_000
    queued_events: int = 250_000
    queued_bytes: int = 1 << 30
    high_percent: int = 80
    low_percent: int = 60
    first_byte: float = 30.0
    idle: float = 0.0
    assembly: float = 30.0
    ack_write: float = 15.0
    keepalive: float = 0.0
    handshake: float = 10.0


@dataclass
class Admission:
    """Whom a listener lets in. Those turned away use no quota."""

    limits: ListenerLimits
    open: Counter = field(default_factory=Counter)
    second: int = -1
    attempts: Counter = field(default_factory=Counter)

    def reason(self, source: str, now: float) -> str | None:
        """Why a connection is turned away, or null; then it counts."""
        if int(now) != self.second:
            self.second, self.attempts = int(now), Counter()
        most = self.limits
        if self.open.total() >= most.connections:
            return "GLOBAL_CONNECTION_LIMIT"
        if self.open[source] >= most.per_source:
            return "PER_SOURCE_CONNECTION_LIMIT"
        if most.attempts and self.attempts.total() >= most.attempts:
            return "GLOBAL_CONNECTION_RATE_LIMIT"
        if most.attempts_per_source and self.attempts[source] >= most.attempts_per_source:
            return "PER_SOURCE_CONNECTION_RATE_LIMIT"
        self.open[source] += 1
        self.attempts[source] += 1
        return None

    def closed(self, source: str) -> None:
        self.open[source] -= 1
        if not self.open[source]:
            del self.open[source]


class Listener:
    """Accepts connections on one event loop and keeps events until the query has committed them.

    Connections aren't read while the queue is above its high-water mark, until it is below the low one, so senders wait
    too. Nothing is acknowledged or forgotten before a batch with it is committed: what a restart loses has not
    been acknowledged, and its sender sends it again. Events are numbered within a listener's life, which id names.
    """

    def __init__(
        self, host: str = "127.0.0.1", port: int = 0, frames: FrameLimits = FrameLimits(), session: SessionLimits = SessionLimits(),
        limits: ListenerLimits = ListenerLimits(), tls: ssl.SSLContext | None = None, clock: Callable[[], float] | None = None,
    ) -> None:
        self.id, self.frames, self.session, self.limits, self.tls = uuid.uuid4().hex, frames, session, limits, tls
        self.lock = threading.Lock()
        self.events: deque[tuple] = deque()
        self.first = self.bytes = self.given = 0
        self.paused = False
        self.closes: Counter[str] = Counter()
        self.counts: Counter[str] = Counter()
        self.admission, self.open = Admission(limits), {}
        self.clock = clock or time
        self.loop, self.room = asyncio.new_event_loop(), asyncio.Event()
        self.room.set()
        self.server = self.loop.run_until_complete(asyncio.start_server(self._serve, host, port, ssl=tls, ssl_handshake_timeout=limits.handshake if tls else None, backlog=8192))
        self.port = self.server.sockets[0].getsockname()[1]
        self.thread = threading.Thread(target=self.loop.run_forever, daemon=True)
        self.thread.start()

    # the side of the sockets, on the event loop

    async def _serve(self, reader: asyncio.StreamReader, writer: asyncio.StreamWriter) -> None:
        address, port = writer.get_extra_info("peername")[:2]
        if reason := self.admission.reason(address, monotonic()):
            self.closes[reason] += 1
            writer.close()
            return
        conn, reason = f"{address}:{port}", "REMOTE_CLOSE"
        session = Session(self.session)
        self.open[conn] = (session, writer)
        try:
            await self._read(reader, writer, conn, address, port, session)
        except FrameError as e:
            reason = _close_reason(str(e))
        except TimeoutError as e:
            reason = str(e) or "ACK_WRITE_TIMEOUT"
        except (OSError, ssl.SSLError):
            reason = "IO_ERROR"
        except asyncio.CancelledError:
            reason = "SERVICE_DISABLED"
        finally:
            self.closes[reason] += 1
            self.counts["disconnected.before.commit" if session.sizes else "disconnected.after.commit"] += 1
            self.open.pop(conn, None)
            self.admission.closed(address)
            writer.close()

    async def _read(self, reader: asyncio.StreamReader, writer: asyncio.StreamWriter, conn: str, address: str, port: int, session: Session) -> None:
        decoder, second, frames, heard, most = Decoder(self.frames), 0, 0, False, self.limits
        while True:
            await self.room.wait()
            # a half frame has to be completed in time; a connection with events that wait for a commit isn't idle
            limit, reason = (most.assembly, "PARTIAL_FRAME_TIMEOUT") if decoder.rest else (most.idle, "IDLE_TIMEOUT") if heard else (most.first_byte, "FIRST_BYTE_TIMEOUT")
            try:
                async with asyncio.timeout(limit or None):
                    data = await reader.read(65536)
            except TimeoutError:
                if reason == "IDLE_TIMEOUT" and session.sizes:
                    continue
                raise TimeoutError(reason) from None
            if not data:
                return
            heard = True
            for f in decoder.feed(data):
                if int(monotonic()) != second:
                    second, frames = int(monotonic()), 0
                frames += 1
                if most.frames and frames > most.frames:
                    raise FrameError("frame rate")
                if f.type == "W":
                    with self.lock:
                        due = session.opened(f.window_size)
                    await self._tell(writer, due)
                else:
                    with self.lock:
                        window, offset, complete = session.received(f.sequence, len(f.payload))
                        self.events.append((self.first + len(self.events), conn, address, port, window, offset, f.sequence, complete, self.clock(), f.payload))
                        self.bytes += len(f.payload)
                        self.counts["events.accepted"] += 1
                        self._pressure()

    def _pressure(self) -> None:
        used = max(len(self.events) / self.limits.queued_events, self.bytes / self.limits.queued_bytes) * 100
        if used >= self.limits.high_percent and not self.paused:
            self.paused = True
            self.room.clear()
        elif used <= self.limits.low_percent and self.paused:
            self.paused = False
            self.room.set()

    async def _tell(self, writer: asyncio.StreamWriter, sequences: list[int]) -> None:
        for sequence in sequences:
            writer.write(ack(sequence))
            self.counts["ack.sent"] += 1
        if sequences:
            async with asyncio.timeout(self.limits.ack_write or None):
                await writer.drain()

    async def _done(self, rows: list[tuple]) -> None:
        touched = {}
        with self.lock:
            for r in rows:
                if found := self.open.get(r[1]):
                    found[0].committed(r[4], r[5])
                    touched[r[1]] = found
            self._pressure()
            due = [(writer, session.acks()) for session, writer in touched.values()]
        for writer, sequences in due:
            try:
                await self._tell(writer, sequences)
            except (OSError, TimeoutError):
                self.counts["ack.failures"] += 1
                writer.close()

    async def _repeat(self) -> None:
        for session, writer in list(self.open.values()):
            with self.lock:
                sequence = session.keepalive
            if sequence is not None:
                self.counts["keepalive.sent"] += 1
                await self._tell(writer, [sequence])

    # the side of the query, on any thread

    def between(self, start: int, end: int) -> list[tuple]:
        with self.lock:
            self.given = max(self.given, end)
            return [r for r in self.events if start <= r[0] < end]

    @property
    def end(self) -> int:
        with self.lock:
            return self.first + len(self.events)

    def commit(self, end: int) -> None:
        """Forgets events before end that a read has given, and acknowledges what their connections may now be told."""
        rows = []
        with self.lock:
            while self.events and self.events[0][0] < min(end, self.given):
                rows.append(self.events.popleft())
                self.first, self.bytes = rows[-1][0] + 1, self.bytes - len(rows[-1][-1])
            self.counts["events.committed"] += len(rows)
        asyncio.run_coroutine_threadsafe(self._done(rows), self.loop).result()

    def keepalive(self) -> None:
        """Repeats the last acknowledgement of every window that is done in part."""
        asyncio.run_coroutine_threadsafe(self._repeat(), self.loop).result()

    def metrics(self) -> dict[str, int]:
        """Counters and gauges of now, by the names of the output attributes."""
        with self.lock:
            return {**self.counts, "active.connections": len(self.open), "pending.records": len(self.events), "pending.bytes": self.bytes, "pressure.paused": int(self.paused)}

    def close(self) -> None:
        async def end() -> None:
            self.server.close()
            own = [t for t in asyncio.all_tasks() if t is not asyncio.current_task()]
            for t in own:
                t.cancel()
            await asyncio.gather(*own, return_exceptions=True)

        asyncio.run_coroutine_threadsafe(end(), self.loop).result()
        self.loop.call_soon_threadsafe(self.loop.stop)
        self.thread.join()


def _close_reason(message: str) -> str:
    """The reason that a protocol error's text tells, by the words that reporting.close_reason looks for."""
    if message == "frame rate":
        return "FRAME_RATE_LIMIT"
    if "frame" in message and ("maximum" in message or "exceeds" in message):
        return "FRAME_TOO_LARGE"
    if "window" in message and "exceed" in message:
        return "WINDOW_TOO_LARGE"
    return "PER_CONNECTION_MEMORY_LIMIT" if "outstanding unacknowledged" in message else "PROTOCOL_VIOLATION"


_running: dict[tuple[str, int], Listener] = {}


def listener(host: str = "127.0.0.1", port: int = 0, **options) -> Listener:
    """The listener at this address on this driver; the first call starts it."""
    if (host, port) not in _running:
        _running[host, port] = Listener(host, port, **options)
    return _running[host, port]


class _Reader(SimpleDataSourceStreamReader):
    """Offsets name the listener's life. Those of an earlier life hold nothing that this one has: their events
    were not acknowledged, so they come again.

    Spark tells a commit only when it has new data for the next batch, which a sender may hold back until it is
    acknowledged. But it asks for data only after the batch before is done, so what was given before then is committed.
    """

    def __init__(self, start: Callable[[], Listener]) -> None:
        self.start = start

    @cached_property
    def own(self) -> Listener:
        """Started by the first question for offsets: Spark makes readers in other processes too, which ask for none."""
        return self.start()

    def initialOffset(self) -> dict:  # noqa: N802
        return {"life": self.own.id, "event": self.own.first}

    def _start(self, offset: dict) -> int:
        return offset["event"] if offset.get("life") == self.own.id else self.own.first

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        begin = self._start(start)
        self.own.commit(begin)
        end = max(self.own.end, begin)
        return self._rows(begin, end), {"life": self.own.id, "event": end}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        """What read gave goes along with its offsets; Spark asks for a range again, in another process, where that was nothing
        or was lost with an earlier life."""
        own = self.__dict__.get("own")
        if own is not None and end.get("life") == own.id:
            return self._rows(self._start(start), end["event"])
        if own is None and start.get("life") != end.get("life") and end["event"]:
            raise RuntimeError("events that were given are gone; they have not been acknowledged")
        return iter(())

    def _rows(self, begin: int, end: int) -> Iterator[tuple]:
        from datetime import datetime, timezone

        return iter([(*r[:8], datetime.fromtimestamp(r[8], timezone.utc), r[9]) for r in self.own.between(begin, end)])

    def commit(self, end: dict) -> None:
        if end.get("life") == self.own.id:
            self.own.commit(end["event"])


def tls_context(certificate: str, key: str, client_ca: str | None = None, client: str = "NONE") -> ssl.SSLContext:
    """TLS for a listener; client: NONE, WANT or REQUIRED certificates of clients, checked against client_ca."""
    made = ssl.SSLContext(ssl.PROTOCOL_TLS_SERVER)
    made.load_cert_chain(certificate, key)
    if client != "NONE":
        made.load_verify_locations(client_ca)
        made.verify_mode = ssl.CERT_REQUIRED if client == "REQUIRED" else ssl.CERT_OPTIONAL
    return made


class ShipperSource(DataSource):
    """spark.readStream.format("shipper").option("port", ...).load() after spark.dataSource.register(ShipperSource).

    Options: host, port, certificate and key (TLS), client_ca and client_authentication, and any number of ListenerLimits, by
    name. The listener lives in the process that PySpark starts for the reader next to the driver, so give it a port.
    raw holds an event's bytes as they came.
    """

    @classmethod
    def name(cls) -> str:
        return "shipper"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:  # noqa: N802
        o = {k: v for k, v in self.options.items()}
        kinds = {k: type(v) for k, v in ListenerLimits.__dict__.items() if k in ListenerLimits.__dataclass_fields__}
        limits = ListenerLimits(**{k: kinds[k](o[k]) for k in kinds if k in o})

        def start() -> Listener:
            tls = tls_context(o["certificate"], o["key"], o.get("client_ca"), o.get("client_authentication", "NONE")) if "certificate" in o else None
            return listener(o.get("host", "127.0.0.1"), int(o.get("port", "0")), limits=limits, tls=tls)

        return _Reader(start)
