"""What a connection may send, and what it is told: windows, sequences, limits and acknowledgements, without any socket."""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

from sluicegate.sources.framing import FrameError

#: Windows that a connection may have open at once, and the first number that a sequence doesn't reach.
MOST_WINDOWS, SEQUENCES = 1024, 1 << 32


@dataclass(frozen=True)
class SessionLimits:
    window: int = 4096
    events: int = 16_384
    bytes: int = 32 * 1024 * 1024


@dataclass
class _Window:
    number: int
    size: int
    first: int | None = None
    received: int = 0
    #: Events that are committed or dropped, from the first on without a gap; those beyond a gap; the last offset told.
    done: int = 0
    ahead: set[int] | None = None
    told: int = 0

    def sequence(self, offset: int) -> int:
        return (self.first + offset) % SEQUENCES


class Session:
    """One connection. Every broken rule raises FrameError, whose text tells the reason of the close."""

    def __init__(self, limits: SessionLimits = SessionLimits()) -> None:
        self.limits, self.windows, self.number = limits, deque(), 0
        self.sizes: dict[tuple[int, int], int] = {}
        self.bytes = 0

    def opened(self, size: int) -> list[int]:
        """A window of size events begins; the sequences to acknowledge now (0 for an empty window whose turn it is)."""
        if size > self.limits.window:
            raise FrameError("window exceeds maximum events")
        if self.windows and self.windows[-1].received < self.windows[-1].size:
            raise FrameError("a window begins before the last is complete")
        if len(self.windows) >= MOST_WINDOWS:
            raise FrameError("too many open windows")
        self.number += 1
        self.windows.append(_Window(self.number, size, ahead=set()))
        return self.acks()

    def received(self, sequence: int, size: int) -> tuple[int, int, bool]:
        """Window, offset and whether the event completes the window."""
        now = self.windows[-1] if self.windows else None
        if now is None or now.received >= now.size:
            raise FrameError("event outside a window")
        if now.first is None:
            now.first = sequence
        elif sequence != now.sequence(now.received):
            raise FrameError("sequence gap")
        if len(self.sizes) >= self.limits.events or self.bytes + size > self.limits.bytes:
            raise FrameError("outstanding unacknowledged events exceed the per-connection maximum")
        offset = now.received
        now.received += 1
        self.sizes[now.number, offset] = size
        self.bytes += size
        return now.number, offset, now.received == now.size

    def committed(self, window: int, offset: int) -> None:
        """An event is committed or dropped, in any order; unknown and repeated ones are ignored."""
        if (window, offset) not in self.sizes:
            return
        self.bytes -= self.sizes.pop((window, offset))
        own = next(w for w in self.windows if w.number == window)
        own.ahead.add(offset)
        while own.done in own.ahead:
            own.ahead.remove(own.done)
            own.done += 1

    def acks(self) -> list[int]:
        """The sequences to acknowledge, windows in order; a window that is not done holds up those after it."""
        out = []
        while self.windows:
            head = self.windows[0]
            if head.done > head.told:
                out.append(head.sequence(head.done - 1))
                head.told = head.done
            elif not head.size:
                out.append(0)
            if head.done < head.size:
                break
            self.windows.popleft()
        return out

    @property
    def keepalive(self) -> int | None:
        """The acknowledgement to repeat while the first window is done in part, else null."""
        head = self.windows[0] if self.windows else None
        return head.sequence(head.told - 1) if head and 0 < head.told < head.size else None
