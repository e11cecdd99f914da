"""A client of a replication slot behind the stream source: receive loop, keepalives, reconnects, and its admin.

The wire is a connection that the caller gives; everything above it is here. Sequence numbers are given out in the order
of arrival, from the one that the stream asks for.
"""

from __future__ import annotations

import random
import time
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from importlib import import_module
from typing import Protocol

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ..operators.keepalive import MOST, WITHIN_MS
from ..schema import WAL_RAW
from .replay import _Reader

TIMEOUT_S = 5.0


@dataclass(frozen=True)
class Keepalive:
    server_wal_end: int
    reply: bool = False


@dataclass(frozen=True)
class Data:
    wal_start: int
    server_wal_end: int
    server_time_ms: int
    text: str


class ServerError(Exception):
    """The server can't go on with what it sends; server_wal_end is where it stands now."""

    def __init__(self, message: str, server_wal_end: int):
        super().__init__(message)
        self.server_wal_end = server_wal_end


class Connection(Protocol):
    def start(self, slot: str, lsn: int) -> None:
        """Begins to stream from lsn on, without options for the output plugin."""

    def receive(self, timeout_s: float) -> Keepalive | Data | None:
        """The next message; null when none came in time. Raises OSError when the connection is lost."""

    def send_status(self, lsn: int, forced: bool) -> None: ...

    def close(self) -> None: ...


@dataclass(frozen=True)
class Backoff:
    """Exponential waits, without an end."""

    first_s: float = 0.5
    factor: float = 1.5
    jitter: float = 0.5
    most_s: float = 20.0
    sleep: Callable[[float], None] = time.sleep

    def waits(self) -> Iterator[float]:
        wait = self.first_s
        while True:
            yield wait * random.uniform(1 - self.jitter, 1 + self.jitter)
            wait = min(wait * self.factor, self.most_s)


class StormError(ConnectionError):
    """Reply requests come so fast that the connection is of no use."""


@dataclass
class SlotSession:
    """What the stream source needs of a slot, on a connection that is made anew whenever it is lost.

    The first message of a connection must be a keepalive; it says where the server stands. What was acknowledged is the
    progress: it only rises, answers reply requests, and is where a new connection begins. Rows that the server sends again
    are handed on again, under new numbers. A BEGIN in an open transaction drops the connection, so that the server sends
    what is missing. After a ServerError an open transaction is closed by a COMMIT at the highest position seen, and
    streaming begins again where the server stands: what lies between is given up."""

    connect: Callable[[], Connection]
    slot: str = "s0"
    backoff: Backoff = field(default_factory=Backoff)
    clock_ms: Callable[[], int] = lambda: time.monotonic_ns() // 1_000_000
    timeout_s: float = TIMEOUT_S

    def __post_init__(self):
        self.conn: Connection | None = None
        self.progress = self.top = self.next_seq = 0
        self.open: str | None = None
        self.rows: deque[tuple] = deque()
        self.requests: deque[int] = deque(maxlen=MOST + 1)

    def _connected(self) -> Connection:
        waits = self.backoff.waits()
        while self.conn is None:
            try:
                conn = self.connect()
                conn.start(self.slot, self.progress)
                first = conn.receive(self.timeout_s)
                if not isinstance(first, Keepalive):
                    conn.close()
                    raise ConnectionError(f"a connection must begin with a keepalive, not {first!r}")
                self.conn = conn
                self.progress = self.progress or first.server_wal_end
                self._answer(first)
            except StormError:
                raise
            except OSError:
                self.backoff.sleep(next(waits))
        return self.conn

    def _lost(self) -> None:
        if self.conn is not None:
            self.conn.close()
        self.conn, self.open = None, None
        self.requests.clear()

    def _answer(self, message: Keepalive) -> None:
        if not message.reply:
            return
        self.requests.append(self.clock_ms())
        if len(self.requests) > MOST and self.requests[-1] - self.requests[0] < WITHIN_MS:
            self._lost()
            raise StormError(f"{MOST + 1} reply requests in {WITHIN_MS} ms")
        self.conn.send_status(self.progress, True)

    def _add(self, wal_start: int, wal_end: int, ms: int, text: str) -> None:
        self.rows.append((self.next_seq, self.slot, wal_start, wal_end, ms, text))
        self.next_seq += 1

    def _take(self, message: Data) -> None:
        kind, _, xid = message.text.partition(" ")
        if kind == "BEGIN":
            if self.open is not None:
                self._lost()  # its COMMIT is missing: this BEGIN is not handed on, and all is read again
                return
            self.open = xid
        elif kind == "COMMIT":
            self.open = None
        self.top = max(self.top, message.wal_start)
        self._add(message.wal_start, message.server_wal_end, message.server_time_ms, message.text)

    def receive(self, after_seq: int, most: int) -> list[tuple]:
        if not self.rows and self.next_seq < after_seq:
            self.next_seq = after_seq
        while sum(r[0] >= after_seq for r in self.rows) < most:
            try:
                message = self._connected().receive(self.timeout_s)
                if message is None:
                    break
                self._answer(message) if isinstance(message, Keepalive) else self._take(message)
            except StormError:
                raise
            except ServerError as e:
                if self.open is not None:
                    self._add(self.top, e.server_wal_end, 0, f"COMMIT {self.open}")
                self.progress = max(self.progress, e.server_wal_end)
                self._lost()
            except OSError:
                self._lost()
        return [r for r in self.rows if r[0] >= after_seq][:most]

    def acknowledge(self, seq: int) -> None:
        while self.rows and self.rows[0][0] < seq:
            self.progress = max(self.progress, self.rows.popleft()[2])
        if self.conn is not None:
            self.conn.send_status(self.progress, False)


class SlotSource(DataSource):
    """spark.readStream.format("wal_slot").option("connect", "module:function").option("slot", name): the function makes a Connection."""

    @classmethod
    def name(cls) -> str:
        return "wal_slot"

    def schema(self) -> str:
        return WAL_RAW

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        module, _, function = self.options["connect"].partition(":")
        return _Reader(SlotSession(getattr(import_module(module), function), self.options.get("slot", "s0")), int(self.options.get("maxRowsPerBatch", "10000")))


# ---- admin

PLUGIN, EXISTS, IN_USE = "test_decoding", "42710", "55006"


class SqlError(Exception):
    def __init__(self, code: str, message: str = ""):
        super().__init__(f"{code} {message}")
        self.code = code


def create_slot(execute: Callable[[str], object], slot: str, plugin: str = PLUGIN) -> bool:
    """Makes a lasting slot. False: there is one already, which is no error."""
    try:
        execute(f"CREATE_REPLICATION_SLOT {_quoted(slot)} LOGICAL {plugin}")
        return True
    except SqlError as e:
        if e.code == EXISTS:
            return False
        raise


def drop_slot(execute: Callable[[str], object], slot: str) -> None:
    """Drops a slot, and waits until nothing uses it."""
    execute(f"DROP_REPLICATION_SLOT {_quoted(slot)} WAIT")


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'
