"""Sources of raw log messages: files of messages, replayed in batch or as a stream, and a Python data source that
turns any client of a replication slot into a stream.

Offsets of the stream are {"seq": next ingest_seq}; a query that starts again from its checkpoint asks for the same
messages again, so what was received after the last checkpoint is delivered once more.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ..schema import WAL_RAW


class SlotClient(Protocol):
    """What a stream needs of a replication slot."""

    def receive(self, after_seq: int, most: int) -> list[tuple]:
        """Up to `most` rows of WAL_RAW from ingest_seq `after_seq` on; keepalives are answered here."""

    def acknowledge(self, seq: int) -> None:
        """All before ingest_seq `seq` is written."""


class FileSlot:
    """A slot replayed from a file with one JSON row of WAL_RAW a line, in the order of ingest_seq; acknowledged is kept beside it. Where reading stopped is remembered, so that a file is read once however many calls it takes."""

    def __init__(self, path: str):
        self.path = path
        self.stopped = (0, 0)  # ingest_seq and the place in the file where the row may be

    def receive(self, after_seq: int, most: int) -> list[tuple]:
        names = [c.split()[0] for c in WAL_RAW.split(", ")]
        out = []
        with open(self.path, "rb") as f:
            if self.stopped[0] <= after_seq:
                f.seek(self.stopped[1])
            while len(out) < most and (line := f.readline()).endswith(b"\n"):
                row = json.loads(line)
                if row["ingest_seq"] >= after_seq:
                    out.append(tuple(row[n] for n in names))
                self.stopped = (row["ingest_seq"] + 1, f.tell())
        return out

    def acknowledge(self, seq: int) -> None:
        with open(f"{self.path}.ack", "w") as f:
            f.write(str(seq))


class _Reader(SimpleDataSourceStreamReader):
    def __init__(self, client: SlotClient, most: int):
        self.client, self.most = client, most

    def initialOffset(self) -> dict:
        return {"seq": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows = self.client.receive(start["seq"], self.most)
        return iter(rows), {"seq": rows[-1][0] + 1 if rows else start["seq"]}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        at = start["seq"]
        while at < end["seq"]:
            rows = [r for r in self.client.receive(at, self.most) if r[0] < end["seq"]]
            if not rows:
                return
            yield from rows
            at = rows[-1][0] + 1

    def commit(self, end: dict) -> None:
        self.client.acknowledge(end["seq"])


class ReplaySource(DataSource):
    """spark.readStream.format("wal_replay").option("path", file): the log file of a slot."""

    @classmethod
    def name(cls) -> str:
        return "wal_replay"

    def schema(self) -> str:
        return WAL_RAW

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Reader(FileSlot(self.options["path"]), int(self.options.get("maxRowsPerBatch", "10000")))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Files of WAL_RAW rows (Parquet, or JSON lines by the suffix .json) as a batch."""
    reader = spark.read.schema(WAL_RAW)
    return reader.json(path) if path.endswith(".json") else reader.parquet(path)


def stream_log(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """A folder of Parquet files of WAL_RAW rows as a stream, oldest file first."""
    return spark.readStream.schema(WAL_RAW).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def keepalive_storm(requests_ms: list[int], most: int = 5, within_ms: int = 100) -> bool:
    """Whether reply requests come so fast that the connection is of no use: more than `most` in less than `within_ms` in all."""
    return any(requests_ms[i] - requests_ms[i - most] < within_ms for i in range(most, len(requests_ms)))
