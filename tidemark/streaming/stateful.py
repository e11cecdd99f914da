"""Stateful operators on streams: transactions are stamped and batches are closed by age."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class StampProcessor(StatefulProcessor):
    """Carries transaction and key of the open BEGIN of a slot to its later rows; a BEGIN in an open transaction fails
    the query, which then starts again from its checkpoint."""

    def __init__(self, columns: list[str], strict: bool):
        self.columns, self.strict = columns, strict

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "transaction string, time_based_key string, committed boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values("ingest_seq")
        xid, tkey, committed = self.open.get() if self.open.exists() else (None, None, True)
        xids, keys = [], []
        for op, seq, own in zip(frame["operation"], frame["ingest_seq"], frame["transaction"], strict=True):
            if op == "BEGIN":
                if self.strict and not committed:
                    raise ValueError(f"transaction {xid} has no COMMIT before {own} begins")
                xid, tkey, committed = own, f"{own}-{seq}", False
            elif op == "COMMIT":
                committed = True
            xids.append(xid if own is None else own)
            keys.append(tkey)
        if tkey is not None:
            self.open.update((xid, tkey, committed))
        yield frame.assign(transaction=xids, time_based_key=keys)[[*self.columns, "time_based_key"]]

    def close(self) -> None:
        pass


def stamp_stream(parsed: DataFrame, strict: bool = True) -> DataFrame:
    """transaction and time_based_key for a stream of parsed rows (slot, ingest_seq, operation, transaction, wal_start, server_time_ms, wal_data). Maps don't pass through; parse the columns after it."""
    keep = [c for c in ("ingest_seq", "slot", "wal_start", "server_wal_end", "server_time_ms", "wal_data", "operation", "transaction") if c in parsed.columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parsed.select(keep).schema) + ", time_based_key string"
    return parsed.select(keep).groupBy("slot").transformWithStateInPandas(StampProcessor(keep, strict), schema, "Append", "None")


class AgeProcessor(StatefulProcessor):
    """Collects a partition key's messages and closes the batch when it is full, idle or old, by processing time."""

    def __init__(self, size: int, update_age_ms: int, max_age_ms: int):
        self.size, self.update_age, self.max_age = size, update_age_ms, max_age_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "ingest_seq long, json string")
        self.meta = handle.getValueState("meta", "batch_no long, n long, created long, due long")

    def _close(self, key, reason: str, rows: list, no: int) -> pd.DataFrame:
        return pd.DataFrame({"partition_key": [key[0]], "batch_no": [no], "reason": [reason], "n_messages": [len(rows)], "first_seq": [rows[0][0]], "body": ["\n".join(r[1] for r in rows)]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        no, n, created, due = self.meta.get() if self.meta.exists() else (0, 0, now, 0)
        held = [tuple(r) for r in self.rows.get()] if n else []
        frame = pd.concat(list(rows)).sort_values("ingest_seq")
        for seq, json in zip(frame["ingest_seq"], frame["json"], strict=True):
            if len(held) >= self.size:
                yield self._close(key, "full", held, no)
                held, no, created = [], no + 1, now
            if not held:
                created = now
            held.append((int(seq), json))
        if due:
            self.handle.deleteTimer(due)
        due = min(now + self.update_age, created + self.max_age)
        self.handle.registerTimer(due)
        self.rows.put(held)
        self.meta.update((no, len(held), created, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        no, n, created, due = self.meta.get()
        held = [tuple(r) for r in self.rows.get()] if n else []
        if held:
            reason = "old" if due >= created + self.max_age else "idle"
            yield self._close(key, reason, held, no)
        self.rows.clear()
        self.meta.update((no + bool(held), 0, created, 0))

    def close(self) -> None:
        pass


def age_batches(messages: DataFrame, size: int, update_age_ms: int = 500, max_age_ms: int = 1000) -> DataFrame:
    """partition_key, batch_no, reason (full, idle, old), n_messages, first_seq, body of every closed batch of a stream of messages (partition_key, ingest_seq, json)."""
    out = "partition_key string, batch_no long, reason string, n_messages long, first_seq long, body string"
    own = messages.filter("json IS NOT NULL").select("partition_key", "ingest_seq", "json")
    return own.groupBy("partition_key").transformWithStateInPandas(AgeProcessor(size, update_age_ms, max_age_ms), out, "Append", "ProcessingTime")
