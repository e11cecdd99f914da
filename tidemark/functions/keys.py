"""Derived keys and texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quick_hash(text: Column, n: int) -> Column:
    """IEEE CRC-32 of the text, modulo n."""
    return F.crc32(text.cast("binary")) % F.lit(n)


def partition_key(method: str, relation: Column, transaction: Column, buckets: int = 1) -> Column:
    if method == "none":
        return F.lit("")
    if method == "tablename":
        return F.coalesce(relation, F.lit(""))
    if method == "transaction":
        return transaction
    if method == "transaction-bucket":
        return quick_hash(transaction, buckets).cast("string")
    raise ValueError(f"unknown partition method {method!r}")


def lsn_text(lsn: Column) -> Column:
    """High and low 32 bits in hexadecimal; the 64 bits count as unsigned."""
    return F.concat(F.hex(F.shiftrightunsigned(lsn, 32)), F.lit("/"), F.hex(lsn.bitwiseAND(F.lit(4294967295))))


def _two(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def _clock(ms: Column) -> dict[str, Column]:
    """Parts of a UTC time, whatever the session's zone."""
    day = F.floor(ms / 86_400_000).cast("int")
    left = F.pmod(ms, F.lit(86_400_000))
    date = F.date_from_unix_date(day)
    return {"date": date, "hour": F.floor(left / 3_600_000), "minute": F.floor(left / 60_000) % 60, "second": F.floor(left / 1000) % 60}


def time_text(ms: Column) -> Column:
    """RFC 3339 in UTC, to the second."""
    c = _clock(ms)
    return F.concat(c["date"].cast("string"), F.lit("T"), _two(c["hour"]), F.lit(":"), _two(c["minute"]), F.lit(":"), _two(c["second"]), F.lit("Z"))


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970 of a timestamp without zone, read as UTC whatever the session's zone."""
    seconds = F.unix_date(ts.cast("date")).cast("long") * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60
    return seconds * 1000 + F.floor(F.date_part(F.lit("SECOND"), ts) * 1000).cast("long")


def s3_key(key_space: str, ms: Column, first_wal_start: Column) -> Column:
    """key_space/YYYY/MM/DD/HH/<yyyyMMddHHmmss>_<first wal start>.gz, in UTC; empty parts are skipped."""
    c = _clock(ms)
    date = c["date"].cast("string")
    stamp = F.concat(F.replace(date, F.lit("-"), F.lit("")), _two(c["hour"]), _two(c["minute"]), _two(c["second"]))
    space = "/".join(p for p in key_space.split("/") if p)
    parts = [F.replace(date, F.lit("-"), F.lit("/")), _two(c["hour"]), F.concat(stamp, F.lit("_"), first_wal_start.cast("string"), F.lit(".gz"))]
    return F.concat_ws("/", *([F.lit(space)] if space else []), *parts)


def kinesis_key(partition_method: str, partition: Column, wal_start: Column) -> Column:
    """Without a partition method records spread by their place in the log."""
    return wal_start.cast("string") if partition_method == "none" else partition


def kafka_key(method: str, time_based_key: Column, transaction: Column, relation: Column, batch_id: Column) -> Column:
    """batch_id stands for a random id per batch, and is the same whenever a batch is made again."""
    return {"transaction": time_based_key, "transaction-constant": transaction, "batch": batch_id, "tablename": relation, "random": F.lit(None).cast("string")}[method]


def routing_key(relation: Column, operation: Column) -> Column:
    return F.concat_ws(".", relation, operation)
