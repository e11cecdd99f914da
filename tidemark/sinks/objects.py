"""One gzip object of JSON lines per batch, in an object store or any Hadoop file system."""

from __future__ import annotations

import gzip
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import s3_key
from .delivery import Retry, deliver


def objects(batched: DataFrame, key_space: str = "") -> DataFrame:
    """partition_key, batch_no, key, body (JSON lines in order), n_messages. A batch is bounded by its size, so its rows fit one task."""
    own = batched.filter(F.col("batch_no").isNotNull() & F.col("json").isNotNull())
    lines = own.groupBy("partition_key", "batch_no").agg(F.array_sort(F.collect_list(F.struct("ingest_seq", "json"))).alias("_rows"), F.min("server_time_ms").alias("_ms"), F.min_by("wal_start", "ingest_seq").alias("_first"))
    body = F.concat(F.array_join(F.transform("_rows", lambda r: r["json"]), "\n"), F.lit("\n")).cast("binary")
    return lines.select("partition_key", "batch_no", s3_key(key_space, F.col("_ms"), F.col("_first")).alias("key"), body.alias("body"), F.size("_rows").alias("n_messages"))


def put_objects(batched: DataFrame, put: Callable[[str, bytes], None], key_space: str = "", retry: Retry | None = None) -> DataFrame:
    """Writes every batch with put(key, gzip bytes), on the executors, and reports partition_key, batch_no, ok, attempts. A batch that is written again by a retried task gets the same key and bytes."""

    def send(row) -> int:
        put(row["key"], gzip.compress(bytes(row["body"]), mtime=0))
        return row["n_messages"]

    return deliver(objects(batched, key_space), send, retry or Retry(), ["partition_key", "batch_no"])
