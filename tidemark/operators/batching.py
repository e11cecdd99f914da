"""Batches of messages: by count, by bytes, by age, under memory pressure, and their routing to workers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import quick_hash
from .ordered import running

KINESIS_RECORDS, KINESIS_BATCH_BYTES, KINESIS_RECORD_BYTES = 500, 5 * 1024 * 1024, 1024 * 1024
#: Five 32-bit and one 64-bit variable-length number and a byte, as a client of record format 2 reckons.
KAFKA_OVERHEAD = 5 * 5 + 10 + 1
SORT_RUN = 100_000


def rows_only(messages: DataFrame) -> DataFrame:
    return messages.filter(~F.col("operation").isin("BEGIN", "COMMIT"))


def count_batches(messages: DataFrame, size: int, width: int = SORT_RUN) -> DataFrame:
    """Adds batch_no: every `size` messages of a partition key, in order, are a batch."""
    out = running(rows_only(messages), "_before", F.lit(1), "sum", ["partition_key"], "ingest_seq", inclusive=False, width=width)
    return out.withColumn("batch_no", F.floor(F.col("_before") / size).cast("long")).drop("_before")


def too_big(size: Column, limit: int) -> Column:
    """Messages that are dropped, but still count for their transaction."""
    return size > limit


def invalid(json: Column, key: Column) -> Column:
    """Records that a queue's client refuses: without a body, or with an empty key. They are dropped and counted, and don't count as written."""
    return json.isNull() | key.isNull() | (F.length(key) == 0)


def fatal(messages: DataFrame, wrong: Column, why: str) -> DataFrame:
    """messages; the first for which wrong holds stops the query. For what neither drops a message nor leaves it for the next batch."""
    return messages.withColumn("operation", F.when(F.coalesce(wrong, F.lit(False)), F.raise_error(F.lit(why)).cast("string")).otherwise(F.col("operation")))


def kafka_size(json: Column, key: Column | None = None) -> Column:
    """The size that a Kafka producer's client reckons a record to have: key, value and the most that its framing takes."""
    return F.octet_length(json) + (F.coalesce(F.octet_length(key), F.lit(0)) if key is not None else F.lit(0)) + KAFKA_OVERHEAD


def _ends(size: np.ndarray, max_bytes: int, max_records: int) -> np.ndarray:
    """For each row that a batch may begin with, the row that the next one begins with (len(size): none here)."""
    upto = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(len(size))
    return np.minimum(np.maximum(np.searchsorted(upto, upto[:-1] + max_bytes, "right") - 1, at + 1), at + max_records).clip(max=len(size))


def _first_end(size: np.ndarray, used: int, records: int, max_bytes: int, max_records: int) -> int:
    """The row that ends a batch which is open already, with so many bytes and records; it may be the first."""
    fits = int(np.searchsorted(np.cumsum(size), max_bytes - used, "right"))
    return min(max(fits, 0 if records else 1), max_records - records, len(size))


def byte_batches(messages: DataFrame, key: Column, max_records: int = KINESIS_RECORDS, max_bytes: int = KINESIS_BATCH_BYTES, max_record: int = KINESIS_RECORD_BYTES, width: int = SORT_RUN) -> DataFrame:
    """Adds dropped (the JSON is above max_record) and batch_no (null if dropped): a batch takes messages in order while
    their bytes (JSON and key) stay within max_bytes and their number within max_records.

    Each batch begins where the one before ended, yet no task folds a whole partition key. Keys are cut into runs of
    `width` in the order. The first batch that begins in a run does so within its first max_records rows or after them, so a run is
    summed up by what follows from each of these: how many batches begin in it, and what the last one holds at its end.
    A fold over these summaries (one row in `width`) gives every run what it is entered with, and runs are finished on
    their own."""
    size = F.octet_length("json") + F.octet_length(key)
    rows = rows_only(messages).withColumns({"dropped": too_big(F.octet_length("json"), max_record), "_size": size.cast("long")})
    slim = rows.filter("NOT dropped").select(F.col("partition_key").alias("k"), F.floor(F.col("ingest_seq") / width).alias("run"), F.col("ingest_seq").alias("seq"), F.col("_size").alias("size")).repartition("k", "run")

    def summed(group: pd.DataFrame) -> pd.DataFrame:
        n = group.sort_values("seq")["size"].to_numpy()
        ends = _ends(n, max_bytes, max_records)
        upto = np.concatenate([[0], np.cumsum(n)])
        count, last = np.ones(len(n), np.int64), np.arange(len(n))
        for i, e in zip(range(len(n) - 1, -1, -1), ends[::-1].tolist(), strict=True):
            if e < len(n):
                count[i], last[i] = count[e] + 1, last[e]
        head = min(len(n), max_records + 1)
        return pd.DataFrame({"k": [group["k"].iat[0]], "run": [group["run"].iat[0]], "rows": [len(n)], "bytes": [int(upto[-1])], "sizes": [n[:head].tolist()], "count": [count[:head].tolist()], "used": [(upto[-1] - upto[last[:head]]).tolist()], "records": [(len(n) - last[:head]).tolist()]})

    def carried(frames):
        k, state = None, (0, 0, 0)
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                no, used, records = state if r.k == k else (0, 0, 0)
                k = r.k
                out.append((r.k, r.run, no, used, records))
                end = _first_end(np.asarray(r.sizes), used, records, max_bytes, max_records)
                state = (no + r.count[end], r.used[end], r.records[end]) if end < r.rows else (no, used + r.bytes, records + r.rows)
            yield pd.DataFrame(out, columns=["k", "run", "no", "used", "records"])

    def finished(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("seq")
        n = group["size"].to_numpy()
        no, used, records = (int(group[c].iat[0]) for c in ("no", "used", "records"))
        ends, at = _ends(n, max_bytes, max_records), _first_end(n, used, records, max_bytes, max_records)
        begins = np.zeros(len(n), np.int64)
        while at < len(n):
            begins[at] = 1
            at = int(ends[at])
        return pd.DataFrame({"ingest_seq": group["seq"], "batch_no": no + np.cumsum(begins)})

    sums = slim.groupBy("k", "run").applyInPandas(summed, "k string, run long, rows long, bytes long, sizes array<long>, count array<long>, used array<long>, records array<long>")
    entered = sums.repartition("k").sortWithinPartitions("k", "run").mapInPandas(carried, "k string, run long, no long, used long, records long")
    numbers = slim.join(entered, ["k", "run"]).groupBy("k", "run").applyInPandas(finished, "ingest_seq long, batch_no long")
    return rows.drop("_size").join(numbers, "ingest_seq", "left")


def batch_summary(batched: DataFrame) -> DataFrame:
    """One row per batch: messages, bytes, first and last sequence, first position."""
    return batched.filter(F.col("batch_no").isNotNull()).groupBy("partition_key", "batch_no").agg(
        F.count("*").alias("n_messages"), F.sum(F.octet_length("json")).cast("long").alias("n_bytes"), F.min("ingest_seq").alias("first_seq"), F.max("ingest_seq").alias("last_seq"), F.min_by("wal_start", "ingest_seq").alias("first_wal_start"), F.min("server_time_ms").alias("created_ms"), F.max("server_time_ms").alias("modified_ms")
    )


def batch_transactions(batched: DataFrame) -> DataFrame:
    """Messages of each transaction instance in each batch."""
    return batched.groupBy("partition_key", "batch_no", "transaction", "time_based_key").agg(F.count("*").alias("count"))


def age_flushes(batches: DataFrame, now_ms: Column, update_age_ms: int = 500, max_age_ms: int = 1000, size: int | None = None) -> DataFrame:
    """Adds flush: empty, idle, old, full or null, in that order of precedence, for open batches at now_ms."""
    reason = F.when(F.col("n_messages") == 0, "empty").when(F.col("modified_ms") < now_ms - update_age_ms, "idle").when(F.col("created_ms") < now_ms - max_age_ms, "old")
    if size is not None:
        reason = reason.when(F.col("n_messages") >= size, "full")
    return batches.withColumn("flush", reason)


def empty_flushes(messages: DataFrame, batched: DataFrame) -> DataFrame:
    """partition_key, transaction, time_based_key, count (0): what a batch reports as written that holds no message, because all of a transaction's rows for it were filtered and only its COMMIT came. Such transactions would else never be complete."""
    done = batched.select("time_based_key").distinct()
    commits = messages.filter("operation = 'COMMIT'").select("partition_key", "transaction", "time_based_key").distinct()
    return commits.join(done, "time_based_key", "left_anti").select("partition_key", "transaction", "time_based_key", F.lit(0).cast("long").alias("count"))


def memory_flushes(batches: DataFrame, soft_limit: int, bytes_: str = "n_bytes", key: str = "partition_key", width: int = 4096) -> DataFrame:
    """Adds flush: the largest batches go until the rest is below the limit, so a batch goes if it and all smaller ones reach the limit; of equal ones that with the last key comes first.

    Sizes are added up first, so that the running sum is over different sizes. Batches of one size go or stay together,
    but for the one size at which the limit is reached: only its batches are ranked."""
    sizes = batches.groupBy(bytes_).agg(F.sum(bytes_).cast("long").alias("_sum")).withColumn("_all", F.lit(0))
    upto = running(sizes, "_before", F.col("_sum"), "sum", ["_all"], bytes_, inclusive=False, width=width)
    known = upto.select(F.col(bytes_).alias("_size"), "_before", F.when(F.col("_before") + F.col(bytes_) >= soft_limit, True).when(F.col("_before") + F.col("_sum") < soft_limit, False).alias("_goes"))
    both = batches.join(known, F.col(bytes_) == F.col("_size"))
    clear = both.filter("_goes IS NOT NULL").withColumn("flush", F.col("_goes"))
    rank = F.row_number().over(Window.partitionBy("_size").orderBy(F.col(key).desc()))
    ranked = both.filter("_goes IS NULL").withColumn("flush", F.col("_before") + F.col(bytes_) * rank >= soft_limit)
    return clear.unionByName(ranked).drop("_size", "_before", "_goes")


def round_robin(batches: DataFrame, workers: int, order: str = "last_seq", width: int = SORT_RUN) -> DataFrame:
    """Adds worker: batches in the order in which they are sent."""
    one = batches.withColumn("_all", F.lit(0))
    return running(one, "_before", F.lit(1), "sum", ["_all"], order, inclusive=False, width=width).withColumn("worker", (F.col("_before") % workers).cast("int")).drop("_before", "_all")


def by_partition(batches: DataFrame, workers: int) -> DataFrame:
    """Adds worker: a partition key always has the same one, which keeps its order."""
    return batches.withColumn("worker", quick_hash(F.col("partition_key"), workers).cast("int"))
