"""Wiring of streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import PipelineConfig
from ..functions.parse import with_prelude
from ..operators import batching, ledger, transactions
from ..plans import counters
from ..plans.replicate import batches, messages, written_counts
from ..store import dropped, landed
from .stateful import age_batches, stamp_stream

OPEN = "slot string, xid string, key string"
NUMBERS = "partition_key string, next_no long"
LEDGER = "transaction string, time_based_key string, total_msgs long, commit_wal_start long, ledger_seq long, written long"
ACKED = "acked_lsn long"


class Carried:
    """Small tables that go from one micro-batch to the next, as Parquet beside the query's checkpoint. What an epoch reads was left by the one before, and an epoch that is run again leaves the same again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _of(self, name: str, epoch: int):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/{epoch}")
        return where, where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def before(self, name: str, epoch: int, schema: str) -> DataFrame:
        where, fs = self._of(name, epoch - 1)
        return self.spark.read.schema(schema).parquet(where.toString()) if fs.exists(where) else self.spark.createDataFrame([], schema)

    def leave(self, name: str, epoch: int, table: DataFrame) -> DataFrame:
        where, fs = self._of(name, epoch)
        table.write.mode("overwrite").parquet(where.toString())
        fs.delete(self._of(name, epoch - 3)[0], True)
        return self.spark.read.schema(table.schema).parquet(where.toString())


def replicate(raw: DataFrame, config: PipelineConfig, sink: Callable[[DataFrame, int], DataFrame | None], checkpoint: str, trigger: dict | None = None, acknowledge: Callable[[int], None] | None = None, metrics: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Every micro-batch of a stream of raw messages goes through the batch plan, and its batches to sink(batched, epoch).

    Transactions may be cut anywhere by micro-batches: the open transaction of each slot, the next batch number of each
    partition key, and the ledger's entries are carried to the next one. A micro-batch's open batches are sent at its
    end, so batch numbers go on and none is used twice. What was seen stands in the ledger before the sink is called;
    sink may return what it has written (transaction, time_based_key, count), or else all that it was given counts.
    acknowledge(lsn) is called when the contiguous prefix of complete transactions grows; positions only rise.
    metrics(samples, epoch) is given the counters of the marshaller, the batcher and the ledger. Epochs
    are delivered at least once, under the same batch numbers when they come again."""

    def run(raw_batch: DataFrame, epoch: int) -> None:
        state = Carried(raw_batch.sparkSession, f"{checkpoint}/tidemark")
        open_ = state.before("open", epoch, OPEN)
        rows = landed(messages(raw_batch, config, stamp=lambda wal: transactions.stamped(wal, before=open_)), "messages")
        state.leave("open", epoch, transactions.left_open(rows, open_))

        numbers = state.before("numbers", epoch, NUMBERS)
        known = numbers.select(F.col("partition_key").alias("_key"), "next_no")
        own = batches(rows, config).join(known, F.col("partition_key") == F.col("_key"), "left").withColumn("batch_no", F.col("batch_no") + F.coalesce("next_no", F.lit(0))).drop("_key", "next_no")
        batched = landed(own, "batched")
        next_ = batched.filter("batch_no IS NOT NULL").groupBy("partition_key").agg((F.max("batch_no") + 1).alias("next_no"))
        state.leave("numbers", epoch, numbers.unionByName(next_).groupBy("partition_key").agg(F.max("next_no").alias("next_no")))

        seen = transactions.totals(rows).filter("time_based_key IS NOT NULL").withColumn("written", F.lit(0).cast("long"))
        pending = state.leave("seen", epoch, _merged(state.before("ledger", epoch, LEDGER).unionByName(seen.select(*[c.split()[0] for c in LEDGER.split(", ")]))))
        report = sink(batched, epoch)
        report = written_counts(batched) if report is None else report
        empty = batching.empty_flushes(rows, batched).select("transaction", "time_based_key", "count")
        written = report.select("transaction", "time_based_key", "count").unionByName(empty)
        counts = written.groupBy("transaction", "time_based_key").agg(F.sum("count").alias("written")).withColumns({"total_msgs": F.lit(0).cast("long"), "commit_wal_start": F.lit(None).cast("long"), "ledger_seq": F.lit(None).cast("long")})
        merged = _merged(pending.unionByName(counts))
        entries = ledger.with_prefix(ledger.ledger(merged.drop("written"), merged.select("transaction", "time_based_key", F.col("written").alias("count"))))
        held = landed(entries, "ledger")
        state.leave("ledger", epoch, held.filter(~F.col("in_prefix")).select(*[c.split()[0] for c in LEDGER.split(", ")]))
        done = held.filter("in_prefix").agg(F.max_by("commit_wal_start", "ledger_seq").alias("acked_lsn"))
        was = state.before("acked", epoch, ACKED)
        acked = state.leave("acked", epoch, was.unionByName(done).agg(F.max("acked_lsn").alias("acked_lsn")))
        if metrics:
            size = held.agg(F.count_if("in_prefix").alias("ledger_flushed"), F.count_if(~F.col("in_prefix")).alias("ledger_size"))
            samples = counters.marshaller(rows).unionByName(counters.batcher(batched)).unionByName(counters.progress(size))
            metrics(samples.withColumn("timestamp_ns", F.unix_micros(F.current_timestamp()) * 1000), epoch)
        dropped(rows, batched, held, *getattr(report, "_tidemark_tables", ()))
        if acknowledge:
            lsn, old = acked.first()[0], was.agg(F.max("acked_lsn")).first()[0]
            if lsn is not None and lsn != old:
                acknowledge(lsn)

    return raw.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def restamped(wal: DataFrame, mode: str = "PERMISSIVE") -> DataFrame:
    """A stream of rows with their prelude, stamped with state. The prelude is read again after the state, which hands on texts but nothing that follows from them."""
    out = stamp_stream(wal, strict=False).withColumnRenamed("transaction", "_xid")
    return with_prelude(out, mode=mode).withColumn("transaction", F.col("_xid")).drop("_xid")


def replicate_by_age(raw: DataFrame, config: PipelineConfig, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Batches stay open across micro-batches, in state, until they are full (config.size), idle (update_age_ms) or old (max_age_ms); a tick (tick_ms) looks for those. sink(batches, epoch) is given partition_key, batch_no, reason, n_messages, first_seq and body (JSON lines)."""
    rows = messages(raw, config, stamp=lambda wal: restamped(wal, config.parse_mode))
    closed = age_batches(rows, config.size, config.update_age_ms, config.max_age_ms)
    return closed.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(processingTime=f"{config.tick_ms} milliseconds").start()


def _merged(entries: DataFrame) -> DataFrame:
    return entries.groupBy("transaction", "time_based_key").agg(F.sum("total_msgs").alias("total_msgs"), F.max("commit_wal_start").alias("commit_wal_start"), F.max("ledger_seq").alias("ledger_seq"), F.sum("written").alias("written"))


def stats_stream(stats: DataFrame, width: str = "60 seconds", grace: str = "1 second") -> DataFrame:
    """Aggregates of a stream of metric samples per tumbling bucket; a bucket is given out once the watermark has passed it, and samples after that are dropped. Time is the samples' own."""
    timed = stats.withColumn("ts", F.timestamp_micros(F.floor(F.col("timestamp_ns") / 1000).cast("long"))).withWatermark("ts", grace)
    out = timed.groupBy(F.window("ts", width), "component", "stat_name", "stat_type", "unit").agg(F.sum("value").alias("sum"), F.count("value").alias("count"), F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("avg"))
    return out.withColumn("bucket_ns", (F.unix_micros(F.col("window")["start"]) * 1000).cast("long")).drop("window")


def report_loop(stats: DataFrame, reporter: Callable[[DataFrame, int], None], checkpoint: str, width: str = "60 seconds", grace: str = "1 second", every: dict | None = None) -> StreamingQuery:
    """Gives reporter(reports, epoch) the buckets that have closed, every 250 ms."""
    from ..operators.metrics import reported

    def run(closed: DataFrame, epoch: int) -> None:
        reporter(reported(closed), epoch)

    return stats_stream(stats, width, grace).writeStream.outputMode("append").foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(every or {"processingTime": "250 milliseconds"})).start()
