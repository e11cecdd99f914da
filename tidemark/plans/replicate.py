"""The data path from raw log messages to messages, batches and the ledger, as one declarative plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.keys import kafka_key, kinesis_key, partition_key
from ..functions.marshal import marshalled
from ..functions.parse import with_columns, with_prelude
from ..operators import batching, filters, ledger, transactions


def messages(raw: DataFrame, config: PipelineConfig, stamp=transactions.stamped) -> DataFrame:
    """Parsed, stamped, filtered, keyed and marshalled rows, BEGIN and COMMIT included. stamp may be the streaming one."""
    wal = stamp(with_prelude(raw, mode=config.parse_mode))
    if config.parse_mode == "PERMISSIVE":
        wal = wal.filter("operation IS NOT NULL")
    for tables, white, regex in ((config.whitelist, True, False), (config.blacklist, False, False), (config.whitelist_regex, True, True), (config.blacklist_regex, False, True)):
        if tables:
            wal = filters.filtered(wal, tables, white, regex)
    # columns are parsed last: filtered rows never are, and texts move between tasks more lightly than maps
    wal = with_columns(wal, mode=config.parse_mode)
    if config.parse_mode == "PERMISSIVE":
        wal = wal.filter("parse_error IS NULL")
    keyed = wal.withColumn("partition_key", partition_key(config.partition_method, F.col("relation"), F.col("transaction"), config.partition_count))
    return marshalled(keyed, config.marshal_old_value, config.html_escape)


def record_key(config: PipelineConfig) -> Column | None:
    """The key under which a sink's client is given a message; null where it has none."""
    if config.sink == "kinesis":
        return kinesis_key(config.partition_method, F.col("partition_key"), F.col("wal_start"))
    if config.sink == "kafka":
        # a batch has one random key of the length of a UUID, which counts in the size of its messages
        return kafka_key(config.kafka_key, F.col("time_based_key"), F.col("transaction"), F.col("relation"), F.lit("0" * 36))
    return None


def batches(rows: DataFrame, config: PipelineConfig) -> DataFrame:
    """Messages with batch_no, as the sink wants them, and why a message has none: failed (it has no JSON), invalid (the sink's client refuses it), dropped (it is too big; it counts as written all the same)."""
    key = record_key(config)
    body = batching.fatal(batching.rows_only(rows), F.col("partition_key").isNull(), "a message has no partition key")
    refused = batching.invalid(F.col("json"), key) if config.sink == "kinesis" else F.lit(False)
    marked = body.withColumn("invalid", ~F.col("failed") & refused)
    good = marked.filter("NOT failed AND NOT invalid")
    bad = marked.filter("failed OR invalid").withColumns({"dropped": F.lit(False), "batch_no": F.lit(None).cast("long")})
    if config.sink == "kinesis":
        return batching.byte_batches(good, key).unionByName(bad)
    if config.sink != "kafka":
        return batching.count_batches(good.withColumn("dropped", F.lit(False)), config.size).unionByName(bad)
    sized = good.withColumn("dropped", batching.too_big(batching.kafka_size(F.col("json"), key), config.kafka_max_message_bytes))
    numbers = batching.count_batches(sized.filter("NOT dropped"), config.size)
    return numbers.unionByName(sized.filter("dropped").withColumn("batch_no", F.lit(None).cast("long"))).unionByName(bad)


def routed(batched: DataFrame, config: PipelineConfig) -> DataFrame:
    """One row per batch with its worker."""
    summary = batching.batch_summary(batched)
    return batching.by_partition(summary, config.workers) if config.routing == "partition" else batching.round_robin(summary, config.workers)


def flushes(batched: DataFrame, config: PipelineConfig, now_ms: Column) -> DataFrame:
    """Open batches with flush: empty, idle, old or full by the ages and the size of the config, or memory, if what is left of them is more than the soft limit and they are among the largest; null: they stay open."""
    aged = batching.age_flushes(batching.batch_summary(batched), now_ms, config.update_age_ms, config.max_age_ms, config.size)
    rest = aged.filter("flush IS NULL").drop("flush").withColumn("_id", F.concat_ws("/", "partition_key", F.col("batch_no").cast("string")))
    pressed = batching.memory_flushes(rest, config.memory_soft_limit, key="_id").drop("_id")
    return aged.filter("flush IS NOT NULL").unionByName(pressed.withColumn("flush", F.when(F.col("flush"), "memory")))


def written_counts(batched: DataFrame) -> DataFrame:
    """What sinks report when all is sent: messages by transaction instance; those that were too big count, invalid and failed ones don't."""
    return batching.batch_transactions(batched.filter("NOT failed AND NOT invalid"))


def ledger_of(rows: DataFrame, batched: DataFrame) -> DataFrame:
    """The ledger after everything was sent; dropped messages count as written, and transactions of which nothing was sent are reported by their empty batches."""
    seen = transactions.totals(rows).filter("commit_wal_start IS NOT NULL")
    written = written_counts(batched).select("transaction", "time_based_key", "count").unionByName(batching.empty_flushes(rows, batched).select("transaction", "time_based_key", "count"))
    return ledger.ledger(seen, written)
