"""The transaction ledger: what is wholly written, and how far the log can be acknowledged."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import running


def latest_instances(seen: DataFrame) -> DataFrame:
    """Of instances of one transaction (redeliveries) the one that was seen last."""
    w = Window.partitionBy("transaction").orderBy(F.col("ledger_seq").desc_nulls_last(), F.col("time_based_key").desc())
    return seen.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def double_seen(seen: DataFrame) -> DataFrame:
    """Instances that were reported as seen more than once, which is an error of the sender."""
    return seen.groupBy("transaction", "time_based_key").agg(F.count("*").alias("times")).filter("times > 1")


def ledger(seen: DataFrame, written: DataFrame) -> DataFrame:
    """One row per current transaction: total_msgs, written, commit_wal_start, ledger_seq, complete.

    A transaction that was written before it was seen stands in the ledger with total_msgs 0 and is not complete. It
    stands at its first report (report_seq of written, where there is one; otherwise after all others). Of several
    instances of a transaction the one that was seen or written last is current; what is reported for others is ignored."""
    reports = written if "report_seq" in written.columns else written.withColumn("report_seq", F.lit(None).cast("long"))
    done = reports.groupBy("transaction", "time_based_key").agg(F.sum("count").alias("written"), F.min("report_seq").alias("_first"), F.max("report_seq").alias("_last"))
    both = seen.join(done, ["transaction", "time_based_key"], "full_outer").withColumns({"written": F.coalesce("written", F.lit(0)), "total_msgs": F.coalesce("total_msgs", F.lit(0)), "_event": F.greatest("ledger_seq", "_last"), "ledger_seq": F.least("ledger_seq", "_first")})
    w = Window.partitionBy("transaction").orderBy(F.col("_event").desc_nulls_last(), F.col("time_based_key").desc())
    out = both.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "_event", "_first", "_last")
    return out.withColumn("complete", F.coalesce(F.col("commit_wal_start").isNotNull() & (F.col("commit_wal_start") != 0) & (F.col("written") == F.col("total_msgs")), F.lit(False)))


def dump(entries: DataFrame) -> DataFrame:
    """line: the ledger's entries in their order, as an operator reads them."""
    order = F.coalesce("ledger_seq", F.lit(2**63 - 1))
    text = F.format_string("%s %s: %s of %s written, commit at %s%s", "transaction", "time_based_key", "written", "total_msgs", F.coalesce(F.col("commit_wal_start").cast("string"), F.lit("-")), F.when(F.col("complete"), ", complete").otherwise(""))
    return entries.select(order.alias("ledger_seq"), text.alias("line")).orderBy("ledger_seq", "line")


def remaining(entries: DataFrame) -> DataFrame:
    """The entries that stay when those of the prefix were acknowledged and removed."""
    return with_prefix(entries).filter(~F.col("in_prefix")).drop("in_prefix")


def unequal_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Where two reports of messages by transaction instance differ: none, if they are equal."""
    own = lambda x, n: x.groupBy("transaction", "time_based_key").agg(F.sum("count").alias(n))
    return own(left, "left").join(own(right, "right"), ["transaction", "time_based_key"], "full_outer").filter("NOT left <=> right")


def with_prefix(entries: DataFrame, width: int = 100_000) -> DataFrame:
    """Adds in_prefix: the entry and all before it, in the order of ledger_seq, are complete."""
    gap = F.when(~F.col("complete"), 1).otherwise(0)
    return running(entries.withColumn("_all", F.lit(0)), "_gaps", gap, "sum", ["_all"], "ledger_seq", width=width).withColumn("in_prefix", F.coalesce(F.col("_gaps") == 0, F.lit(False))).drop("_gaps", "_all")


def progress(entries: DataFrame) -> DataFrame:
    """The position of the prefix's last transaction (null: none), what leaves the ledger and what stays."""
    p = with_prefix(entries)
    return p.agg(F.max_by("commit_wal_start", F.when(F.col("in_prefix"), F.col("ledger_seq"))).alias("progress_lsn"), F.count_if("in_prefix").alias("ledger_flushed"), F.count_if(~F.col("in_prefix")).alias("ledger_size"))


def acknowledged(reports: DataFrame, order: str = "report_seq", lsn: str = "progress_lsn") -> DataFrame:
    """Adds acked_lsn: positions only rise; a report at or below an earlier one changes nothing."""
    return running(reports.withColumn("_all", F.lit(0)), "acked_lsn", F.col(lsn), "max", ["_all"], order).drop("_all")
