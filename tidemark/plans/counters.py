"""Counters of the pipeline's components as metric samples, ready for the aggregator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..operators import transactions
from .replicate import routed

SAMPLE = "component string, stat_type string, stat_name string, unit string, value long"


def _samples(totals: DataFrame, component: str, counters: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per counter of a table of one row; counters: name -> (type, unit)."""
    rows = [F.struct(F.lit(component).alias("component"), F.lit(kind).alias("stat_type"), F.lit(name).alias("stat_name"), F.lit(unit).alias("unit"), F.col(name).cast("long").alias("value")) for name, (kind, unit) in counters.items()]
    return totals.select(F.inline(F.array(*rows)))


def _count(condition: Column, name: str) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False))).alias(name)


def replication(parsed_wal: DataFrame) -> DataFrame:
    """received, txns, txns_dup and invalid_msg of the source."""
    commits = transactions.duplicate_commits(parsed_wal)
    commit = F.col("operation") == "COMMIT"
    totals = commits.agg(F.count("*").alias("received"), _count(commit, "txns"), _count(F.col("is_dup"), "txns_dup"), F.count("parse_error").alias("invalid_msg"))
    return _samples(totals, "replication", {n: ("count", u) for n, u in (("received", "msgs"), ("txns", "txns"), ("txns_dup", "txns"), ("invalid_msg", "msgs"))})


def marshaller(rows: DataFrame) -> DataFrame:
    """success and failure: messages that have JSON, or should have."""
    totals = rows.agg(F.count("json").alias("success"), _count(F.col("failed"), "failure"))
    return _samples(totals, "marshaller", {n: ("count", "msgs") for n in ("success", "failure")})


def batcher(batched: DataFrame) -> DataFrame:
    """batches, dropped_too_big and dropped_msg_invalid, and batch_size, a sample for each batch."""
    totals = batched.agg(F.count_distinct(F.when(F.col("batch_no").isNotNull(), F.struct("partition_key", "batch_no"))).alias("batches"), _count(F.col("dropped"), "dropped_too_big"), _count(F.col("invalid"), "dropped_msg_invalid"))
    sizes = batched.filter("batch_no IS NOT NULL").groupBy("partition_key", "batch_no").agg(F.count("*").alias("batch_size"))
    return _samples(totals, "batcher", {"batches": ("count", "batches"), "dropped_too_big": ("count", "msgs"), "dropped_msg_invalid": ("count", "msgs")}).unionByName(_samples(sizes, "batcher", {"batch_size": ("histogram", "msgs")}))


def progress(totals: DataFrame) -> DataFrame:
    """ledger_size and ledger_flushed of what progress() gives."""
    return _samples(totals, "progress_tracker", {n: ("histogram", "entries") for n in ("ledger_size", "ledger_flushed")})


def transporter(delivered: DataFrame, sink: str) -> DataFrame:
    """success and failure (calls), and written (messages), of what deliver() reports."""
    totals = delivered.agg(F.count("*").alias("success"), F.coalesce(F.sum(F.col("attempts") - 1), F.lit(0)).alias("failure"), F.coalesce(F.sum("written"), F.lit(0)).alias("written"))
    return _samples(totals, f"{sink}_transport", {"success": ("count", "calls"), "failure": ("count", "calls"), "written": ("count", "msgs")})


def batches_by_worker(batched: DataFrame, config: PipelineConfig) -> DataFrame:
    """How many batches each worker gets."""
    return routed(batched, config).groupBy("worker").agg(F.count("*").alias("batches"))
