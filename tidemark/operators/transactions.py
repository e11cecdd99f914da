"""Operators on transactions of a slot: stamping, duplicates, missing commits, recovery, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import running

BOUNDARIES = ("BEGIN", "COMMIT")


def stamped(wal: DataFrame, width: int = 100_000, before: DataFrame | None = None) -> DataFrame:
    """Every row gets the transaction and the time-based key (xid-<sequence of its BEGIN>, so that a redelivered transaction has another) of the last BEGIN before it. Rows before the first BEGIN get what was open on their slot before (slot, xid, key), where that is given."""
    begin = F.when(F.col("operation") == "BEGIN", F.struct(F.col("transaction").alias("xid"), F.concat_ws("-", "transaction", "ingest_seq").alias("key")))
    out = running(wal, "_begin", begin, "last", ["slot"], "ingest_seq", width=width)
    if before is not None:
        known = before.select(F.col("slot").alias("_slot"), F.struct("xid", "key").alias("_before"))
        out = out.join(known, F.col("slot").eqNullSafe(F.col("_slot")), "left").withColumn("_begin", F.coalesce("_begin", "_before")).drop("_slot", "_before")
    return out.withColumns({"transaction": F.coalesce("transaction", F.col("_begin")["xid"]), "time_based_key": F.col("_begin")["key"]}).drop("_begin")


def left_open(stamped_wal: DataFrame, before: DataFrame) -> DataFrame:
    """slot, xid, key of the last BEGIN of each slot, those of before (the same columns) included: what the rows after these are stamped with."""
    own = stamped_wal.filter("operation = 'BEGIN'").groupBy("slot").agg(F.max_by(F.struct("transaction", "time_based_key"), "ingest_seq").alias("b"))
    now = own.select("slot", F.col("b")["transaction"].alias("xid"), F.col("b")["time_based_key"].alias("key"))
    return now.unionByName(before.join(now.select("slot"), "slot", "left_anti"))


def duplicate_commits(wal: DataFrame, width: int = 100_000) -> DataFrame:
    """is_dup: a COMMIT at or below the highest earlier COMMIT. Rows stay."""
    commit = F.when(F.col("operation") == "COMMIT", F.col("wal_start"))
    out = running(wal, "_top", commit, "max", ["slot"], "ingest_seq", inclusive=False, width=width)
    return out.withColumn("is_dup", F.coalesce((F.col("operation") == "COMMIT") & (F.col("wal_start") <= F.col("_top")), F.lit(False))).drop("_top")


def missing_commits(wal: DataFrame, width: int = 100_000) -> DataFrame:
    """BEGIN rows that follow another BEGIN without a COMMIT between, with the transaction left open (open_transaction)."""
    edge = wal.filter(F.col("operation").isin(*BOUNDARIES))
    last = F.struct(F.col("operation").alias("op"), F.col("transaction").alias("xid"))
    out = running(edge, "_before", last, "last", ["slot"], "ingest_seq", inclusive=False, width=width)
    return out.filter((F.col("operation") == "BEGIN") & (F.col("_before")["op"] == "BEGIN")).withColumn("open_transaction", F.col("_before")["xid"]).drop("_before")


def recovered(stamped_wal: DataFrame) -> DataFrame:
    """Adds a synthetic COMMIT, at the highest position seen on the slot and after all its rows, for every transaction that has none. What the server had beyond it is given up: the caller asks for this."""
    open_ = stamped_wal.groupBy("slot", "time_based_key").agg(F.max(F.when(F.col("operation") == "COMMIT", 1).otherwise(0)).alias("_done"), F.max("transaction").alias("transaction")).filter("_done = 0 AND time_based_key IS NOT NULL")
    top = stamped_wal.groupBy("slot").agg(F.max("wal_start").alias("wal_start"), F.max("ingest_seq").alias("ingest_seq"))
    made = open_.join(top, "slot").select("slot", "transaction", "time_based_key", "wal_start", (F.col("ingest_seq") + 1).alias("ingest_seq"), F.lit("COMMIT").alias("operation"), F.lit("").alias("relation"), F.lit(True).alias("synthetic"))
    return stamped_wal.withColumn("synthetic", F.lit(False)).unionByName(made, allowMissingColumns=True)


def totals(messages: DataFrame) -> DataFrame:
    """Per transaction instance: total_msgs (rows that were batched, dropped ones too) and the COMMIT's position."""
    row = ~F.col("operation").isin(*BOUNDARIES)
    return messages.groupBy("transaction", "time_based_key").agg(F.sum(row.cast("long")).alias("total_msgs"), F.max(F.when(F.col("operation") == "COMMIT", F.col("wal_start"))).alias("commit_wal_start"), F.max(F.when(F.col("operation") == "COMMIT", F.col("ingest_seq"))).alias("ledger_seq"))


def invalid_messages(parsed_wal: DataFrame) -> DataFrame:
    """Counts of received and invalid messages of each slot."""
    return parsed_wal.groupBy("slot").agg(F.count("*").alias("received"), F.count("parse_error").alias("invalid_msg"))
