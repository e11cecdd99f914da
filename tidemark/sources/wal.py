"""Deterministic change streams made of ordinary tables, for tests, benchmarks and the registered queries.

The text is made here and goes through the real parser; expected results are computed from the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import epoch_ms

FIRST_LSN, LSN_STEP, PER_TXN = 22021976, 56, 8


def _quoted(value: Column) -> Column:
    return F.when(value.isNull(), F.lit("null")).otherwise(F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'")))


def _raw(rows: DataFrame) -> DataFrame:
    # a source's column: what reads it is not rewritten into the expression that makes it here
    text = F.when(F.monotonically_increasing_id() >= 0, F.col("wal_data")).alias("wal_data")
    lsn = (F.lit(FIRST_LSN) + F.lit(LSN_STEP) * F.col("ingest_seq")).cast("long")
    return rows.select("ingest_seq", F.lit("s0").alias("slot"), lsn.alias("wal_start"), lsn.alias("server_wal_end"), "server_time_ms", text)


def _framed(changes: DataFrame, xid: Column, step: int) -> DataFrame:
    """changes (ingest_seq, server_time_ms, wal_data) between a BEGIN and a COMMIT for each xid; a transaction has `step` sequence numbers."""
    edges = changes.groupBy(xid.alias("xid")).agg(F.min("server_time_ms").alias("lo"), F.max("server_time_ms").alias("hi"))
    begin = edges.select((F.col("xid") * step).alias("ingest_seq"), F.col("lo").alias("server_time_ms"), F.concat(F.lit("BEGIN "), F.col("xid").cast("string")).alias("wal_data"))
    commit = edges.select((F.col("xid") * step + step - 1).alias("ingest_seq"), F.col("hi").alias("server_time_ms"), F.concat(F.lit("COMMIT "), F.col("xid").cast("string")).alias("wal_data"))
    return _raw(begin.unionByName(commit).unionByName(changes.select("ingest_seq", "server_time_ms", "wal_data")))


def _op(event_type: Column) -> Column:
    return F.when(event_type.isin("signup", "purchase"), "INSERT").when(event_type.isin("click", "view"), "UPDATE").otherwise("DELETE")


def wal_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight events to a transaction. signup and purchase are inserts, click an update with old values (another user_id), view one without, the others deletes."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    xid = F.floor(F.col("event_id") / PER_TXN).cast("long")
    ident = F.concat(F.lit("event_id[bigint]:"), F.col("event_id").cast("string"))
    row = lambda user: F.concat(ident, F.lit(" user_id[bigint]:"), F.coalesce(user.cast("string"), F.lit("null")), F.lit(" event_type[text]:"), _quoted(F.col("event_type")), F.lit(" props[jsonb]:"), _quoted(F.col("props")))
    columns = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("old-key: "), ident, F.lit(" user_id[bigint]:"), (F.col("user_id") + 1).cast("string"), F.lit(" event_type[text]:"), _quoted(F.col("event_type")), F.lit(" new-tuple: "), row(F.col("user_id"))))
        .when(_op(F.col("event_type")) == "DELETE", ident)
        .otherwise(row(F.col("user_id")))
    )
    text = F.concat(F.lit("table public."), F.col("event_type"), F.lit(": "), _op(F.col("event_type")), F.lit(": "), columns)
    changes = e.select(xid.alias("xid"), (xid * 10 + 1 + F.col("event_id") % PER_TXN).alias("ingest_seq"), epoch_ms(F.col("ts")).alias("server_time_ms"), text.alias("wal_data"))
    return _framed(changes, F.col("xid"), 10)


def wal_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two changes to a transaction: an insert of the document (every third text has its blanks turned into quotes), and for long texts an update that leaves the text where it is."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    body = F.when(F.col("doc_id") % 3 == 0, F.replace("text", F.lit(" "), F.lit("'"))).otherwise(F.col("text"))
    cols = F.concat(F.lit("doc_id[bigint]:"), F.col("doc_id").cast("string"), F.lit(" text[text]:"), _quoted(body), F.lit(" lang[character varying]:"), _quoted(F.col("lang")))
    insert = d.select(F.col("doc_id").alias("xid"), (F.col("doc_id") * 4 + 1).alias("ingest_seq"), F.col("doc_id").cast("long").alias("server_time_ms"), F.concat(F.lit("table public.documents: INSERT: "), cols).alias("wal_data"))
    ident = F.concat(F.lit("doc_id[bigint]:"), F.col("doc_id").cast("string"))
    toast = F.concat(F.lit("table public.documents: UPDATE: old-key: "), ident, F.lit(" text[text]:"), _quoted(body), F.lit(" new-tuple: "), ident, F.lit(" text[text]:unchanged-toast-datum n_chars[integer]:"), F.col("n_chars").cast("string"))
    update = d.filter("n_chars > 2000").select(F.col("doc_id").alias("xid"), (F.col("doc_id") * 4 + 2).alias("ingest_seq"), F.col("doc_id").cast("long").alias("server_time_ms"), toast.alias("wal_data"))
    return _framed(insert.unionByName(update), F.col("xid"), 4)


def wal_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change to a transaction: the status goes to its present value from O (which may be no change), the customer from NULL, and the priority was unknown; every 97th key is a TRUNCATE."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    key = F.col("o_orderkey").cast("string")
    change = F.concat(
        F.lit("table public.orders: UPDATE: old-key: o_orderkey[bigint]:"), key, F.lit(" o_custkey[bigint]:null o_orderstatus[character(1)]:'O' new-tuple: o_orderkey[bigint]:"), key, F.lit(" o_custkey[bigint]:"), F.col("o_custkey").cast("string"), F.lit(" o_orderstatus[character(1)]:"), _quoted(F.col("o_orderstatus")), F.lit(" o_orderpriority[text]:"), F.when(F.col("o_orderkey") % 5 == 0, F.lit("null")).otherwise(_quoted(F.col("o_orderpriority")))
    )
    text = F.when(F.col("o_orderkey") % 97 == 0, F.lit("table public.orders, public.lineitem: TRUNCATE: cascade")).otherwise(change)
    changes = o.select(F.col("o_orderkey").alias("xid"), (F.col("o_orderkey") * 3 + 1).alias("ingest_seq"), epoch_ms(F.col("o_orderdate")).alias("server_time_ms"), text.alias("wal_data"))
    return _framed(changes, F.col("xid"), 3)


def wal_bare_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates of orders without a frame: of even keys nothing is told, of odd ones the key."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    told = F.when(F.col("o_orderkey") % 2 == 0, F.lit("(no-tuple-data)")).otherwise(F.concat(F.lit("o_orderkey[bigint]:"), F.col("o_orderkey").cast("string")))
    return _raw(o.select((F.col("o_orderkey") * 3 + 1).alias("ingest_seq"), epoch_ms(F.col("o_orderdate")).alias("server_time_ms"), F.concat(F.lit("table public.orders: UPDATE: "), told).alias("wal_data")))


def wal_quoted_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts into tables, with columns and types, whose quoted names hold colons, brackets, blanks and quotes."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    text = F.concat(F.lit('table public."t: '), F.col("c_mktsegment"), F.lit('""s": INSERT: "a b['), F.col("c_nationkey").cast("string"), F.lit(']"["ty""pe"]:'), _quoted(F.col("c_name")))
    return _raw(c.select(F.col("c_custkey").cast("long").alias("ingest_seq"), F.lit(0).cast("long").alias("server_time_ms"), text.alias("wal_data")))


def redelivered(wal: DataFrame, last_xid: int, shift: int) -> DataFrame:
    """wal, and transactions up to last_xid once more, later, at their old positions. The sequence is that of wal_events."""
    again = wal.filter(F.col("ingest_seq") < (last_xid + 1) * 10).withColumn("ingest_seq", F.col("ingest_seq") + shift)
    return wal.unionByName(again)


def without_commits(wal: DataFrame, every: int) -> DataFrame:
    """wal_events without the COMMIT of every so many transactions."""
    return wal.filter(~((F.col("ingest_seq") % 10 == 9) & (F.floor(F.col("ingest_seq") / 10) % every == 0)))


def with_noise(wal: DataFrame, every: int) -> DataFrame:
    """wal with the text of every so many rows cut short."""
    return wal.withColumn("wal_data", F.when(F.col("ingest_seq") % every == 0, F.substring("wal_data", 1, 9)).otherwise(F.col("wal_data")))


def event_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric samples: signups and purchases are counters, the others histograms of cents; arrival is up to two minutes late."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    ns = epoch_ms(F.col("ts")) * 1_000_000
    return e.select(
        F.concat(F.lit("c"), (F.col("user_id") % 3).cast("string")).alias("component"),
        F.when(F.col("event_type").isin("signup", "purchase"), "count").otherwise("histogram").alias("stat_type"),
        F.col("event_type").alias("stat_name"),
        F.lit("cents").alias("unit"),
        F.round(F.col("value") * 100).cast("long").alias("value"),
        ns.alias("timestamp_ns"),
        (ns + (F.col("event_id") % 5) * 30_000_000_000).alias("arrival_ns"),
    )
