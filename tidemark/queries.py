"""Registered queries of the change-stream operators, each with SQL that computes the same from the base tables.

The Spark side makes log text from the tables and runs the real parser; the SQL never sees the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import PipelineConfig
from .functions import keys
from .functions.marshal import marshalled
from .functions.parse import parsed, with_columns, with_prelude
from .operators import batching, filters, keepalive, ledger, metrics, transactions
from .plans import counters, replicate
from .sinks.delivery import Retry, deliver
from .sources import wal
from .store import landed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SHIFT = 10**12


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---- the streams

def events(s: SparkSession, d: str) -> DataFrame:
    return parsed(wal.wal_events(s, d))


def stamped(s: SparkSession, d: str) -> DataFrame:
    return transactions.stamped(events(s, d))


def rows(s: SparkSession, d: str) -> DataFrame:
    """Keyed by table, with JSON."""
    late = with_columns(transactions.stamped(with_prelude(wal.wal_events(s, d))))
    return marshalled(late.withColumn("partition_key", F.col("relation")))


def slim(s: SparkSession, d: str) -> DataFrame:
    """What batch numbers and the ledger need of messages, keyed by table: neither text nor JSON. Landed, as they read it several times."""
    return landed(transactions.stamped(with_prelude(wal.wal_events(s, d))).select("ingest_seq", "operation", "relation", "transaction", "time_based_key", "wal_start", "server_time_ms", F.col("relation").alias("partition_key")), "slim")


EV = """
x AS (SELECT event_id // 8 AS xid, min((epoch_us(ts) // 1000)) AS lo, max((epoch_us(ts) // 1000)) AS hi FROM events GROUP BY 1),
w AS (
  SELECT xid * 10 AS seq, xid, 'BEGIN' AS op, '' AS rel, lo AS ms, NULL::BIGINT AS event_id FROM x
  UNION ALL SELECT xid * 10 + 9, xid, 'COMMIT', '', hi, NULL FROM x
  UNION ALL SELECT event_id // 8 * 10 + 1 + event_id % 8, event_id // 8,
    CASE WHEN event_type IN ('signup', 'purchase') THEN 'INSERT' WHEN event_type IN ('click', 'view') THEN 'UPDATE' ELSE 'DELETE' END,
    'public.' || event_type, (epoch_us(ts) // 1000), event_id FROM events),
s AS (SELECT *, 22021976 + 56 * seq AS lsn, xid || '-' || xid * 10 AS tkey FROM w)"""


def _lsn(x: str) -> str:
    return f"upper(to_hex(({x}) >> 32)) || '/' || upper(to_hex(({x}) & 4294967295))"


def _time(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%dT%H:%M:%SZ')"


def _crc(text: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i::INT, 1))::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, y: CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"


def _side(q: str, t: str, v: str) -> str:
    return f"""'{{"q":"{q}","t":"{t}","v":' || to_json(({v})::VARCHAR) || '}}'"""


def _pair(new: str | None, old: str | None) -> str:
    parts = [f"""'"{k}":' || {v}""" for k, v in (("new", new), ("old", old)) if v]
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


def _cols(**pairs: str) -> str:
    return "'{' || " + " || ',' || ".join(f"""'"{k}":' || {v}""" for k, v in sorted(pairs.items())) + " || '}'"


def _entry(ms: str, key: str, lsn: str, table: str, op: str, columns: str) -> str:
    return f"""'{{"time":"' || {_time(ms)} || '","time_ms":' || {ms} || ',"txn":"' || {key} || '","lsn":"' || {_lsn(lsn)} || '","table":"' || {table} || '","operation":"' || {op} || '","columns":' || {columns} || '}}'"""


_NULL = {t: _side("false", t, "'null'") for t in ("bigint", "text", "jsonb")}
_ID, _USER, _TYPE, _PROPS = _side("false", "bigint", "e.event_id"), _side("false", "bigint", "e.user_id"), _side("true", "text", "e.event_type"), _side("true", "jsonb", "e.props")
_EVENT_COLUMNS = f"""CASE
  WHEN op = 'DELETE' THEN {_cols(event_id=_pair(None, _ID))}
  WHEN op = 'INSERT' THEN {_cols(event_id=_pair(_ID, None), user_id=_pair(_USER, None), event_type=_pair(_TYPE, None), props=_pair(_PROPS, None))}
  WHEN e.event_type = 'click' THEN {_cols(event_id=_pair(_ID, None), user_id=_pair(_USER, _side("false", "bigint", "e.user_id + 1")), event_type=_pair(_TYPE, None), props=_pair(_PROPS, _NULL["jsonb"]))}
  ELSE {_cols(event_id=_pair(_ID, _NULL["bigint"]), user_id=_pair(_USER, _NULL["bigint"]), event_type=_pair(_TYPE, _NULL["text"]), props=_pair(_PROPS, _NULL["jsonb"]))} END"""
EVJ = EV + f""",
j AS (SELECT s.*, {_entry("ms", "tkey", "lsn", "rel", "op", _EVENT_COLUMNS)} AS json FROM s JOIN events e USING (event_id))"""
BATCHED = EVJ + """,
b AS (SELECT *, (row_number() OVER (PARTITION BY rel ORDER BY seq) - 1) // 100 AS batch_no FROM j),
bs AS (SELECT rel AS partition_key, batch_no, count(*) AS n_messages, sum(strlen(json))::BIGINT AS n_bytes, min(seq) AS first_seq, max(seq) AS last_seq, min(lsn) AS first_wal_start, min(ms) AS created_ms, max(ms) AS modified_ms FROM b GROUP BY ALL)"""


# ---- A: source, transactions

@query(f"WITH {EV} SELECT seq AS ingest_seq, lsn AS wal_start, ms AS server_time_ms, op AS operation, rel AS relation, CASE WHEN op IN ('BEGIN', 'COMMIT') THEN 0 WHEN op = 'DELETE' THEN 1 ELSE 4 END AS n_columns, CASE WHEN rel = 'public.click' THEN 3 ELSE 0 END AS n_old FROM s")
def a2_decode(s, d):
    return events(s, d).select("ingest_seq", "wal_start", "server_time_ms", "operation", "relation", F.size("columns").alias("n_columns"), F.size("old_columns").alias("n_old"))


@query(f"WITH {EV} SELECT seq AS ingest_seq, op AS operation, xid::VARCHAR AS transaction, tkey AS time_based_key FROM s")
def a4_txn_stamp(s, d):
    return stamped(s, d).select("ingest_seq", "operation", "transaction", "time_based_key")


@query(f"WITH {EV}, r AS (SELECT * FROM s UNION ALL SELECT * REPLACE (seq + {SHIFT} AS seq) FROM s WHERE xid <= 49), c AS (SELECT * FROM r WHERE op = 'COMMIT') SELECT seq AS ingest_seq, xid::VARCHAR AS transaction, coalesce(lsn <= max(lsn) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS is_dup FROM c")
def a5_dup_commits(s, d):
    twice = parsed(wal.redelivered(wal.wal_events(s, d), 49, SHIFT))
    return transactions.duplicate_commits(twice).filter("operation = 'COMMIT'").select("ingest_seq", "transaction", "is_dup")


@query(f"WITH {EV} SELECT seq AS ingest_seq, xid::VARCHAR AS transaction, (xid - 1)::VARCHAR AS open_transaction FROM s WHERE op = 'BEGIN' AND xid > 0 AND (xid - 1) % 7 = 0")
def a6_missing_commits(s, d):
    return transactions.missing_commits(parsed(wal.without_commits(wal.wal_events(s, d), 7))).select("ingest_seq", "transaction", "open_transaction")


@query(f"WITH {EV}, k AS (SELECT * FROM s WHERE NOT (op = 'COMMIT' AND xid % 7 = 0)) SELECT xid::VARCHAR AS transaction, tkey AS time_based_key, (SELECT max(lsn) FROM k) AS wal_start FROM s WHERE op = 'COMMIT' AND xid % 7 = 0")
def a7_recovery(s, d):
    return transactions.recovered(transactions.stamped(parsed(wal.without_commits(wal.wal_events(s, d), 7)))).filter("synthetic").select("transaction", "time_based_key", "wal_start")


@query(f"WITH {EV} SELECT 's0' AS slot, count(*) AS received, count(*) FILTER (seq % 11 = 0 AND event_id IS NOT NULL) AS invalid_msg FROM s")
def a10_invalid(s, d):
    return transactions.invalid_messages(parsed(wal.with_noise(wal.wal_events(s, d), 11)))


_REQUESTS = "r AS (SELECT user_id AS slot, event_id, epoch_us(ts) // 1000 AS ms FROM events)"


@query(f"WITH {_REQUESTS}, g AS (SELECT *, ms - lag(ms, 5) OVER (PARTITION BY slot ORDER BY ms, event_id) AS took FROM r) SELECT slot, event_id, took FROM g WHERE took < 600000000")
def a3_keepalive_storm(s, d):
    e = s.read.parquet(f"{d}/events.parquet").select(F.col("user_id").alias("slot"), "event_id", keys.epoch_ms(F.col("ts")).alias("ms"))
    return keepalive.storms(e, "ms", "event_id", within_ms=600_000_000).select("slot", "event_id", "took")


# ---- B: parser

@query(f"WITH {EV} SELECT rel AS relation, op AS operation, count(*) AS n FROM s GROUP BY ALL")
def b_parse_prelude(s, d):
    return events(s, d).groupBy("relation", "operation").agg(F.count("*").alias("n"))


_BODY = "CASE WHEN doc_id % 3 = 0 THEN replace(text, ' ', '''') ELSE text END"


@query(f"""WITH t AS (SELECT *, {_BODY} AS body FROM documents), c AS (
  SELECT doc_id * 4 + 1 AS ingest_seq, 'INSERT' AS operation, unnest([{{'side': 'new', 'name': 'doc_id', 'type': 'bigint', 'quoted': false, 'v': doc_id::VARCHAR}}, {{'side': 'new', 'name': 'text', 'type': 'text', 'quoted': true, 'v': body}}, {{'side': 'new', 'name': 'lang', 'type': 'character varying', 'quoted': true, 'v': lang}}]) AS u FROM t
  UNION ALL SELECT doc_id * 4 + 2, 'UPDATE', unnest([{{'side': 'old', 'name': 'doc_id', 'type': 'bigint', 'quoted': false, 'v': doc_id::VARCHAR}}, {{'side': 'old', 'name': 'text', 'type': 'text', 'quoted': true, 'v': body}}, {{'side': 'new', 'name': 'doc_id', 'type': 'bigint', 'quoted': false, 'v': doc_id::VARCHAR}}, {{'side': 'new', 'name': 'text', 'type': 'text', 'quoted': false, 'v': 'unchanged-toast-datum'}}, {{'side': 'new', 'name': 'n_chars', 'type': 'integer', 'quoted': false, 'v': n_chars::VARCHAR}}]) FROM t WHERE n_chars > 2000)
  SELECT ingest_seq, operation, u.side AS side, u.name AS name, u.type AS type, u.quoted AS quoted, md5(u.v) AS value_md5 FROM c""")
def b_parse_docs(s, d):
    p = parsed(wal.wal_docs(s, d)).filter("operation IN ('INSERT', 'UPDATE') AND parse_error IS NULL")
    side = lambda name, columns: F.transform(F.map_entries(columns), lambda e: F.struct(F.lit(name).alias("side"), e["key"].alias("name"), e["value"].alias("value")))
    both = p.select("ingest_seq", "operation", F.inline(F.concat(side("new", "columns"), side("old", "old_columns"))))
    return both.select("ingest_seq", "operation", "side", "name", F.col("value")["type"].alias("type"), F.col("value")["quoted"].alias("quoted"), F.md5(F.col("value")["value"].cast("binary")).alias("value_md5"))


@query("SELECT o_orderkey * 3 + 1 AS ingest_seq, 'public.orders, public.lineitem' AS relation, 0 AS n_columns FROM orders WHERE o_orderkey % 97 = 0")
def b5_truncate(s, d):
    return parsed(wal.wal_orders(s, d)).filter("operation = 'TRUNCATE'").select("ingest_seq", "relation", F.size("columns").alias("n_columns"))


@query("SELECT o_orderkey * 3 + 1 AS ingest_seq, 'public.orders' AS relation, 'UPDATE' AS operation, o_orderkey % 2 = 0 AS no_tuple_data, (o_orderkey % 2)::INT AS n_columns FROM orders")
def b6_no_tuple(s, d):
    return parsed(wal.wal_bare_updates(s, d)).select("ingest_seq", "relation", "operation", "no_tuple_data", F.size("columns").alias("n_columns"))


@query("""SELECT c_custkey AS ingest_seq, 'public."t: ' || c_mktsegment || '""s"' AS relation, '"a b[' || c_nationkey || ']"' AS name, '"ty""pe"' AS type, c_name AS value FROM customer""")
def b10_escaped(s, d):
    p = parsed(wal.wal_quoted_names(s, d))
    return p.select("ingest_seq", "relation", F.explode("columns")).select("ingest_seq", "relation", F.col("key").alias("name"), F.col("value")["type"].alias("type"), F.col("value")["value"].alias("value"))


# ---- C: filters

def _filtered(where: str) -> str:
    return f"WITH {EV} SELECT seq AS ingest_seq, op AS operation, rel AS relation FROM s WHERE {where}"


_SHOWN = ["ingest_seq", "operation", "relation"]


@query(_filtered("event_id IS NULL OR rel IN ('public.click', 'public.signup')"))
def c1_whitelist(s, d):
    return filters.filtered(events(s, d), ["public.click", "public.signup"], whitelist=True).select(_SHOWN)


@query(_filtered("rel NOT IN ('public.click', 'public.signup')"))
def c2_blacklist(s, d):
    return filters.filtered(events(s, d), ["public.click", "public.signup"]).select(_SHOWN)


@query(_filtered("event_id IS NULL OR regexp_matches(rel, 'i(ck|gn)') OR regexp_matches(rel, '^public[.]p')"))
def c3_whitelist_regex(s, d):
    return filters.filtered(events(s, d), ["i(ck|gn)", "^public[.]p"], whitelist=True, regex=True).select(_SHOWN)


@query(_filtered("event_id IS NULL OR NOT regexp_matches(rel, 'i(ck|gn)')"))
def c4_blacklist_regex(s, d):
    return filters.filtered(events(s, d), ["i(ck|gn)"], regex=True).select(_SHOWN)


@query(_filtered("true"))
def c5_passthrough(s, d):
    return filters.filtered(events(s, d)).select(_SHOWN)


@query(_filtered("event_id IS NULL"))
def c6_boundaries(s, d):
    return filters.filtered(events(s, d), [], whitelist=True).select(_SHOWN)


@query(f"WITH {EV}, p AS (SELECT count(*) FILTER (event_id IS NULL OR rel = 'public.view') AS a, count(*) AS n FROM s) SELECT 'filter' AS component, 'count' AS stat_type, 'passed' AS stat_name, 'msgs' AS unit, a AS value FROM p UNION ALL SELECT 'filter', 'count', 'filtered', 'msgs', n - a FROM p")
def c7_filter_stats(s, d):
    return filters.filter_stats(events(s, d), ["public.view"], whitelist=True)


# ---- D: keys

def _keyed(method: str, n: int = 1):
    return lambda s, d: stamped(s, d).select("ingest_seq", keys.partition_key(method, F.col("relation"), F.col("transaction"), n).alias("partition_key"))


for _name, _method, _n, _sql in (
    ("d1_none", "none", 1, "''"),
    ("d2_tablename", "tablename", 1, "rel"),
    ("d3_txn", "transaction", 1, "xid::VARCHAR"),
):
    QUERIES[_name] = _keyed(_method, _n)
    ORACLES[_name] = f"WITH {EV} SELECT seq AS ingest_seq, {_sql} AS partition_key FROM s"
QUERIES["d4_txn_bucket"] = _keyed("transaction-bucket", 5)
ORACLES["d4_txn_bucket"] = f"WITH {EV}, c AS (SELECT xid, {_crc('t')} % 5 AS k FROM (SELECT DISTINCT xid, xid::VARCHAR AS t FROM s)) SELECT seq AS ingest_seq, k::VARCHAR AS partition_key FROM s JOIN c USING (xid)"


@query(f"SELECT c_custkey, ({_crc('c_name')} % 1000)::BIGINT AS bucket FROM customer")
def d5_quick_hash(s, d):
    return s.read.parquet(f"{d}/customer.parquet").select("c_custkey", keys.quick_hash(F.col("c_name"), 1000).cast("long").alias("bucket"))


@query(f"WITH {EV} SELECT seq AS ingest_seq, {_lsn('lsn')} AS lsn, {_lsn('lsn * 1000003')} AS far FROM s")
def d6_lsn(s, d):
    return events(s, d).select("ingest_seq", keys.lsn_text(F.col("wal_start")).alias("lsn"), keys.lsn_text(F.col("wal_start") * 1000003).alias("far"))


@query(f"WITH {EV} SELECT seq AS ingest_seq, {_time('ms')} AS time, {_time('0')} AS zero FROM s")
def d7_time(s, d):
    return events(s, d).select("ingest_seq", keys.time_text(F.col("server_time_ms")).alias("time"), keys.time_text(F.lit(0).cast("long")).alias("zero"))


# ---- E: JSON

def _json(where: str):
    return lambda s, d: rows(s, d).filter(where).select("ingest_seq", "json")


for _name, _where, _sql in (("e1_delete", "operation = 'DELETE'", "op = 'DELETE'"), ("e6_null_to_value", "relation = 'public.view'", "rel = 'public.view'"), ("e7_insert", "operation = 'INSERT'", "op = 'INSERT'"), ("e11_json", "operation NOT IN ('BEGIN', 'COMMIT')", "true")):
    QUERIES[_name] = _json(_where)
    ORACLES[_name] = f"WITH {EVJ} SELECT seq AS ingest_seq, json FROM j WHERE {_sql}"


def _docs_json(old_values: bool):
    def run(s, d):
        m = marshalled(with_columns(transactions.stamped(with_prelude(wal.wal_docs(s, d)))), old_values)
        return m.filter("operation = 'UPDATE'").select("ingest_seq", F.md5(F.col("json").cast("binary")).alias("json_md5"), F.length("json").cast("long").alias("n"))

    return run


def _docs_sql(old_values: bool) -> str:
    i, t, n = _side("false", "bigint", "doc_id"), _side("true", "text", _BODY), _side("false", "integer", "n_chars")
    cols = _cols(doc_id=_pair(i, None), text=_pair(t, t if old_values else None), n_chars=_pair(n, _side("false", "integer", "'null'") if old_values else None))
    return f"SELECT ingest_seq, md5(json) AS json_md5, length(json)::BIGINT AS n FROM (SELECT doc_id * 4 + 2 AS ingest_seq, {_entry('doc_id', 'doc_id || chr(45) || doc_id * 4', '22021976 + 56 * (doc_id * 4 + 2)', chr(39) + 'public.documents' + chr(39), chr(39) + 'UPDATE' + chr(39), cols)} AS json FROM documents WHERE n_chars > 2000)"


QUERIES["e2_toast"], ORACLES["e2_toast"] = _docs_json(True), _docs_sql(True)
QUERIES["e3_toast_noold"], ORACLES["e3_toast_noold"] = _docs_json(False), _docs_sql(False)


def _orders_json(old_values: bool):
    def run(s, d):
        m = marshalled(with_columns(transactions.stamped(with_prelude(wal.wal_orders(s, d)))), old_values)
        return m.filter("operation = 'UPDATE'").select("ingest_seq", "json")

    return run


def _orders_sql(old_values: bool) -> str:
    char = "character(1)"
    key, cust, status, prio = _side("false", "bigint", "o_orderkey"), _side("false", "bigint", "o_custkey"), _side("true", char, "o_orderstatus"), _side("true", "text", "o_orderpriority")
    null = _side("false", "text", "'null'")
    if old_values:
        pairs = {"o_orderkey": _pair(key, None), "o_custkey": _pair(cust, _side("false", "bigint", "'null'")), "o_orderstatus": f"CASE WHEN o_orderstatus = 'O' THEN {_pair(status, None)} ELSE {_pair(status, _side('true', char, chr(39) + 'O' + chr(39)))} END", "o_orderpriority": f"CASE WHEN o_orderkey % 5 = 0 THEN {_pair(null, None)} ELSE {_pair(prio, null)} END"}
    else:
        pairs = {"o_orderkey": _pair(key, None), "o_custkey": _pair(cust, None), "o_orderstatus": _pair(status, None), "o_orderpriority": f"CASE WHEN o_orderkey % 5 = 0 THEN {_pair(null, None)} ELSE {_pair(prio, None)} END"}
    return f"SELECT o_orderkey * 3 + 1 AS ingest_seq, {_entry('(epoch_us(o_orderdate) // 1000)', 'o_orderkey || chr(45) || o_orderkey * 3', '22021976 + 56 * (o_orderkey * 3 + 1)', chr(39) + 'public.orders' + chr(39), chr(39) + 'UPDATE' + chr(39), _cols(**pairs))} AS json FROM orders WHERE o_orderkey % 97 <> 0"


QUERIES["e4_old_new"], ORACLES["e4_old_new"] = _orders_json(True), _orders_sql(True)
QUERIES["e5_no_old"], ORACLES["e5_no_old"] = _orders_json(False), _orders_sql(False)


@query(f"SELECT o_orderkey * 3 + 1 AS ingest_seq, {_entry('(epoch_us(o_orderdate) // 1000)', 'o_orderkey || chr(45) || o_orderkey * 3', '22021976 + 56 * (o_orderkey * 3 + 1)', chr(39) + 'public.orders, public.lineitem' + chr(39), chr(39) + 'TRUNCATE' + chr(39), chr(39) + '{}' + chr(39))} AS json FROM orders WHERE o_orderkey % 97 = 0")
def e8_truncate(s, d):
    return marshalled(with_columns(transactions.stamped(with_prelude(wal.wal_orders(s, d))))).filter("operation = 'TRUNCATE'").select("ingest_seq", "json")


@query(f"WITH {EV} SELECT op AS operation, count(*) AS n, count(*) FILTER (event_id IS NOT NULL) AS with_json FROM s GROUP BY op")
def e12_boundaries(s, d):
    return rows(s, d).groupBy("operation").agg(F.count("*").alias("n"), F.count("json").alias("with_json"))


@query(f"WITH {EV} SELECT 'marshaller' AS component, 'count' AS stat_type, unnest(['success', 'failure']) AS stat_name, 'msgs' AS unit, unnest([n - bad, bad]) AS value FROM (SELECT count(*) FILTER (event_id IS NOT NULL) AS n, count(*) FILTER (event_id % 17 = 0) AS bad FROM s)")
def e13_marshal_failure(s, d):
    good = F.col("operation").isin("BEGIN", "COMMIT") | (F.regexp_extract("wal_data", r"event_id\[bigint\]:(\d+)", 1).cast("long") % 17 != 0)
    late = with_columns(transactions.stamped(with_prelude(wal.wal_events(s, d))))
    return counters.marshaller(marshalled(late.withColumn("columns", F.when(good, F.col("columns")))))


# ---- F: batches

def numbered(s, d):
    """In batches of 100, without what is in them."""
    return batching.count_batches(slim(s, d), 100)


def batched(s, d):
    """In batches of 100. Messages are landed first: several plans below read them, and each would parse the log again."""
    return batching.count_batches(landed(rows(s, d), "messages"), 100)


_BATCH_COLUMNS = "partition_key, batch_no, n_messages, n_bytes, first_seq, last_seq, first_wal_start"


@query(f"WITH {EVJ} SELECT seq AS ingest_seq, rel AS partition_key, (row_number() OVER (PARTITION BY rel ORDER BY seq) - 1) // 100 AS batch_no FROM j")
def f2_count_batches(s, d):
    return numbered(s, d).select("ingest_seq", "partition_key", "batch_no")


@query(f"""WITH RECURSIVE {EVJ},
o AS (SELECT rel, seq, strlen(json) + strlen(rel) AS size, row_number() OVER (PARTITION BY rel ORDER BY seq) AS rn FROM j WHERE strlen(json) <= 330),
g AS (
  SELECT rel, seq, rn, 0::BIGINT AS batch_no, size::BIGINT AS used, 1 AS records FROM o WHERE rn = 1
  UNION ALL
  SELECT o.rel, o.seq, o.rn, CASE WHEN used + size > 20000 OR records >= 90 THEN batch_no + 1 ELSE batch_no END, CASE WHEN used + size > 20000 OR records >= 90 THEN size ELSE used + size END, CASE WHEN used + size > 20000 OR records >= 90 THEN 1 ELSE records + 1 END
  FROM g JOIN o ON o.rel = g.rel AND o.rn = g.rn + 1)
SELECT j.seq AS ingest_seq, j.rel AS partition_key, strlen(j.json) > 330 AS dropped, g.batch_no FROM j LEFT JOIN g USING (seq)""")
def f3_kinesis_batches(s, d):
    return batching.byte_batches(landed(rows(s, d), "messages"), F.col("partition_key"), max_records=90, max_bytes=20_000, max_record=330).select("ingest_seq", "partition_key", "dropped", "batch_no")


def _insert_docs_sql() -> str:
    cols = _cols(doc_id=_pair(_side("false", "bigint", "doc_id"), None), text=_pair(_side("true", "text", _BODY), None), lang=_pair(_side("true", "character varying", "lang"), None))
    return f"SELECT doc_id, lang, doc_id * 4 + 1 AS seq, {_entry('doc_id', 'doc_id || chr(45) || doc_id * 4', '22021976 + 56 * (doc_id * 4 + 1)', chr(39) + 'public.documents' + chr(39), chr(39) + 'INSERT' + chr(39), cols)} AS json FROM documents"


@query(f"WITH i AS ({_insert_docs_sql()}) SELECT seq AS ingest_seq, strlen(json) + strlen(doc_id || '-' || doc_id * 4) + 36 > 4000 AS dropped FROM i")
def f4_kafka_size(s, d):
    m = marshalled(with_columns(transactions.stamped(with_prelude(wal.wal_docs(s, d))))).filter("operation = 'INSERT'")
    return m.select("ingest_seq", batching.too_big(batching.kafka_size(F.col("json"), F.col("time_based_key")), 4000).alias("dropped"))


_KAFKA = PipelineConfig(sink="kafka", partition_method="tablename", batch_size=70, kafka_key="tablename", kafka_max_message_bytes=380)


@query(f"""WITH {EVJ}, k AS (SELECT *, strlen(json) + strlen(rel) + 36 > 380 AS dropped FROM j)
SELECT seq AS ingest_seq, rel AS partition_key, dropped, CASE WHEN NOT dropped THEN (row_number() OVER (PARTITION BY rel, dropped ORDER BY seq) - 1) // 70 END AS batch_no FROM k""")
def f4_kafka_batches(s, d):
    return replicate.batches(landed(replicate.messages(wal.wal_events(s, d), _KAFKA), "messages"), _KAFKA).select("ingest_seq", "partition_key", "dropped", "batch_no")


@query(f"WITH {EVJ} SELECT tkey AS time_based_key, count(*) AS total_msgs, count(*) FILTER (strlen(json) > 330) AS dropped FROM j GROUP BY tkey")
def f5_too_big(s, d):
    m = batching.byte_batches(landed(rows(s, d), "messages"), F.col("partition_key"), max_record=330)
    return m.groupBy("time_based_key").agg(F.count("*").alias("total_msgs"), F.count_if("dropped").alias("dropped"))


@query(f"""WITH {EVJ}, k AS (SELECT *, CASE WHEN rel <> 'public.view' THEN rel ELSE '' END AS key FROM j) SELECT key, count(*) AS n, count(*) FILTER (key = '') AS invalid FROM k GROUP BY key""")
def f6_invalid_drop(s, d):
    m = batching.rows_only(rows(s, d)).withColumn("key", F.when(F.col("relation") != "public.view", F.col("relation")).otherwise(""))
    return m.groupBy("key").agg(F.count("*").alias("n"), F.count_if(batching.invalid(F.col("json"), F.col("key"))).alias("invalid"))


@query(f"WITH {EV} SELECT xid::VARCHAR AS transaction, tkey AS time_based_key, '' AS partition_key, 0::BIGINT AS count FROM s GROUP BY xid, tkey HAVING count(*) FILTER (rel IN ('public.signup', 'public.purchase')) = 0")
def f8_empty_flush(s, d):
    config = PipelineConfig(sink="s3", partition_method="tablename", whitelist=("public.signup", "public.purchase"))
    m = landed(replicate.messages(wal.wal_events(s, d), config), "messages")
    return batching.empty_flushes(m, replicate.batches(m, config))


_NOW = "(SELECT max(ms) FROM j)"


@query(f"WITH {BATCHED} SELECT partition_key, batch_no, CASE WHEN modified_ms < {_NOW} - 3600000 THEN 'idle' WHEN created_ms < {_NOW} - 7200000 THEN 'old' WHEN n_messages >= 100 THEN 'full' END AS flush FROM bs")
def f9_age_flush(s, d):
    summary = landed(batching.batch_summary(batched(s, d)), "batches")
    now = summary.agg(F.max("modified_ms").alias("now"))
    return batching.age_flushes(summary.crossJoin(now), F.col("now"), 3_600_000, 7_200_000, 100).select("partition_key", "batch_no", "flush")


@query(f"WITH {EVJ}, k AS (SELECT xid::VARCHAR AS partition_key, sum(strlen(json))::BIGINT AS n_bytes FROM j GROUP BY xid) SELECT partition_key, n_bytes, (sum(n_bytes) OVER () - coalesce(sum(n_bytes) OVER (ORDER BY n_bytes DESC, partition_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) >= 500000 AS flush FROM k")
def f12_memory_flush(s, d):
    open_ = batching.rows_only(rows(s, d)).groupBy(F.col("transaction").alias("partition_key")).agg(F.sum(F.octet_length("json")).cast("long").alias("n_bytes"))
    return batching.memory_flushes(open_, 500_000)


@query(f"WITH {BATCHED} SELECT partition_key, batch_no, ((row_number() OVER (ORDER BY last_seq) - 1) % 4)::INT AS worker FROM bs")
def f13_round_robin(s, d):
    return batching.round_robin(batching.batch_summary(batched(s, d)), 4).select("partition_key", "batch_no", "worker")


@query(f"WITH {BATCHED}, c AS (SELECT partition_key, ({_crc('partition_key')} % 4)::INT AS worker FROM (SELECT DISTINCT partition_key FROM bs)) SELECT partition_key, batch_no, worker FROM bs JOIN c USING (partition_key)")
def f14_partition_route(s, d):
    return batching.by_partition(batching.batch_summary(batched(s, d)), 4).select("partition_key", "batch_no", "worker")


@query(f"WITH {EV} SELECT xid::VARCHAR AS transaction, tkey AS time_based_key, count(*) FILTER (event_id IS NOT NULL AND rel <> 'public.view') AS total_msgs, max(lsn) FILTER (op = 'COMMIT') AS commit_wal_start FROM s GROUP BY ALL")
def f15_txn_totals(s, d):
    return transactions.totals(filters.filtered(stamped(s, d), ["public.view"])).select("transaction", "time_based_key", "total_msgs", "commit_wal_start")


@query(f"WITH {BATCHED} SELECT rel AS partition_key, batch_no, xid::VARCHAR AS transaction, tkey AS time_based_key, count(*) AS count FROM b GROUP BY ALL")
def f16_batch_txns(s, d):
    return batching.batch_transactions(numbered(s, d))


@query(f"WITH {BATCHED} SELECT {_BATCH_COLUMNS} FROM bs")
def f17_batch_sizes(s, d):
    return batching.batch_summary(batched(s, d)).select(*_BATCH_COLUMNS.split(", "))


# ---- G: ledger. Batches of every 13th number of a table aren't written yet; transactions up to 19 come again and are written then.

LEDGER = BATCHED + """,
seen AS (SELECT xid::VARCHAR AS transaction, tkey AS time_based_key, count(*) FILTER (event_id IS NOT NULL) AS total_msgs, max(lsn) FILTER (op = 'COMMIT') AS commit_wal_start, max(seq) FILTER (op = 'COMMIT') AS ledger_seq FROM s GROUP BY ALL),
wr AS (SELECT xid::VARCHAR AS transaction, tkey AS time_based_key, count(*) AS written FROM b WHERE batch_no % 13 <> 12 GROUP BY ALL),
l AS (SELECT transaction, time_based_key, total_msgs, coalesce(written, 0)::BIGINT AS written, commit_wal_start, ledger_seq, coalesce(written, 0) = total_msgs AS complete FROM seen LEFT JOIN wr USING (transaction, time_based_key)),
p AS (SELECT *, min(complete::INT) OVER (ORDER BY ledger_seq ROWS UNBOUNDED PRECEDING) = 1 AS in_prefix FROM l)"""


def _ledger(s, d):
    m = slim(s, d)
    b = batching.count_batches(m, 100)
    return ledger.ledger(transactions.totals(m), batching.batch_transactions(b.filter("batch_no % 13 <> 12")))


@query(f"WITH {EV}, r AS (SELECT xid, seq, xid || '-' || xid * 10 AS k FROM s WHERE op = 'COMMIT' UNION ALL SELECT xid, seq + {SHIFT}, xid || '-' || (xid * 10 + {SHIFT}) FROM s WHERE op = 'COMMIT' AND xid <= 19) SELECT xid::VARCHAR AS transaction, max_by(k, seq) AS time_based_key FROM r GROUP BY xid")
def g1_latest_instance(s, d):
    twice = transactions.stamped(parsed(wal.redelivered(wal.wal_events(s, d), 19, SHIFT)))
    return ledger.latest_instances(transactions.totals(twice)).select("transaction", "time_based_key")


@query(f"WITH {LEDGER} SELECT transaction, total_msgs, written, complete FROM l")
def g3_complete(s, d):
    return _ledger(s, d).select("transaction", "total_msgs", "written", "complete")


#: Every fifth transaction was written in part and isn't seen yet; it stands where its first batch was reported.
WRITTEN = BATCHED + """,
seen AS (SELECT xid, tkey, count(*) FILTER (event_id IS NOT NULL) AS total_msgs, max(lsn) FILTER (op = 'COMMIT') AS commit_wal_start, max(seq) FILTER (op = 'COMMIT') AS ledger_seq FROM s WHERE xid % 5 <> 0 GROUP BY ALL),
wr AS (SELECT xid, tkey, count(*) AS written, min(last_seq) AS report_seq FROM b JOIN bs ON b.rel = bs.partition_key AND b.batch_no = bs.batch_no GROUP BY ALL),
l AS (SELECT xid, coalesce(total_msgs, 0)::BIGINT AS total_msgs, coalesce(written, 0)::BIGINT AS written, coalesce(commit_wal_start <> 0 AND written = total_msgs, false) AS complete, least(ledger_seq, report_seq) AS o FROM seen FULL JOIN wr USING (xid, tkey)),
p AS (SELECT *, min(complete::INT) OVER (ORDER BY o RANGE UNBOUNDED PRECEDING) = 1 AS in_prefix FROM l)"""


def _written_first(s, d):
    m = slim(s, d)
    b = landed(batching.count_batches(m, 100), "batched")
    sent = b.groupBy("partition_key", "batch_no").agg(F.max("ingest_seq").alias("report_seq"))
    written = batching.batch_transactions(b).join(sent, ["partition_key", "batch_no"])
    return ledger.ledger(transactions.totals(m.filter("CAST(transaction AS long) % 5 <> 0")), written)


@query(f"WITH {WRITTEN} SELECT xid::VARCHAR AS transaction, total_msgs, written, complete FROM l")
def g2_written(s, d):
    return _written_first(s, d).select("transaction", "total_msgs", "written", "complete")


@query(f"WITH {LEDGER} SELECT transaction, in_prefix FROM p")
def g4_contiguous(s, d):
    return ledger.with_prefix(_ledger(s, d)).select("transaction", "in_prefix")


@query(f"WITH {LEDGER} SELECT max_by(commit_wal_start, ledger_seq) FILTER (in_prefix) AS progress_lsn, count(*) FILTER (in_prefix) AS ledger_flushed, count(*) FILTER (NOT in_prefix) AS ledger_size FROM p")
def g5_progress(s, d):
    return ledger.progress(_ledger(s, d))


@query(f"WITH {LEDGER} SELECT coalesce(ledger_seq, 9223372036854775807)::BIGINT AS ledger_seq, transaction || ' ' || time_based_key || ': ' || written || ' of ' || total_msgs || ' written, commit at ' || commit_wal_start || CASE WHEN complete THEN ', complete' ELSE '' END AS line FROM l")
def g8_dump(s, d):
    return ledger.dump(_ledger(s, d))


@query(f"WITH {LEDGER} SELECT transaction, total_msgs, written FROM p WHERE NOT in_prefix")
def g9_remaining(s, d):
    return ledger.remaining(_ledger(s, d)).select("transaction", "total_msgs", "written")


@query(f"WITH {BATCHED} SELECT xid::VARCHAR AS transaction, tkey AS time_based_key, count(*) AS left, nullif(count(*) FILTER (batch_no % 13 <> 12), 0) AS right FROM b GROUP BY ALL HAVING count(*) <> count(*) FILTER (batch_no % 13 <> 12)".replace("AS left", 'AS "left"').replace("AS right", 'AS "right"'))
def g10_compare(s, d):
    b = landed(numbered(s, d), "batched")
    return ledger.unequal_counts(batching.batch_transactions(b), batching.batch_transactions(b.filter("batch_no % 13 <> 12")))


@query(f"WITH {EV}, r AS (SELECT seq AS report_seq, lsn - (xid % 3) * 1000 AS progress_lsn FROM s WHERE op = 'COMMIT') SELECT report_seq, max(progress_lsn) OVER (ORDER BY report_seq ROWS UNBOUNDED PRECEDING) AS acked_lsn FROM r")
def g6_ack(s, d):
    r = events(s, d).filter("operation = 'COMMIT'").select(F.col("ingest_seq").alias("report_seq"), (F.col("wal_start") - F.col("transaction").cast("long") % 3 * 1000).alias("progress_lsn"))
    return ledger.acknowledged(r).select("report_seq", "acked_lsn")


# ---- H: what sinks are given

@query(f"WITH {BATCHED}, r AS (SELECT partition_key, batch_no, (row_number() OVER (ORDER BY last_seq) - 1) % 4 AS worker FROM bs) SELECT worker || ': ' || json AS line FROM b JOIN r ON b.rel = r.partition_key AND b.batch_no = r.batch_no")
def h1_stdout(s, d):
    from .sinks.lines import stdout_lines

    b = landed(batched(s, d), "batched")
    return stdout_lines(b.join(batching.round_robin(batching.batch_summary(b), 4).select("partition_key", "batch_no", "worker"), ["partition_key", "batch_no"]))


@query(f"WITH {BATCHED} SELECT rel AS partition_key, batch_no, md5(string_agg(json || chr(10), '' ORDER BY seq)) AS body_md5 FROM b GROUP BY ALL")
def h2_s3_content(s, d):
    from .sinks.objects import objects

    return objects(batched(s, d), "lake").select("partition_key", "batch_no", F.md5("body").alias("body_md5"))


@query(f"WITH {BATCHED} SELECT partition_key, batch_no, 'raw/cdc/' || strftime(make_timestamp(created_ms * 1000), '%Y/%m/%d/%H/%Y%m%d%H%M%S') || '_' || first_wal_start || '.gz' AS key FROM bs")
def h3_s3_keys(s, d):
    return batching.batch_summary(batched(s, d)).select("partition_key", "batch_no", keys.s3_key("/raw//cdc/", F.col("created_ms"), F.col("first_wal_start")).alias("key"))


@query(f"WITH {EV} SELECT seq AS ingest_seq, lsn::VARCHAR AS by_position, rel AS by_batch FROM s WHERE event_id IS NOT NULL")
def h5_kinesis_key(s, d):
    return batching.rows_only(events(s, d)).select("ingest_seq", keys.kinesis_key("none", F.col("relation"), F.col("wal_start")).alias("by_position"), keys.kinesis_key("tablename", F.col("relation"), F.col("wal_start")).alias("by_batch"))


@query(f"WITH {EVJ}, b AS (SELECT *, (row_number() OVER (PARTITION BY rel ORDER BY seq) - 1) // 100 AS batch_no FROM j) SELECT seq AS ingest_seq, tkey AS by_txn, xid::VARCHAR AS by_xid, rel AS by_table, rel || '/' || batch_no AS by_batch FROM b")
def h7_kafka_key(s, d):
    b = numbered(s, d).withColumn("id", F.concat_ws("/", "partition_key", F.col("batch_no").cast("string")))
    args = [F.col(c) for c in ("time_based_key", "transaction", "relation", "id")]
    names = {"transaction": "by_txn", "transaction-constant": "by_xid", "tablename": "by_table", "batch": "by_batch"}
    return b.select("ingest_seq", *[keys.kafka_key(m, *args).alias(n) for m, n in names.items()])


@query(f"WITH {EV} SELECT rel || '.' || op AS routing_key, count(*) AS n FROM s WHERE event_id IS NOT NULL GROUP BY 1")
def h9_rabbit_key(s, d):
    return batching.rows_only(events(s, d)).groupBy(keys.routing_key(F.col("relation"), F.col("operation")).alias("routing_key")).agg(F.count("*").alias("n"))


@query(f"WITH {BATCHED} SELECT rel AS partition_key, batch_no, xid::VARCHAR AS transaction, tkey AS time_based_key, count(*) AS count FROM b GROUP BY ALL")
def h13_written_report(s, d):
    """What is reported of every batch after its write."""
    b = landed(batched(s, d), "batched")
    sent = deliver(batching.batch_summary(b).select("partition_key", "batch_no", "n_messages"), lambda row: row["n_messages"], Retry(), ["partition_key", "batch_no"])
    return batching.batch_transactions(b).join(sent.select("partition_key", "batch_no"), ["partition_key", "batch_no"])


@query(f"WITH {BATCHED} SELECT xid::VARCHAR AS transaction, tkey AS time_based_key, count(*) AS count FROM b GROUP BY ALL")
def h13_written_all(s, d):
    return batching.batch_transactions(numbered(s, d)).groupBy("transaction", "time_based_key").agg(F.sum("count").alias("count"))


@query(f"WITH {BATCHED} SELECT partition_key, batch_no, n_messages AS written, (1 + (batch_no % 3 = 1)::INT)::INT AS attempts FROM bs")
def h11_retry(s, d):
    """Every third batch fails once."""
    failed = set()

    def send(row):
        at = (row["partition_key"], row["batch_no"])
        if row["batch_no"] % 3 == 1 and at not in failed:
            failed.add(at)
            raise ConnectionError("try again")
        return row["n_messages"]

    return deliver(batching.batch_summary(batched(s, d)).select("partition_key", "batch_no", "n_messages"), send, Retry(first_s=0.0, jitter=0.0, total_s=1.0), ["partition_key", "batch_no"])


class _Refusing:
    """A queue that takes every other record of a first call, all of a later one, and confirms as many."""

    def __init__(self):
        self.calls, self.sent = 0, []

    def put_records(self, stream, records):
        self.calls += 1
        return [self.calls > 1 or i % 2 == 0 for i in range(len(records))]

    def publish(self, exchange, routing_key, body):
        self.sent.append(routing_key)

    def confirmed(self):
        self.calls += 1
        n, self.sent = len(self.sent), []
        return n if self.calls > 1 else n // 2


_SENT = f"WITH {BATCHED} SELECT partition_key, batch_no, n_messages AS written FROM bs"


@query(_SENT)
def h4_kinesis_put(s, d):
    from .sinks.queues import put_kinesis

    return put_kinesis(batched(s, d), "stream", _Refusing, "tablename", Retry(first_s=0.0, jitter=0.0)).select("partition_key", "batch_no", "written")


@query(_SENT)
def h8_rabbit_publish(s, d):
    from .sinks.queues import publish_rabbit

    return publish_rabbit(batched(s, d), "exchange", _Refusing, Retry(first_s=0.0, jitter=0.0)).select("partition_key", "batch_no", "written")


@query(f"WITH {EVJ} SELECT tkey AS key, md5(json) AS value_md5 FROM j")
def h6_kafka_rows(s, d):
    from .sinks.queues import kafka_rows

    return kafka_rows(batched(s, d), "transaction").select(F.col("key").cast("string").alias("key"), F.md5("value").alias("value_md5"))


# ---- I: metrics

@query(f"""WITH {EVJ}, dup AS (SELECT count(*) AS n FROM s WHERE op = 'COMMIT' AND xid <= 49), again AS (SELECT count(*) AS n FROM s WHERE xid <= 49),
k AS (SELECT *, strlen(json) + strlen(rel) + 36 > 380 AS dropped FROM j), b AS (SELECT rel, (row_number() OVER (PARTITION BY rel ORDER BY seq) - 1) // 70 AS batch_no FROM k WHERE NOT dropped), z AS (SELECT rel, batch_no, count(*) AS n FROM b GROUP BY ALL)
SELECT 'replication' AS component, 'count' AS stat_type, 'received' AS stat_name, 'msgs' AS unit, (SELECT count(*) FROM s) + (SELECT n FROM again) AS value
UNION ALL SELECT 'replication', 'count', 'txns', 'txns', (SELECT count(*) FROM s WHERE op = 'COMMIT') + (SELECT n FROM dup)
UNION ALL SELECT 'replication', 'count', 'txns_dup', 'txns', (SELECT n FROM dup)
UNION ALL SELECT 'replication', 'count', 'invalid_msg', 'msgs', 0
UNION ALL SELECT 'marshaller', 'count', 'success', 'msgs', (SELECT count(*) FROM j)
UNION ALL SELECT 'marshaller', 'count', 'failure', 'msgs', 0
UNION ALL SELECT 'batcher', 'count', 'batches', 'batches', (SELECT count(*) FROM z)
UNION ALL SELECT 'batcher', 'count', 'dropped_too_big', 'msgs', (SELECT count(*) FROM k WHERE dropped)
UNION ALL SELECT 'batcher', 'count', 'dropped_msg_invalid', 'msgs', 0
UNION ALL SELECT 'batcher', 'histogram', 'batch_size', 'msgs', n FROM z""")
def i_counters(s, d):
    twice = parsed(wal.redelivered(wal.wal_events(s, d), 49, SHIFT))
    m = landed(replicate.messages(wal.wal_events(s, d), _KAFKA), "messages")
    return counters.replication(twice).unionByName(counters.marshaller(m)).unionByName(counters.batcher(landed(replicate.batches(m, _KAFKA), "batched")))


_STATS = """st AS (SELECT 'c' || user_id % 3 AS component, CASE WHEN event_type IN ('signup', 'purchase') THEN 'count' ELSE 'histogram' END AS stat_type, event_type AS stat_name, 'cents' AS unit, round(value * 100)::BIGINT AS value, (epoch_us(ts) // 1000) * 1000000 AS ns, (epoch_us(ts) // 1000) * 1000000 + (event_id % 5) * 30000000000 AS arrival FROM events)"""
_AGG = _STATS + """, ag AS (SELECT ns - ns % {w} AS bucket_ns, component, stat_name, stat_type, unit, sum(value)::BIGINT AS sum, count(*) AS count, min(value) AS min, max(value) AS max, avg(value) AS avg FROM st {where} GROUP BY ALL)"""
_REP = _AGG + """, rp AS (SELECT bucket_ns, component, stat_type, unit, unnest(CASE WHEN stat_type = 'count' THEN [{{'n': stat_name, 'v': sum}}] ELSE [{{'n': stat_name, 'v': sum}}, {{'n': stat_name || '_avg', 'v': trunc(avg)::BIGINT}}, {{'n': stat_name || '_max', 'v': max}}, {{'n': stat_name || '_min', 'v': min}}] END) AS u FROM ag), r AS (SELECT bucket_ns, component, stat_type, unit, u.n AS stat_name, u.v AS value FROM rp)"""
HOUR = 3600 * metrics.NS
_HOURLY = _REP.format(w=HOUR, where="")


@query(f"WITH {_AGG.format(w=60 * metrics.NS, where='WHERE stat_type = ' + chr(39) + 'count' + chr(39))} SELECT bucket_ns, component, stat_name, unit, sum, count FROM ag")
def i_stats_count(s, d):
    return metrics.aggregated(wal.event_stats(s, d).filter("stat_type = 'count'")).select("bucket_ns", "component", "stat_name", "unit", "sum", "count")


@query(f"WITH {_AGG.format(w=HOUR, where='WHERE stat_type = ' + chr(39) + 'histogram' + chr(39))} SELECT bucket_ns, component, stat_name, unit, sum, count, min, max, trunc(avg)::BIGINT AS avg FROM ag")
def i_stats_histogram(s, d):
    return metrics.aggregated(wal.event_stats(s, d).filter("stat_type = 'histogram'"), HOUR).select("bucket_ns", "component", "stat_name", "unit", "sum", "count", "min", "max", F.col("avg").cast("long").alias("avg"))


def _reports(s, d):
    return metrics.reported(metrics.aggregated(wal.event_stats(s, d), HOUR))


@query(f"WITH {_HOURLY} SELECT * FROM r")
def i5_reported(s, d):
    return _reports(s, d)


_LAST = 1705276800 * metrics.NS  # 2024-01-15


@query(f"WITH {_HOURLY} SELECT bucket_ns, component, stat_name, sum FROM ag WHERE {_LAST} > bucket_ns + {HOUR} + 1000000000")
def i6_closed(s, d):
    return metrics.closed(metrics.aggregated(wal.event_stats(s, d), HOUR), F.lit(_LAST), HOUR).select("bucket_ns", "component", "stat_name", "sum")


@query(f"WITH {_AGG.format(w=60 * metrics.NS, where='WHERE NOT arrival > ns - ns % 60000000000 + 61000000000')} SELECT bucket_ns, component, stat_name, sum, count FROM ag")
def i7_late_drop(s, d):
    return metrics.aggregated(metrics.on_time(wal.event_stats(s, d))).select("bucket_ns", "component", "stat_name", "sum", "count")


@query(f"WITH {_HOURLY} SELECT strftime(make_timestamp(bucket_ns // 1000), '%Y-%m-%dT%H:%M:%SZ') || ' ' || component || ' ' || stat_name || ' ' || unit || ' ' || value AS line FROM r")
def i9_stdout_report(s, d):
    return metrics.stdout_lines(_reports(s, d))


@query(f"WITH {_HOURLY} SELECT 'cdc.' || component || '.' || stat_name || '.' || unit AS metric, CASE WHEN stat_type = 'count' THEN 'count' ELSE 'gauge' END AS kind, value, bucket_ns FROM r")
def i10_datadog_names(s, d):
    return metrics.datadog_metrics(_reports(s, d))
