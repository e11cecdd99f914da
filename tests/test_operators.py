import json

import pytest
from pyspark.sql import functions as F

from tidemark.config import PipelineConfig
from tidemark.functions import keys
from tidemark.functions.marshal import marshalled
from tidemark.operators import batching, filters, ledger, metrics, transactions
from tidemark.operators.ordered import running
from tidemark.schema import COLUMNS


def _one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_keys(spark):
    assert [_one(spark, keys.partition_key("transaction-bucket", F.lit("t"), F.lit(x), 5)) for x in ("111111", "333333")] == ["4", "1"]
    assert [_one(spark, keys.quick_hash(F.lit(x), 2)) for x in ("bar", "foo")] == [0, 1]
    assert _one(spark, keys.lsn_text(F.lit(22021976).cast("long"))) == "0/1500758"
    assert _one(spark, keys.lsn_text(F.lit(-1).cast("long"))) == "FFFFFFFF/FFFFFFFF"
    assert _one(spark, keys.time_text(F.lit(0).cast("long"))) == "1970-01-01T00:00:00Z"
    ms = 946_868_645_678
    assert _one(spark, keys.s3_key("/a//b/", F.lit(ms), F.lit(1234))) == "a/b/2000/01/03/03/20000103030405_1234.gz"
    assert _one(spark, keys.s3_key("", F.lit(ms), F.lit(1))) == "2000/01/03/03/20000103030405_1.gz"
    with pytest.raises(ValueError):
        keys.partition_key("other", F.lit(""), F.lit(""))


def _cv(v, quoted=True, t="string"):
    return {"value": v, "type": t, "quoted": quoted}


MARSHAL = [
    ("INSERT", {"f": _cv("Foo")}, {}, True, {"f": {"new": {"q": "true", "t": "string", "v": "Foo"}}}),
    ("UPDATE", {"f": _cv("Foo")}, {"f": _cv("Bar")}, True, {"f": {"new": {"q": "true", "t": "string", "v": "Foo"}, "old": {"q": "true", "t": "string", "v": "Bar"}}}),
    ("UPDATE", {"f": _cv("Foo")}, {"f": _cv("Bar")}, False, {"f": {"new": {"q": "true", "t": "string", "v": "Foo"}}}),
    ("UPDATE", {"f": _cv("unchanged-toast-datum")}, {"f": _cv("Bar")}, True, {"f": {"new": {"q": "true", "t": "string", "v": "Bar"}, "old": {"q": "true", "t": "string", "v": "Bar"}}}),
    ("UPDATE", {"f": _cv("unchanged-toast-datum")}, {"f": _cv("Bar")}, False, {"f": {"new": {"q": "true", "t": "string", "v": "Bar"}}}),
    ("UPDATE", {"m": _cv("null", False), "l": _cv("Last")}, {}, True, {"l": {"new": {"q": "true", "t": "string", "v": "Last"}, "old": {"q": "false", "t": "string", "v": "null"}}, "m": {"new": {"q": "false", "t": "string", "v": "null"}}}),
    ("DELETE", {"id": _cv("2", False, "integer")}, {}, True, {"id": {"old": {"q": "false", "t": "integer", "v": "2"}}}),
    ("TRUNCATE", {}, {}, True, {}),
]


@pytest.mark.parametrize("case", MARSHAL, ids=lambda c: f"{c[0]}-{c[3]}")
def test_marshal(spark, case):
    op, new, old, keep, expected = case
    wal = spark.createDataFrame([(op, "t", 0, "0-0", 1, new, old)], f"operation string, relation string, server_time_ms long, time_based_key string, wal_start long, columns {COLUMNS}, old_columns {COLUMNS}")
    out = marshalled(wal, keep).first()["json"]
    assert out.startswith('{"time":"1970-01-01T00:00:00Z","time_ms":0,"txn":"0-0","lsn":"0/1","table":"t"')
    assert json.loads(out)["columns"] == expected
    assert list(json.loads(out)["columns"]) == sorted(expected)


def test_html_escape(spark):
    text = "<&>" + chr(0x2028)
    wal = spark.createDataFrame([("INSERT", "t", 0, "k", 1, {"a": _cv(text)}, {})], f"operation string, relation string, server_time_ms long, time_based_key string, wal_start long, columns {COLUMNS}, old_columns {COLUMNS}")
    out = marshalled(wal, html_escape=True).first()["json"]
    assert all(code in out for code in ("\\u003c", "\\u0026", "\\u003e", "\\u2028"))
    assert json.loads(out)["columns"]["a"]["new"]["v"] == text


def _wal(spark, rows):
    return spark.createDataFrame([(i, "s0", r[0], r[1], r[2] if len(r) > 2 else i, "t") for i, r in enumerate(rows)], "ingest_seq long, slot string, operation string, transaction string, wal_start long, relation string")


def test_transactions(spark):
    w = _wal(spark, [("BEGIN", "7"), ("INSERT", None), ("COMMIT", "7"), ("BEGIN", "7"), ("INSERT", None), ("BEGIN", "8"), ("COMMIT", "8", 2)])
    for width in (1, 2, 100):
        assert [(r["transaction"], r["time_based_key"]) for r in transactions.stamped(w, width).orderBy("ingest_seq").collect()] == [("7", "7-0")] * 3 + [("7", "7-3")] * 2 + [("8", "8-5")] * 2
        assert [r["is_dup"] for r in transactions.duplicate_commits(w, width).orderBy("ingest_seq").collect()] == [False] * 6 + [True]
        assert [(r["transaction"], r["open_transaction"]) for r in transactions.missing_commits(w, width).collect()] == [("8", "7")]
    made = transactions.recovered(transactions.stamped(w)).filter("synthetic").collect()
    assert [(r["transaction"], r["time_based_key"], r["wal_start"]) for r in made] == [("7", "7-3", 5)]


def test_running_matches_a_window(spark):
    from pyspark.sql import Window

    df = spark.range(500).select("id", (F.col("id") % 3).alias("k"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    for kind, f in (("last", lambda c, w: F.last(c, True).over(w)), ("max", lambda c, w: F.max(c).over(w)), ("sum", lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0)))):
        for inclusive in (True, False):
            w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
            a = running(df, "x", F.col("v"), kind, ["k"], "id", inclusive, width=13).select("id", "x")
            assert a.exceptAll(df.select("id", f(F.col("v"), w).alias("x"))).count() == 0


def test_filters(spark):
    w = _wal(spark, [("BEGIN", "7"), ("INSERT", None)])
    assert filters.filtered(w, ["t"], whitelist=True).count() == 2
    assert filters.filtered(w, [], whitelist=True).count() == 1
    assert filters.filtered(w, ["^x"], regex=True).count() == 2
    with pytest.raises(Exception):
        filters.passes(["("], True, True)


def test_batches(spark):
    m = spark.createDataFrame([(i, "k", "INSERT", "x" * n) for i, n in enumerate([4, 4, 20, 4, 4, 4])], "ingest_seq long, partition_key string, operation string, json string")
    rows = batching.byte_batches(m, F.col("partition_key"), max_records=3, max_bytes=10, max_record=15).orderBy("ingest_seq").collect()
    assert [(r["dropped"], r["batch_no"]) for r in rows] == [(False, 0), (False, 0), (True, None), (False, 1), (False, 1), (False, 2)]
    assert [r["batch_no"] for r in batching.count_batches(m, 4, width=2).orderBy("ingest_seq").collect()] == [0, 0, 0, 0, 1, 1]
    b = spark.createDataFrame([("a", 10), ("b", 30), ("c", 30), ("d", 5)], "partition_key string, n_bytes long")
    assert {r["partition_key"] for r in batching.memory_flushes(b, 45, width=7).filter("flush").collect()} == {"b"} | {"c"}
    ages = spark.createDataFrame([("e", 0, 0, 0), ("i", 1, 900, 300), ("o", 1, 100, 1000), ("f", 9, 900, 1000), ("n", 1, 900, 1000)], "partition_key string, n_messages long, created_ms long, modified_ms long")
    assert {r["partition_key"]: r["flush"] for r in batching.age_flushes(ages, F.lit(1200), 500, 1000, 9).collect()} == {"e": "empty", "i": "idle", "o": "old", "f": "full", "n": None}


def test_ledger(spark):
    seen = lambda rows: spark.createDataFrame(rows, "transaction string, time_based_key string, total_msgs long, commit_wal_start long, ledger_seq long")
    done = lambda rows: spark.createDataFrame(rows, "transaction string, time_based_key string, count long")
    p = ledger.progress(ledger.ledger(seen([("1", "1-1", 5, 888, 1), ("2", "2-1", 2, 999, 2)]), done([("1", "1-1", n) for n in (1, 1, 1, 2)] + [("2", "2-1", 1)]))).first()
    assert (p["progress_lsn"], p["ledger_flushed"], p["ledger_size"]) == (888, 1, 1)
    p = ledger.progress(ledger.ledger(seen([("1", "1-1", 10, 888, 1), ("1", "1-2", 10, 999, 2)]), done([("1", "1-1", 5)] + [("1", "1-2", n) for n in (2, 5, 3)]))).first()
    assert (p["progress_lsn"], p["ledger_flushed"], p["ledger_size"]) == (999, 1, 0)


def test_metrics(spark):
    ms = 1_000_000
    stats = spark.createDataFrame([("c", "count", "n", "u", 1, 1 * ms, 2 * ms), ("c", "count", "n", "u", 2, 9999 * ms, 9999 * ms), ("c", "histogram", "h", "u", 3, 1 * ms, 1 * ms), ("c", "histogram", "h", "u", 4, 2 * ms, 2 * ms), ("c", "count", "n", "u", 5, 1 * ms, 15_000 * ms)], "component string, stat_type string, stat_name string, unit string, value long, timestamp_ns long, arrival_ns long")
    width = 10 * metrics.NS
    on_time = metrics.on_time(stats, width_ns=width)
    assert on_time.count() == 4
    got = {r["stat_name"]: r["value"] for r in metrics.reported(metrics.aggregated(on_time, width)).collect()}
    assert got == {"n": 3, "h": 7, "h_avg": 3, "h_max": 4, "h_min": 3}


def test_config():
    for wrong in ({"sink": "x"}, {"whitelist": ("a",), "blacklist": ("b",)}, {"workers": 0}, {"batch_size": 0}):
        with pytest.raises(ValueError):
            PipelineConfig(**wrong)
    assert PipelineConfig(sink="s3").size == 50_000
