import gzip
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark import __main__ as cli
from tidemark.config import PipelineConfig
from tidemark.functions.parse import parsed, with_prelude
from tidemark.operators import batching, ledger, metrics, transactions
from tidemark.operators.ordered import running
from tidemark.plans.replicate import batches, flushes, messages
from tidemark.sinks.delivery import Retry
from tidemark.sinks.queues import kafka_tls, placeholder, put_kinesis
from tidemark.sinks.wiring import sink_for
from tidemark.sources import slot
from tidemark.sources.replay import ReplaySource, stream_log
from tidemark.sources.wal import event_stats, wal_events
from tidemark.streaming.pipeline import replicate, replicate_by_age, report_loop


# ---- running values

@pytest.mark.parametrize("width", [3, 1000])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_values(spark, width, inclusive):
    rnd = random.Random(width)
    rows = [(rnd.choice(["a", "b", None]), o, rnd.choice([None, rnd.randrange(50)])) for o in rnd.sample(range(200), 90)]
    df = spark.createDataFrame(rows, "k string, o long, v long").repartition(5)
    for kind in ("last", "max", "sum"):
        got = {(r["k"], r["o"]): r["x"] for r in running(df, "x", F.col("v"), kind, ["k"], "o", inclusive, width).collect()}
        want, state = {}, {}
        for k, o, v in sorted(rows, key=lambda r: r[1]):
            before = state.get(k)
            after = before if v is None else v if before is None or kind == "last" else max(before, v) if kind == "max" else before + v
            state[k] = after
            want[k, o] = after if inclusive else before
        assert got == {k: (v or 0) if kind == "sum" else v for k, v in want.items()}


def test_running_values_of_repeated_and_missing_orders(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 5), ("a", 2, 7), ("a", None, 9)], "k string, o long, v long")
    got = sorted((r["o"] or 0, r["x"]) for r in running(df, "x", F.col("v"), "sum", ["k"], "o").collect() if r["o"])
    assert got == [(1, 5), (1, 5), (2, 17)]


def test_the_narrow_exchange_is_made_once(spark, data):
    df = transactions.stamped(with_prelude(wal_events(spark, data)))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan or "ReusedQueryStage" in plan


# ---- batches

@pytest.mark.parametrize("width", [7, 40, 10**6])
def test_byte_batches_in_runs_are_those_of_one_fold(spark, width):
    rnd = random.Random(width)
    rows = [("INSERT", k, seq * 3 + i, "x" * rnd.choice([1, 5, 30, 90])) for i, k in enumerate(("p", "q", "rr")) for seq in rnd.sample(range(400), 130)]
    df = spark.createDataFrame(rows, "operation string, partition_key string, ingest_seq long, json string")
    for records, size in ((10, 200), (3, 10**6), (1000, 95), (4, 60)):
        got = {r["ingest_seq"]: r["batch_no"] for r in batching.byte_batches(df, F.col("partition_key"), records, size, 80, width).collect()}
        want, state = {}, {}
        for r in sorted(df.collect(), key=lambda r: r["ingest_seq"]):
            if len(r["json"]) > 80:
                want[r["ingest_seq"]] = None
                continue
            n = len(r["json"]) + len(r["partition_key"])
            no, used, held = state.get(r["partition_key"], (0, 0, 0))
            if held and (used + n > size or held >= records):
                no, used, held = no + 1, 0, 0
            state[r["partition_key"]] = no, used + n, held + 1
            want[r["ingest_seq"]] = no
        assert got == want


def test_memory_flushes_with_equal_sizes(spark):
    rnd = random.Random(3)
    rows = [(f"k{i:03d}", rnd.choice([1, 1, 1, 50, 700, 9000])) for i in range(200)]
    df = spark.createDataFrame(rows, "partition_key string, n_bytes long")
    for limit in (1, 60, 2000, 9000, 100_000, 10**9):
        got = {r["partition_key"]: r["flush"] for r in batching.memory_flushes(df, limit, width=64).collect()}
        want, left = {}, sum(n for _, n in rows)
        for k, n in sorted(rows, key=lambda r: (-r[1], r[0])):
            want[k] = left >= limit
            left -= n
        assert got == want


def test_kafka_size_counts_key_and_framing(spark, data):
    config = PipelineConfig(sink="kafka", partition_method="tablename", kafka_key="tablename", batch_size=40, kafka_max_message_bytes=380)
    rows = messages(wal_events(spark, data), config)
    got = batches(rows, config).select("json", "relation", "dropped", "batch_no", "invalid", "failed").collect()
    assert all(r["dropped"] == (36 + len(r["json"]) + len(r["relation"]) > 380) == (r["batch_no"] is None) and not r["invalid"] and not r["failed"] for r in got)
    assert 0 < sum(r["dropped"] for r in got) < len(got)


def test_flushes_of_the_data_path(spark, data):
    config = PipelineConfig(sink="s3", partition_method="tablename", batch_size=50, update_age_ms=3_600_000, max_age_ms=7_200_000, memory_soft_limit=30_000)
    b = batches(messages(wal_events(spark, data), config), config)
    now = b.agg(F.max("server_time_ms")).first()[0]
    got = [r.asDict() for r in flushes(b, config, F.lit(now)).collect()]
    assert {r["flush"] for r in got} >= {"idle"} and all(r["modified_ms"] < now - 3_600_000 for r in got if r["flush"] == "idle")
    rest = sorted((r["n_bytes"] for r in got if r["flush"] is None), reverse=True)
    assert sum(rest) < 30_000


def test_messages_without_a_key_stop_the_query(spark, data):
    config = PipelineConfig(sink="s3", partition_method="tablename")
    rows = messages(wal_events(spark, data), config)
    with pytest.raises(Exception, match="no partition key"):
        batches(rows.withColumn("partition_key", F.when(F.col("ingest_seq") != 11, F.col("partition_key"))), config).select("operation", "batch_no").collect()


def test_messages_without_columns_fail_and_are_not_written(spark, data):
    config = PipelineConfig(sink="kinesis", partition_method="tablename")
    rows = messages(wal_events(spark, data), config).withColumn("failed", F.col("ingest_seq") % 40 == 1).withColumn("json", F.when(~F.col("failed"), F.col("json")))
    b = batches(rows, config)
    assert b.filter("failed AND batch_no IS NOT NULL").count() == 0 and b.filter("failed").count() == rows.filter("failed AND operation NOT IN ('BEGIN', 'COMMIT')").count() > 0


# ---- ledger

def test_written_before_seen(spark):
    seen = spark.createDataFrame([("1", "1-0", 2, 100, 9), ("3", "3-20", 1, 300, 29), ("4", "4-30", 1, 400, 39), ("4", "4-70", 1, 800, 79)], "transaction string, time_based_key string, total_msgs long, commit_wal_start long, ledger_seq long")
    written = spark.createDataFrame([("1", "1-0", 2, 5), ("2", "2-10", 1, 15), ("3", "3-20", 1, 25), ("4", "4-30", 1, 35), ("4", "4-70", 1, 75)], "transaction string, time_based_key string, count long, report_seq long")
    entries = ledger.ledger(seen, written)
    got = {r["transaction"]: (r["time_based_key"], r["total_msgs"], r["written"], r["complete"], r["in_prefix"]) for r in ledger.with_prefix(entries).collect()}
    assert got == {"1": ("1-0", 2, 2, True, True), "2": ("2-10", 0, 1, False, False), "3": ("3-20", 1, 1, True, False), "4": ("4-70", 1, 1, True, False)}
    assert ledger.progress(entries).first()["progress_lsn"] == 100
    assert [r["line"] for r in ledger.dump(entries).collect()][:2] == ["1 1-0: 2 of 2 written, commit at 100, complete", "2 2-10: 1 of 0 written, commit at -"]
    assert ledger.remaining(entries).count() == 3
    assert ledger.double_seen(seen.union(seen.limit(1))).count() == 1 and ledger.unequal_counts(written, written).count() == 0


# ---- streams

def _large_transaction(spark, n):
    """A BEGIN, n rows, a COMMIT, and a small transaction after them."""
    row = F.when(F.col("id") == 0, "BEGIN 7").when(F.col("id") == n + 1, "COMMIT 7").when(F.col("id") == n + 2, "BEGIN 8").when(F.col("id") == n + 4, "COMMIT 8").otherwise(F.concat(F.lit("table public.t"), (F.col("id") % 3).cast("string"), F.lit(": INSERT: id[bigint]:"), F.col("id").cast("string")))
    return spark.range(n + 5).select(F.col("id").alias("ingest_seq"), F.lit("s0").alias("slot"), (F.col("id") * 10 + 1000).alias("wal_start"), (F.col("id") * 10 + 1000).alias("server_wal_end"), F.col("id").alias("server_time_ms"), row.alias("wal_data"))


def test_a_transaction_longer_than_micro_batches(spark, tmp_path):
    n, cut = 50_000, 10_000
    raw = _large_transaction(spark, n).cache()
    for k in range(0, n + 5, cut):
        raw.filter(f"ingest_seq >= {k} AND ingest_seq < {k + cut}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    config, acked, epochs = PipelineConfig(sink="s3", partition_method="tablename", batch_size=4_000), [], []

    def sink(batched, epoch):
        epochs.append(epoch)
        batched.select("ingest_seq", "transaction", "time_based_key", "json", "partition_key", "batch_no").write.mode("append").parquet(str(tmp_path / "out"))

    replicate(stream_log(spark, str(tmp_path / "in")), config, sink, str(tmp_path / "cp"), acknowledge=acked.append).awaitTermination(600)
    assert len(epochs) >= 5
    out = spark.read.parquet(str(tmp_path / "out"))
    whole = batches(messages(raw, config), config)
    same = ["ingest_seq", "transaction", "time_based_key", "json", "partition_key"]
    assert out.count() == n + 1 and out.select(same).exceptAll(whole.select(same)).count() == 0
    numbers = out.groupBy("partition_key", "batch_no").agg(F.count("*").alias("n"), F.min("ingest_seq").alias("lo"), F.max("ingest_seq").alias("hi")).orderBy("partition_key", "lo").collect()
    for a, b in zip(numbers, numbers[1:], strict=False):
        assert a["partition_key"] != b["partition_key"] or (a["hi"] < b["lo"] and a["batch_no"] + 1 == b["batch_no"])
    assert all(r["n"] <= 4_000 for r in numbers)
    assert acked[-1] == (n + 4) * 10 + 1000 and acked == sorted(acked) and len(set(acked)) == len(acked)
    raw.unpersist()


def test_nothing_is_acknowledged_that_the_sink_did_not_write(spark, tmp_path):
    raw = _large_transaction(spark, 30).cache()
    raw.coalesce(1).write.parquet(str(tmp_path / "in"))
    config, acked = PipelineConfig(sink="s3", partition_method="tablename"), []
    sink = lambda b, epoch: b.filter("transaction = '8'").groupBy("transaction", "time_based_key").agg(F.count("*").alias("count"))
    replicate(stream_log(spark, str(tmp_path / "in")), config, sink, str(tmp_path / "cp"), acknowledge=acked.append).awaitTermination(120)
    assert acked == []
    raw.unpersist()


def test_sinks_by_config_report_what_was_written(spark, tmp_path):
    raw = _large_transaction(spark, 400).cache()
    for k in range(0, 405, 150):
        raw.filter(f"ingest_seq >= {k} AND ingest_seq < {k + 150}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    config = PipelineConfig(sink="s3", partition_method="tablename", batch_size=60, key_space="lake/raw", tags={"env": "test"})
    out = tmp_path / "objects"
    out.mkdir()

    def put(key, data):
        (out / key.replace("/", "_")).write_bytes(data)

    acked, samples = [], []
    report = lambda s, e: samples.extend((e, r["component"], r["stat_name"], r["value"]) for r in s.collect())
    replicate(stream_log(spark, str(tmp_path / "in")), config, sink_for(config, put, retry=Retry(first_s=0, total_s=0)), str(tmp_path / "cp"), acknowledge=acked.append, metrics=report).awaitTermination(300)
    lines = [json.loads(x) for f in out.iterdir() for x in gzip.decompress(f.read_bytes()).decode().splitlines()]
    assert len(lines) == 401 and all(f.name.startswith("lake_raw_") for f in out.iterdir())
    assert acked[-1] == 404 * 10 + 1000
    total = lambda c, n: sum(v for _, a, b, v in samples if (a, b) == (c, n))
    assert total("marshaller", "success") == total("batcher", "batch_size") == 401 and total("progress_tracker", "ledger_flushed") == 2
    tagged = metrics.datadog_metrics(spark.createDataFrame([(0, "c", "count", "u", "n", 1)], "bucket_ns long, component string, stat_type string, unit string, stat_name string, value long"), tags=config.tags)
    assert tagged.first()["tags"] == ["env:test"]
    raw.unpersist()


def test_batches_by_age_in_the_data_path(spark, tmp_path):
    raw = _large_transaction(spark, 40).cache()
    for k in range(0, 45, 15):
        raw.filter(f"ingest_seq >= {k} AND ingest_seq < {k + 15}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    config, got = PipelineConfig(sink="s3", partition_method="tablename", batch_size=8, update_age_ms=1500, max_age_ms=4000, tick_ms=200, whitelist=("public.t0", "public.t1")), []
    q = replicate_by_age(stream_log(spark, str(tmp_path / "in")), config, lambda b, e: got.extend(b.collect()), str(tmp_path / "cp"))
    deadline = time.time() + 120
    while sum(r["n_messages"] for r in got) < 27 and time.time() < deadline:
        time.sleep(0.5)
    q.stop()
    lines = {r["partition_key"]: [json.loads(x) for b in sorted(got, key=lambda b: b["batch_no"]) if b["partition_key"] == r["partition_key"] for x in b["body"].split("\n")] for r in got}
    want = {k: [i for i in (*range(1, 41), 43) if i % 3 == k] for k in (0, 1)}
    assert {k: [int(x["columns"]["id"]["new"]["v"]) for x in v] for k, v in lines.items()} == {f"public.t{k}": v for k, v in want.items()}
    assert all(x["txn"] == ("7-0" if x["time_ms"] < 42 else "8-42") for v in lines.values() for x in v)
    assert {r["reason"] for r in got} >= {"full"} and {r["reason"] for r in got} & {"idle", "old"} and all(r["n_messages"] <= 8 for r in got)
    raw.unpersist()


def test_report_loop(spark, data, tmp_path):
    event_stats(spark, data).coalesce(1).write.parquet(str(tmp_path / "s"))
    got = []
    q = report_loop(spark.readStream.schema(event_stats(spark, data).schema).parquet(str(tmp_path / "s")), lambda r, e: got.extend(r.collect()), str(tmp_path / "cp"), "1 hour", every={"availableNow": True})
    q.awaitTermination(120)
    assert len(got) > 50 and {r["stat_name"] for r in got} >= {"signup", "view", "view_avg", "view_max", "view_min"}


# ---- slot

class _Server:
    """Connections over a script: lists of messages and errors, one list a connection."""

    def __init__(self, *scripts):
        self.scripts, self.started, self.statuses, self.closed = [list(s) for s in scripts], [], [], 0

    def __call__(self):
        if not self.scripts:
            raise ConnectionRefusedError("gone")
        server, script = self, self.scripts.pop(0)
        if isinstance(script, list) and script and isinstance(script[0], OSError):
            raise script[0]

        class Conn:
            def start(self, name, lsn):
                server.started.append((name, lsn))

            def receive(self, timeout_s):
                m = script.pop(0) if script else None
                if isinstance(m, Exception):
                    raise m
                return m

            def send_status(self, lsn, forced):
                server.statuses.append((lsn, forced))

            def close(self):
                server.closed += 1

        return Conn()


def _data(lsn, text):
    return slot.Data(lsn, lsn, lsn, text)


def _session(server, **options):
    return slot.SlotSession(server, backoff=slot.Backoff(sleep=lambda s: None), **options)


def test_slot_session_answers_and_acknowledges():
    server = _Server([slot.Keepalive(50), _data(60, "BEGIN 1"), slot.Keepalive(65, True), _data(70, "table t: INSERT: a[b]:1"), _data(80, "COMMIT 1")])
    s = _session(server)
    rows = s.receive(0, 10)
    assert [(r[0], r[2], r[5]) for r in rows] == [(0, 60, "BEGIN 1"), (1, 70, "table t: INSERT: a[b]:1"), (2, 80, "COMMIT 1")]
    assert server.statuses == [(50, True)] and s.receive(0, 2) == rows[:2]
    s.acknowledge(3)
    assert server.statuses[-1] == (80, False) and s.receive(3, 5) == []


def test_slot_session_reconnects_where_it_stands():
    refused = [OSError("no")]
    server = _Server(refused, refused, [_data(1, "BEGIN 1")], [slot.Keepalive(50), _data(60, "BEGIN 1"), _data(65, "COMMIT 1"), OSError("lost")], [slot.Keepalive(90), _data(70, "BEGIN 2"), _data(75, "COMMIT 2")])
    waits = []
    s = slot.SlotSession(server, backoff=slot.Backoff(jitter=0, sleep=waits.append))
    assert [r[5] for r in s.receive(0, 2)] == ["BEGIN 1", "COMMIT 1"] and waits == [0.5, 0.75, 0.5 * 1.5**2]
    s.acknowledge(2)
    assert [r[5] for r in s.receive(2, 2)] == ["BEGIN 2", "COMMIT 2"]
    assert server.started == [("s0", 0), ("s0", 0), ("s0", 65)]
    longest = slot.Backoff(jitter=0).waits()
    assert max(next(longest) for _ in range(40)) == 20.0


def test_slot_session_reads_again_what_misses_its_commit():
    server = _Server([slot.Keepalive(50), _data(60, "BEGIN 1"), _data(70, "BEGIN 2")], [slot.Keepalive(50), _data(60, "BEGIN 1"), _data(65, "COMMIT 1"), _data(70, "BEGIN 2"), _data(75, "COMMIT 2")])
    assert [r[5] for r in _session(server).receive(0, 5)] == ["BEGIN 1", "BEGIN 1", "COMMIT 1", "BEGIN 2", "COMMIT 2"]


def test_slot_session_recovers_from_server_errors():
    server = _Server([slot.Keepalive(50), _data(60, "BEGIN 1"), _data(62, "table t: INSERT: a[b]:1"), slot.ServerError("broken", 500)], [slot.Keepalive(500), _data(510, "BEGIN 9")])
    rows = _session(server).receive(0, 4)
    assert [(r[2], r[5]) for r in rows] == [(60, "BEGIN 1"), (62, "table t: INSERT: a[b]:1"), (62, "COMMIT 1"), (510, "BEGIN 9")] and server.started[-1] == ("s0", 500)


def test_slot_session_gives_up_in_a_storm():
    server = _Server([slot.Keepalive(50), *[slot.Keepalive(60, True)] * 6])
    with pytest.raises(slot.StormError):
        _session(server, clock_ms=iter(range(0, 1000, 10)).__next__).receive(0, 1)
    slow = _Server([slot.Keepalive(50), *[slot.Keepalive(60, True)] * 6])
    assert _session(slow, clock_ms=iter(range(0, 10_000, 30)).__next__).receive(0, 1) == []


def test_slot_admin():
    said = []
    assert slot.create_slot(said.append, 'a"b') and said == ['CREATE_REPLICATION_SLOT "a""b" LOGICAL test_decoding']
    slot.drop_slot(said.append, "x")
    assert said[-1] == 'DROP_REPLICATION_SLOT "x" WAIT'

    def fails(code):
        def execute(statement):
            raise slot.SqlError(code)

        return execute

    assert not slot.create_slot(fails(slot.EXISTS), "x")
    with pytest.raises(slot.SqlError):
        slot.create_slot(fails("42501"), "x")


# ---- settings, sinks

def test_settings_from_several_places(tmp_path):
    env = {"TIDEMARK_WORKERS": "3", "TIDEMARK_WHITELIST": "public.a, public.b", "TIDEMARK_MARSHAL_OLD_VALUE": "false"}
    c = PipelineConfig.resolve({"workers": "4"}, env, {"workers": 5, "queue_depth": 7, "tags": {"a": "b"}})
    assert (c.workers, c.queue_depth, c.whitelist, c.marshal_old_value, c.tags, c.tick_ms) == (4, 7, ("public.a", "public.b"), False, {"a": "b"}, 1000)
    for bad in ({"workers": "0"}, {"workers": "x"}, {"queue_depth": 0}, {"tick_ms": "0"}, {"client_buffer": 0}, {"no_such": 1}, {"marshal_old_value": "maybe"}):
        with pytest.raises(ValueError):
            PipelineConfig.resolve(bad)
    (tmp_path / "c.json").write_text(json.dumps({"sink": "kafka", "batch_size": 9}))
    args = cli.parser().parse_args(["replicate", "s3", "--log", "x", "--checkpoint", "y", "--config", str(tmp_path / "c.json"), "--batch-size", "11", "--tags", "a=b,c=d"])
    c = cli.settings(args, env)
    assert (c.sink, c.size, c.workers, c.tags) == ("s3", 11, 3, {"a": "b", "c": "d"})


def test_command_line_replicates_a_log(spark, data, tmp_path, capsys):
    rows = [r.asDict() for r in wal_events(spark, data).orderBy("ingest_seq").limit(40).collect()]
    (tmp_path / "log.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    assert cli.main(["replicate", "stdout", "--log", str(tmp_path / "log.json"), "--checkpoint", str(tmp_path / "cp"), "--client-buffer", "15", "--once"]) == 0
    lines = [x for x in capsys.readouterr().out.split("\n") if x.startswith("0: {")]
    assert len(lines) == 32 and all(json.loads(x[3:])["txn"] for x in lines)


def test_clients_are_kept_for_a_task(spark, tmp_path):
    made = tmp_path / "made"

    def connect():
        with open(made, "a") as f:
            f.write("x")

        class Client:
            calls = 0

            def put_records(self, stream, records):
                Client.calls += 1
                if Client.calls == 2:
                    raise ConnectionError("lost")
                return [True] * len(records)

        return Client()

    rows = spark.createDataFrame([("INSERT", "k", i, "{}", 1, i // 2) for i in range(10)], "operation string, partition_key string, ingest_seq long, json string, wal_start long, batch_no long").coalesce(1)
    out = put_kinesis(rows, "s", connect, retry=Retry(first_s=0, jitter=0, total_s=1)).coalesce(1).collect()
    assert sum(r["written"] for r in out) == 10 and 2 <= len(made.read_text()) <= 1 + len(out)


def test_kafka_options(spark):
    assert kafka_tls() == {"kafka.security.protocol": "SSL"} and kafka_tls("c", "d", "e")["kafka.ssl.keystore.key"] == "e"
    with pytest.raises(ValueError):
        kafka_tls(cert="x")
    assert bytes(placeholder(spark).first()["value"]) == b"start"


def test_escaped_and_bare_rows(spark):
    raw = spark.createDataFrame([(1, 'table "a: b"."c""d": UPDATE: "x[y] z"[text]:\'1\''), (2, "table t: UPDATE: (no-tuple-data)"), (3, "table t: UPDATE: (no-tuple-data) ")], "ingest_seq long, wal_data string")
    got = {r["ingest_seq"]: r for r in parsed(raw).collect()}
    assert got[1]["relation"] == '"a: b"."c""d"' and list(got[1]["columns"]) == ['"x[y] z"'] and got[2]["no_tuple_data"] and not got[3]["no_tuple_data"]
    assert ReplaySource.name() == "wal_replay"
