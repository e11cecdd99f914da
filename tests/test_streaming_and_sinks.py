import gzip
import json

import pytest
from pyspark.sql import functions as F

from tidemark.config import PipelineConfig
from tidemark.functions.parse import with_prelude
from tidemark.operators import metrics
from tidemark.plans.replicate import batches, ledger_of, messages, routed
from tidemark.sinks.delivery import DeliveryError, Retry
from tidemark.sinks.objects import put_objects
from tidemark.sinks.queues import kafka_rows, publish_rabbit, put_kinesis
from tidemark.sources.replay import ReplaySource, keepalive_storm
from tidemark.sources.wal import event_stats, wal_events
from tidemark.streaming.pipeline import replicate, stats_stream
from tidemark.streaming.stateful import age_batches, stamp_stream

QUICK = Retry(first_s=0.001, total_s=0.02)


def _log(spark, data, path, n=200):
    rows = [r.asDict() for r in wal_events(spark, data).orderBy("ingest_seq").limit(n).collect()]
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return rows


def test_replay_source_stamps_across_micro_batches(spark, data, tmp_path):
    rows = _log(spark, data, tmp_path / "log.json", 95)
    spark.dataSource.register(ReplaySource)
    raw = spark.readStream.format("wal_replay").option("path", str(tmp_path / "log.json")).option("maxRowsPerBatch", "13").load()
    stamped = stamp_stream(with_prelude(raw))
    q = stamped.writeStream.format("memory").queryName("stamped").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = {r["ingest_seq"]: r["time_based_key"] for r in spark.table("stamped").collect()}
    assert got == {r["ingest_seq"]: f"{r['ingest_seq'] // 10}-{r['ingest_seq'] // 10 * 10}" for r in rows}


def test_replicate_restarts_from_its_checkpoint(spark, data, tmp_path):
    wal_events(spark, data).filter("ingest_seq < 300").coalesce(1).write.parquet(str(tmp_path / "in"))
    from tidemark.sources.replay import stream_log

    config, seen = PipelineConfig(sink="s3", partition_method="tablename", batch_size=20), []
    sink = lambda b, epoch: seen.extend(r["ingest_seq"] for r in b.select("ingest_seq").collect())
    for lo, hi in ((None, None), (300, 400)):
        if lo:
            wal_events(spark, data).filter(f"ingest_seq >= {lo} AND ingest_seq < {hi}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        replicate(stream_log(spark, str(tmp_path / "in")), config, sink, str(tmp_path / "cp")).awaitTermination(120)
    assert sorted(seen) == [i for i in range(400) if i % 10 not in (0, 9)]


def test_stats_stream_matches_the_batch(spark, data, tmp_path):
    event_stats(spark, data).coalesce(1).write.parquet(str(tmp_path / "s"))
    stream = stats_stream(spark.readStream.schema(event_stats(spark, data).schema).parquet(str(tmp_path / "s")), "1 hour")
    q = stream.writeStream.format("memory").queryName("stats_out").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(120)
    cols = ["bucket_ns", "component", "stat_name", "sum", "count", "min", "max"]
    batch = metrics.aggregated(event_stats(spark, data), 3600 * metrics.NS).select(cols)
    out = spark.table("stats_out").select(cols)
    assert out.count() > 50 and out.exceptAll(batch).count() == 0


def test_age_batches_close_full_and_idle(spark, tmp_path):
    spark.range(7).select(F.lit("k").alias("partition_key"), F.col("id").alias("ingest_seq"), F.concat(F.lit("j"), F.col("id").cast("string")).alias("json")).coalesce(1).write.parquet(str(tmp_path / "m"))
    stream = spark.readStream.schema("partition_key string, ingest_seq long, json string").parquet(str(tmp_path / "m"))
    q = age_batches(stream, 5, 200, 400).writeStream.format("memory").queryName("aged").trigger(processingTime="100 milliseconds").option("checkpointLocation", str(tmp_path / "cp")).start()
    import time

    for _ in range(120):
        if spark.table("aged").count() == 2:
            break
        time.sleep(0.5)
    q.stop()
    got = sorted((r["batch_no"], r["reason"], r["n_messages"], r["body"]) for r in spark.table("aged").collect())
    assert [g[0] for g in got] == [0, 1] and got[0][1:3] == ("full", 5) and got[1][1] in ("idle", "old") and got[1][3] == "j5\nj6"


@pytest.fixture(scope="module")
def batched(spark, data):
    config = PipelineConfig(sink="s3", partition_method="tablename", batch_size=30, routing="partition", workers=3)
    rows = messages(wal_events(spark, data), config)
    return config, rows, batches(rows, config).cache()


def test_plan_accounts_for_every_message(spark, batched):
    config, rows, b = batched
    assert b.count() == 1000
    assert ledger_of(rows, b).filter("NOT complete").count() == 0
    assert routed(b, config).groupBy("partition_key").agg(F.countDistinct("worker").alias("n")).filter("n > 1").count() == 0


def test_objects(spark, batched, tmp_path):
    out = str(tmp_path)

    def put(key, body):
        with open(f"{out}/{key.replace('/', '-')}", "wb") as f:
            f.write(body)

    report = put_objects(batched[2], put, "lake").collect()
    lines = [x for f in tmp_path.iterdir() for x in gzip.decompress(f.read_bytes()).decode().splitlines()]
    assert sum(r["written"] for r in report) == len(lines) == 1000
    assert all(json.loads(x)["operation"] for x in lines)


def _flaky():
    class Flaky:
        """Takes a record the second time it is offered."""

        def __init__(self):
            self.seen, self.held = set(), []

        def put_records(self, stream, records):
            taken = [r["Data"] in self.seen or i % 2 == 0 for i, r in enumerate(records)]
            self.seen |= {r["Data"] for r in records}
            return taken

        def publish(self, exchange, key, body):
            self.held.append((key, body))

        def confirmed(self):
            n, self.held = (len(self.held) + 1) // 2, []
            return n

    return Flaky


def test_queues(spark, batched):
    b = batched[2]
    assert sum(r["written"] for r in put_kinesis(b, "s", _flaky(), "tablename", QUICK).collect()) == 1000
    assert sum(r["written"] for r in publish_rabbit(b, "e", _flaky(), Retry(first_s=0.001, total_s=5)).collect()) == 1000
    assert kafka_rows(b, "transaction").filter("key IS NULL OR value IS NULL").count() == 0
    assert kafka_rows(b, "random").filter("key IS NOT NULL").count() == 0


def test_retry():
    calls = []
    with pytest.raises(DeliveryError):
        QUICK.call(lambda: calls.append(1) or 1 / 0)
    assert len(calls) > 2
    assert QUICK.call(lambda: 5) == (5, 1)


def test_keepalive_storm():
    assert keepalive_storm([0, 10, 20, 30, 40, 50]) and not keepalive_storm([0, 30, 60, 90, 120, 150])
