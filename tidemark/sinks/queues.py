"""Queues: Kinesis, Kafka and RabbitMQ. Clients are made on the executors by a function that the caller gives."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import kafka_key, kinesis_key, routing_key
from .delivery import DeliveryError, Retry, deliver


class KinesisClient(Protocol):
    def put_records(self, stream: str, records: list[dict]) -> list[bool]:
        """Which records were taken."""


class RabbitChannel(Protocol):
    def publish(self, exchange: str, routing_key: str, body: bytes) -> None: ...

    def confirmed(self) -> int:
        """How many of the messages published since the last call were confirmed, from the first on."""


class Held:
    """One client for all batches of a task: made when it is first needed, and again after it failed."""

    def __init__(self, connect: Callable[[], object]):
        self.connect, self.client = connect, None

    def call(self, f: Callable[[object], object]) -> object:
        try:
            if self.client is None:
                self.client = self.connect()
            return f(self.client)
        except DeliveryError:
            raise  # the client answered; it is as good as before
        except Exception:
            self.client = None
            raise


def _bodies(batched: DataFrame, *parts) -> DataFrame:
    """One row per batch with its messages in order; a batch is bounded by its size."""
    own = batched.filter(F.col("batch_no").isNotNull() & F.col("json").isNotNull())
    return own.groupBy("partition_key", "batch_no").agg(F.array_sort(F.collect_list(F.struct("ingest_seq", "json", *parts))).alias("rows"))


def put_kinesis(batched: DataFrame, stream: str, connect: Callable[[], KinesisClient], partition_method: str = "none", retry: Retry | None = None) -> DataFrame:
    """Of a batch that was taken in part only the rest is sent again."""
    retry, held = retry or Retry(), Held(connect)

    def send(row) -> int:
        left, n = [{"Data": r["json"], "PartitionKey": r["key"]} for r in row["rows"]], len(row["rows"])

        def rest() -> None:
            nonlocal left
            taken = held.call(lambda client: client.put_records(stream, left))
            left = [r for r, ok in zip(left, taken, strict=True) if not ok]
            if left:
                raise DeliveryError(f"{len(left)} records were not taken")

        retry.call(rest)
        return n

    key = kinesis_key(partition_method, F.col("partition_key"), F.col("wal_start")).alias("key")
    return deliver(_bodies(batched, key), send, Retry(total_s=0), ["partition_key", "batch_no"])


def publish_rabbit(batched: DataFrame, exchange: str, connect: Callable[[], RabbitChannel], retry: Retry | None = None) -> DataFrame:
    """Messages are published under <table>.<operation>; what isn't confirmed is published again, from the first such message on."""
    retry, held = retry or Retry(), Held(connect)

    def send(row) -> int:
        left, n = list(row["rows"]), len(row["rows"])

        def publish(channel) -> int:
            for r in left:
                channel.publish(exchange, r["key"], r["json"].encode())
            return channel.confirmed()

        def rest() -> None:
            nonlocal left
            left = left[held.call(publish) :]
            if left:
                raise DeliveryError(f"{len(left)} messages were not confirmed")

        retry.call(rest)
        return n

    return deliver(_bodies(batched, routing_key(F.col("relation"), F.col("operation")).alias("key")), send, Retry(total_s=0), ["partition_key", "batch_no"])


def kafka_rows(batched: DataFrame, method: str = "batch") -> DataFrame:
    """key and value as the Kafka writer takes them."""
    batch_id = F.concat_ws("/", "partition_key", F.col("batch_no").cast("string"))
    return batched.filter(F.col("batch_no").isNotNull()).select(kafka_key(method, F.col("time_based_key"), F.col("transaction"), F.col("relation"), batch_id).cast("binary").alias("key"), F.col("json").cast("binary").alias("value"))


def write_kafka(batched: DataFrame, servers: str, topic: str, method: str = "batch", **options) -> None:
    """Needs Spark's Kafka connector on the class path. Values are compressed with snappy and acknowledged by all replicas, unless options say otherwise."""
    settings = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.compression.type": "snappy", "kafka.acks": "all"} | KAFKA_BACKOFF | options
    kafka_rows(batched, method).write.format("kafka").options(**settings).save()


def kafka_tls(ca: str | None = None, cert: str | None = None, key: str | None = None) -> dict[str, str]:
    """Options of write_kafka() for TLS with PEM texts; without any, the system's certificates are trusted."""
    out = {"kafka.security.protocol": "SSL"}
    if ca:
        out |= {"kafka.ssl.truststore.type": "PEM", "kafka.ssl.truststore.certificates": ca}
    if cert and key:
        out |= {"kafka.ssl.keystore.type": "PEM", "kafka.ssl.keystore.certificate.chain": cert, "kafka.ssl.keystore.key": key}
    elif cert or key:
        raise ValueError("a certificate and its key go together")
    return out


#: Metadata is asked for again with exponential waits, so that a cluster that elects leaders isn't flooded.
KAFKA_BACKOFF = {"kafka.retry.backoff.ms": "100", "kafka.retry.backoff.max.ms": "10000", "kafka.reconnect.backoff.ms": "50", "kafka.reconnect.backoff.max.ms": "10000"}


def placeholder(spark: SparkSession, text: str = "start") -> DataFrame:
    """One message of no table, as kafka_rows() would give it."""
    return spark.range(1).select(F.lit(None).cast("binary").alias("key"), F.lit(text).cast("binary").alias("value"))


def verify_kafka(spark: SparkSession, servers: str, topic: str, **options) -> None:
    """Writes a placeholder before anything is read from the slot: a topic that can't be written to fails here."""
    placeholder(spark).write.format("kafka").options(**{"kafka.bootstrap.servers": servers, "topic": topic} | KAFKA_BACKOFF | options).save()
