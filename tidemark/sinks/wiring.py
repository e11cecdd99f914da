"""The sink that a config names, as replicate() takes it: it writes a micro-batch and reports what was written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..config import PipelineConfig
from ..operators import batching
from ..plans.replicate import routed, written_counts
from ..store import landed
from . import queues
from .delivery import Retry
from .lines import print_batch
from .objects import put_objects

Sink = Callable[[DataFrame, int], DataFrame | None]


def _reported(batched: DataFrame, delivered: DataFrame) -> DataFrame:
    """Messages of the batches that were delivered, and those that were too big to be sent at all. Delivery happens here, once."""
    sent = landed(delivered, "delivered")
    own = batching.batch_transactions(batched.filter("batch_no IS NOT NULL")).join(sent.select("partition_key", "batch_no"), ["partition_key", "batch_no"])
    columns = ["transaction", "time_based_key", "count"]
    out = own.select(columns).unionByName(written_counts(batched.filter("dropped")).select(columns))
    out._tidemark_tables = (sent,)  # for who reads it last
    return out


def sink_for(config: PipelineConfig, client: Callable | None = None, target: str = "", retry: Retry | None = None, **options) -> Sink:
    """client: for s3 put(key, bytes), for kinesis and rabbitmq what makes a client; target: stream, exchange or topic. Options go to the Kafka writer, which needs servers."""
    if config.sink == "stdout":

        def lines(batched: DataFrame, epoch: int) -> None:
            print_batch(batched.join(routed(batched, config).select("partition_key", "batch_no", "worker"), ["partition_key", "batch_no"]), epoch)

        return lines
    if config.sink == "kafka":
        servers = options.pop("servers")
        return lambda batched, epoch: queues.write_kafka(batched, servers, target, config.kafka_key, **options)
    if client is None:
        raise ValueError(f"{config.sink} needs a client")
    write = {
        "s3": lambda batched: put_objects(batched, client, config.key_space, retry),
        "kinesis": lambda batched: queues.put_kinesis(batched, target, client, config.partition_method, retry),
        "rabbitmq": lambda batched: queues.publish_rabbit(batched, target, client, retry),
    }[config.sink]
    return lambda batched, epoch: _reported(batched, write(batched))
