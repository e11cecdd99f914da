"""Lines for a terminal or a log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stdout_lines(routed: DataFrame) -> DataFrame:
    """line: `<worker>: <json>` of every message."""
    return routed.select(F.concat(F.col("worker").cast("string"), F.lit(": "), F.col("json")).alias("line"))


def print_batch(routed: DataFrame, epoch: int = 0) -> None:
    """For foreachBatch. Lines come partition by partition, in order within a worker."""
    for row in stdout_lines(routed.repartition("worker").sortWithinPartitions("worker", "ingest_seq")).toLocalIterator():
        print(row["line"])
