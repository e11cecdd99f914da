"""Reply requests of a server's keepalives."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MOST, WITHIN_MS = 5, 100


def storms(requests: DataFrame, ms: str, order: str, slot: str = "slot", most: int = MOST, within_ms: int = WITHIN_MS) -> DataFrame:
    """The requests by which a slot's connection is of no use any more: `most` requests before came in less than within_ms in all (took). Requests of a slot are rare; they are told apart by order where their times are equal."""
    before = F.lag(ms, most).over(Window.partitionBy(slot).orderBy(ms, order))
    return requests.withColumn("took", F.col(ms) - before).filter(F.col("took") < within_ms)
