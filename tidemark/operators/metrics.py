"""Pipeline metrics in tumbling buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import time_text

NS = 1_000_000_000
WIDTH_NS, GRACE_NS = 60 * NS, 1 * NS


def start_of(timestamp_ns: Column, width_ns: int = WIDTH_NS) -> Column:
    """The bucket's start; integers only, as nanoseconds are beyond a double."""
    return timestamp_ns - F.pmod(timestamp_ns, F.lit(width_ns))


def expired(bucket_ns: Column, now_ns: Column, width_ns: int = WIDTH_NS, grace_ns: int = GRACE_NS) -> Column:
    return now_ns > bucket_ns + width_ns + grace_ns


def on_time(stats: DataFrame, arrival: str = "arrival_ns", width_ns: int = WIDTH_NS) -> DataFrame:
    """Without what arrives for a bucket that has expired."""
    return stats.filter(~expired(start_of(F.col("timestamp_ns"), width_ns), F.col(arrival), width_ns))


def aggregated(stats: DataFrame, width_ns: int = WIDTH_NS) -> DataFrame:
    """sum, count, min, max and avg per bucket, component, name, type and unit."""
    return stats.groupBy(start_of(F.col("timestamp_ns"), width_ns).alias("bucket_ns"), "component", "stat_name", "stat_type", "unit").agg(
        F.sum("value").alias("sum"), F.count("value").alias("count"), F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("avg")
    )


def reported(aggregates: DataFrame) -> DataFrame:
    """Aggregates as stats again: a counter is one row, a histogram four (sum, truncated average, maximum, minimum)."""
    row = lambda suffix, value: F.struct(F.concat("stat_name", F.lit(suffix)).alias("stat_name"), value.cast("long").alias("value"))
    rows = F.when(F.col("stat_type") == "count", F.array(row("", F.col("sum")))).otherwise(F.array(row("", F.col("sum")), row("_avg", F.col("avg")), row("_max", F.col("max")), row("_min", F.col("min"))))
    return aggregates.select("bucket_ns", "component", "stat_type", "unit", F.inline(rows))


def closed(aggregates: DataFrame, now_ns: Column, width_ns: int = WIDTH_NS) -> DataFrame:
    """Only buckets that have expired at now."""
    return aggregates.filter(expired(F.col("bucket_ns"), now_ns, width_ns))


def stdout_lines(reports: DataFrame) -> DataFrame:
    return reports.select(F.concat_ws(" ", time_text(F.floor(F.col("bucket_ns") / 1_000_000).cast("long")), "component", "stat_name", "unit", F.col("value").cast("string")).alias("line"))


def datadog_metrics(reports: DataFrame, prefix: str = "cdc", tags: dict[str, str] | None = None) -> DataFrame:
    """Metric names and kinds as a statsd client takes them, with tags (name:value) where there are any."""
    out = reports.select(F.concat_ws(".", F.lit(prefix), "component", "stat_name", "unit").alias("metric"), F.when(F.col("stat_type") == "count", "count").otherwise("gauge").alias("kind"), "value", "bucket_ns")
    return out.withColumn("tags", F.array(*[F.lit(f"{k}:{v}") for k, v in sorted(tags.items())])) if tags else out
