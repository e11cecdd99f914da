"""Table filters. BEGIN and COMMIT always pass."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOUNDARY = ("BEGIN", "COMMIT")


def passes(tables: list[str] | tuple[str, ...], whitelist: bool, regex: bool = False) -> Column:
    """Whether a row passes. An empty blacklist passes everything, an empty whitelist the boundaries only."""
    relation = F.col("relation")
    if regex:
        for t in tables:
            re.compile(t)
        found = F.lit(False)
        for t in tables:
            found = found | relation.rlike(t)
    else:
        found = relation.isin(*tables) if tables else F.lit(False)
    return F.col("operation").isin(*BOUNDARY) | (found if whitelist else ~found)


def filtered(wal: DataFrame, tables=(), whitelist: bool = False, regex: bool = False) -> DataFrame:
    if not whitelist and not tables:
        return wal
    return wal.filter(passes(tables, whitelist, regex))


def filter_stats(wal: DataFrame, tables=(), whitelist: bool = False, regex: bool = False) -> DataFrame:
    """passed and filtered, as counter rows."""
    ok = passes(tables, whitelist, regex)
    counts = wal.agg(F.count_if(ok).alias("passed"), F.count_if(~ok).alias("filtered"))
    return counts.select(F.explode(F.array(*[F.struct(F.lit("filter").alias("component"), F.lit("count").alias("stat_type"), F.lit(n).alias("stat_name"), F.lit("msgs").alias("unit"), F.col(n).alias("value")) for n in ("passed", "filtered")])).alias("s")).select("s.*")
