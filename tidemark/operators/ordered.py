"""Running values over a total order, without a task that sees a whole partition.

A window over a slot or a hot key would be one task. Here the narrow columns (keys, order, value) are cut into runs of
`width` in the order column and shuffled once, by run; from that exchange each run gives one summary row, the summaries
(one in `width` rows) are carried forward in a window of their own, and values are finished inside their run. They then
meet the full rows by key and order, so that what is wide moves once, in as many tasks as there are rows for, however
few runs there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 100_000


def running(df: DataFrame, name: str, value: Column, kind: str, keys: list[str], order: str, inclusive: bool = True, width: int = WIDTH) -> DataFrame:
    """Adds name: the last non-null value, max or sum of value over the rows of keys up to the row (inclusive) or before it. order is a number, and tells the rows of keys apart; rows that repeat it all count, and get the value of the first of them."""
    narrow = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(order).alias("_o"), value.alias("_v"))
    ks = [f"_k{i}" for i in range(len(keys))]
    runs = narrow.filter("_o IS NOT NULL").withColumn("_run", F.floor(F.col("_o") / width)).repartition(*ks, "_run")
    # always true, and keeps the order column in both readers of the exchange, so that it is made once
    here = F.when(F.col("_o") >= F.col("_run") * F.lit(width), F.col("_v"))
    summary = {"last": F.max_by(here, F.when(F.col("_v").isNotNull(), F.col("_o"))), "max": F.max(here), "sum": F.sum(here)}[kind]
    over = {"last": lambda c, w: F.last(c, ignorenulls=True).over(w), "max": lambda c, w: F.max(c).over(w), "sum": lambda c, w: F.sum(c).over(w)}[kind]
    before = Window.partitionBy(*ks).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    carry = runs.groupBy(*ks, "_run").agg(summary.alias("_sum")).select(*[F.col(k).alias(f"c{k}") for k in ks], F.col("_run").alias("c_run"), over("_sum", before).alias("_carry"))
    inside = Window.partitionBy(*ks, "_run").orderBy("_o")
    last = -1 if not inclusive else 0
    own = runs.select("*", over("_v", inside.rowsBetween(Window.unboundedPreceding, last)).alias("_here"), F.lag("_o").over(inside).alias("_prev")).filter("_prev IS NULL OR _prev <> _o")
    both = own.join(carry, _same([*ks, "_run"], [f"c{k}" for k in ks] + ["c_run"]), "left")
    done = {"last": F.coalesce("_here", "_carry"), "max": F.greatest("_here", "_carry"), "sum": F.coalesce("_here", F.lit(0)) + F.coalesce("_carry", F.lit(0))}[kind]
    values = both.select(*[F.col(k).alias(f"v{k}") for k in ks], F.col("_o").alias("v_o"), done.alias(name))
    return df.drop(name).join(values, _same([*keys, order], [f"v{k}" for k in ks] + ["v_o"]), "left").drop("v_o", *[f"v{k}" for k in ks])


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)])
