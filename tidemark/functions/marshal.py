"""Row changes as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import PAIRS, SIDE
from .bind import let
from .keys import lsn_text, time_text

UNCHANGED_TOAST, SQL_NULL = "unchanged-toast-datum", "null"


def _side(cv: Column) -> Column:
    return F.struct(cv["quoted"].cast("string").alias("q"), cv["type"].alias("t"), cv["value"].alias("v"))


def _pair(operation: Column, new: Column, old: Column, old_values: bool) -> Column:
    none = F.lit(None).cast(SIDE)
    differs = old.isNotNull() & (old["value"] != new["value"])
    toast = differs & (new["value"] == UNCHANGED_TOAST)
    shown_new = F.when(operation == "DELETE", none).when(toast, _side(old)).otherwise(_side(new))
    if old_values:
        is_null = (new["value"] == SQL_NULL) & ~new["quoted"]
        made_null = F.struct(F.lit("false").alias("q"), new["type"].alias("t"), F.lit(SQL_NULL).alias("v"))
        shown_old = F.when(operation == "DELETE", _side(new)).when(differs, _side(old)).when(old.isNull() & ~is_null & (operation == "UPDATE"), made_null).otherwise(none)
    else:
        shown_old = F.when(operation == "DELETE", _side(new)).otherwise(none)
    return F.struct(shown_new.alias("new"), shown_old.alias("old"))


def column_pairs(operation: Column, columns: Column, old_columns: Column, old_values: bool = True) -> Column:
    """name -> (new, old), by name; the absent side is null. Values alone are compared, types and quotes are not. An UPDATE that has no old value for a column, and whose new one is not NULL, is given NULL as the old one."""

    def pairs(row: Column) -> Column:
        sides = lambda k: F.struct(F.try_element_at(row["new"], k).alias("new"), F.try_element_at(row["old"], k).alias("old"))
        return F.map_from_entries(F.transform(F.sort_array(F.map_keys(row["new"])), lambda k: F.struct(k, let(sides(k), lambda c: _pair(row["op"], c["new"], c["old"], old_values)))))

    return let(F.struct(operation.alias("op"), columns.alias("new"), old_columns.alias("old")), pairs)


def html_escaped(json: Column) -> Column:
    """<, >, & and the line separators as \\u escapes, which JSON libraries for web pages write."""
    for char, text in (("&", "\\u0026"), ("<", "\\u003c"), (">", "\\u003e"), ("\u2028", "\\u2028"), ("\u2029", "\\u2029")):
        json = F.replace(json, F.lit(char), F.lit(text))
    return json


def marshalled(wal: DataFrame, old_values: bool = True, html_escape: bool = False) -> DataFrame:
    """Adds json to a parsed and stamped stream: null for BEGIN and COMMIT. Rows without columns (not even an empty map) can't be written as JSON: theirs is null too, and failed is true."""
    pairs = column_pairs(F.col("operation"), F.col("columns"), F.col("old_columns"), old_values).cast(PAIRS)
    entry = F.struct(
        time_text(F.col("server_time_ms")).alias("time"),
        F.col("server_time_ms").alias("time_ms"),
        F.col("time_based_key").alias("txn"),
        lsn_text(F.col("wal_start")).alias("lsn"),
        F.col("relation").alias("table"),
        F.col("operation"),
        pairs.alias("columns"),
    )
    json = F.to_json(entry)
    json = html_escaped(json) if html_escape else json
    boundary = F.col("operation").isin("BEGIN", "COMMIT")
    return wal.withColumn("json", F.when(~boundary & F.col("columns").isNotNull(), json)).withColumn("failed", ~boundary & F.col("json").isNull())
