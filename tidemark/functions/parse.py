"""Logical-decoding text to columns, by built-in expressions.

A text is BEGIN/COMMIT with a transaction id, or ``table <relation>: <operation>: <columns>``. Columns are
``name[type]:value`` with quoted names, nested brackets in types and quoted values; ``old-key:`` and ``new-tuple:``
switch between the old and the new columns. All quantifiers over quoted parts are possessive: the matcher then loops
instead of recursing, so that long values with many quotes are safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import COLUMNS
from .bind import let

_QUOTED = r'"(?:[^"]++|"")*+"'
#: What is before the columns: it is looked for at the start only, however long the text is.
_PRELUDE = rf'(?s)\Atable.((?:[^":]++|{_QUOTED})*+): ([^:]*+): '
_NAME = rf'(?:{_QUOTED}|[^\[:" ]++)++'
_TYPE = rf'(?:{_QUOTED}|\[[^\]]*+\]|[^\]\["]++)*+'
_VALUE = r"(?:[^' ]++|'[^']*+')*+"
_HEAD = rf"(?s)\A({_NAME})\[({_TYPE})\]:"
_TOKEN = rf"(?s)(?:(?:{_NAME})\[{_TYPE}\]:{_VALUE})|(?:old-key|new-tuple):"
_OLD, _NEW = "old-key:", "new-tuple:"


def message_class(text: Column) -> Column:
    """txn, dml, or null for what is neither."""
    head = F.substring(text, 1, 5)
    return F.when(F.octet_length(text) < 5, None).when(head.isin("BEGIN", "COMMI"), F.lit("txn")).when(head == "table", F.lit("dml"))


def _empty() -> Column:
    return F.create_map().cast(COLUMNS)


def _entries(parts: Column, old: bool) -> Column:
    def named(own: Column) -> Column:
        def unique(names: Column) -> Column:
            # of columns with one name the last one holds
            last = F.filter(own, lambda p, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), p["name"]))
            return F.when(F.size(F.array_distinct(names)) == F.size(names), own).otherwise(last)

        return let(F.transform(own, lambda p: p["name"]), unique)

    return F.map_from_entries(F.transform(let(F.filter(parts, lambda p: p["old"] == F.lit(old)), named), lambda p: F.struct(p["name"], p["cv"])))


def _split(rest: Column) -> Column:
    """whole (is every part between single spaces a token, and the last one a column), columns and old_columns of what follows the prelude."""

    def parts(t: Column) -> Column:
        old_at, new_at = F.array_position(t["token"], _OLD), F.array_position(t["token"], _NEW)

        def column(head: Column, token: Column, old: Column) -> Column:
            raw = F.substring(token, F.length(head) + 1, F.length(token))
            quoted = F.instr(raw, "'") > 0
            value = F.when(quoted, F.replace(F.substring(raw, F.lit(2), F.length(raw) - 2), F.lit("''"), F.lit("'"))).otherwise(raw)
            cv = F.struct(value.alias("value"), F.regexp_extract(head, _HEAD, 2).alias("type"), quoted.alias("quoted"))
            return F.struct(F.regexp_extract(head, _HEAD, 1).alias("name"), cv.alias("cv"), old.alias("old"))

        def placed(at: Column) -> Column:
            old = lambda i: (at["old"] > 0) & (i + 1 > at["old"]) & ((at["new"] == 0) | (i + 1 < at["new"]))
            # markers have no name
            return F.filter(F.transform(t["token"], lambda k, i: let(F.regexp_extract(k, _HEAD, 0), lambda head: column(head, k, old(i)))), lambda p: p["name"] != "")

        whole = (F.array_join(t["token"], " ") == t["rest"]) & (F.size(t["token"]) > 0) & ~F.try_element_at(t["token"], F.lit(-1)).isin(_OLD, _NEW)
        every = let(F.struct(old_at.alias("old"), new_at.alias("new")), placed)
        return let(F.struct(F.coalesce(whole, F.lit(False)).alias("whole"), every.alias("parts")), lambda e: F.struct(e["whole"].alias("whole"), F.when(e["whole"], _entries(e["parts"], False)).otherwise(_empty()).alias("columns"), F.when(e["whole"], _entries(e["parts"], True)).otherwise(_empty()).alias("old_columns")))

    return let(rest, lambda r: let(F.struct(r.alias("rest"), F.regexp_extract_all(r, F.lit(_TOKEN), F.lit(0)).alias("token")), parts))


def _unknown(text: Column) -> Column:
    return F.concat(F.lit("unknown message: "), F.substring(text, 1, 60))


def with_prelude(df: DataFrame, text: str = "wal_data", mode: str = "PERMISSIVE") -> DataFrame:
    """Adds operation, relation, transaction (of BEGIN and COMMIT), and what is left to parse (_rest); operation is null where the prelude is wrong, or with FAILFAST an error is raised."""
    t = F.coalesce(F.col(text), F.lit(""))
    kind = message_class(t)
    # transaction messages are short; the others are never searched as a whole
    fields = F.split(F.trim(F.regexp_replace(F.when(kind == "txn", t), r"\s+", " ")), " ")
    txn = (kind == "txn") & (F.size(fields) == 2)
    head = F.when(kind == "dml", F.regexp_extract(t, _PRELUDE, 0))
    dml = head != ""
    wrong = F.raise_error(_unknown(t)).cast("string") if mode == "FAILFAST" else F.lit(None).cast("string")
    return df.withColumns(
        {
            "operation": F.when(txn, fields[0]).when(dml, F.regexp_extract(head, _PRELUDE, 2)).otherwise(wrong),
            "relation": F.when(txn, F.lit("")).when(dml, F.regexp_extract(head, _PRELUDE, 1)),
            "transaction": F.when(txn, fields[1]),
            "_rest": F.when(dml, F.substring(t, F.length(head) + 1, F.length(t))),
        }
    )


def with_columns(out: DataFrame, text: str = "wal_data", mode: str = "PERMISSIVE") -> DataFrame:
    """Adds no_tuple_data, columns, old_columns and parse_error (null where all is well) to what with_prelude() gives.
    FAILFAST raises on the first wrong text instead."""
    has_columns = lambda s: s["rest"].isNotNull() & (s["operation"] != "TRUNCATE") & (s["rest"] != "(no-tuple-data)")
    split = let(F.struct("operation", F.col("_rest").alias("rest")), lambda s: F.when(has_columns(s), _split(s["rest"])).otherwise(F.struct(F.lit(None).cast("boolean").alias("whole"), _empty().alias("columns"), _empty().alias("old_columns"))))
    out = out.withColumn("_split", split)
    error = F.when(F.col("operation").isNull(), _unknown(F.coalesce(F.col(text), F.lit("")))).when(~F.col("_split")["whole"], F.concat(F.lit("invalid columns: "), F.substring("_rest", 1, 60)))
    operation = F.col("operation")
    if mode == "FAILFAST":
        # the operation carries the check, so that no reader of it can skip it
        operation = F.when(error.isNotNull(), F.raise_error(error).cast("string")).otherwise(operation)
    out = out.withColumns(
        {
            "operation": operation,
            "no_tuple_data": F.coalesce(F.col("_rest") == "(no-tuple-data)", F.lit(False)) & (F.col("operation") != "TRUNCATE"),
            "columns": F.col("_split")["columns"],
            "old_columns": F.col("_split")["old_columns"],
            "parse_error": error,
        }
    )
    return out.drop("_rest", "_split")


def parsed(df: DataFrame, text: str = "wal_data", mode: str = "PERMISSIVE") -> DataFrame:
    """Both steps. A filter on relation or operation reaches the prelude: columns of dropped rows are never parsed."""
    return with_columns(with_prelude(df, text, mode), text, mode)
