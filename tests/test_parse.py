import pytest
from pyspark.sql import functions as F

from tidemark.functions.parse import parsed

X = "table public.x: INSERT: "
CASES = {
    "BEGIN 81": ("BEGIN", "", "81", {}, {}),
    "COMMIT 81": ("COMMIT", "", "81", {}, {}),
    "table geo.parcels: UPDATE: parcel[integer]:31 lane[text]:'Mill Lane' town[text]:'Telc 588'": ("UPDATE", "geo.parcels", None, {"parcel": ("31", "integer", False), "lane": ("Mill Lane", "text", True), "town": ("Telc 588", "text", True)}, {}),
    "table geo.parcels: TRUNCATE: (no-flags)": ("TRUNCATE", "geo.parcels", None, {}, {}),
    "table geo.parcels, geo.owners: TRUNCATE: cascade": ("TRUNCATE", "geo.parcels, geo.owners", None, {}, {}),
    X + "(no-tuple-data)": ("INSERT", "public.x", None, {}, {}),
    "table public.x: UPDATE: old-key: id[integer]:1 v[text]:'a b' new-tuple: id[integer]:1 v[text]:unchanged-toast-datum": (
        "UPDATE", "public.x", None, {"id": ("1", "integer", False), "v": ("unchanged-toast-datum", "text", False)}, {"id": ("1", "integer", False), "v": ("a b", "text", True)},
    ),
    X + "a[text]:'O''Brien' arr[integer[]]:'{1,2}' c[character varying]:null": ("INSERT", "public.x", None, {"a": ("O'Brien", "text", True), "arr": ("{1,2}", "integer[]", True), "c": ("null", "character varying", False)}, {}),
    X + "\"We\"\"ird: c\"[text]:'x'": ("INSERT", "public.x", None, {'"We""ird: c"': ("x", "text", True)}, {}),
    X + "b[bit(4)]:B'1010'": ("INSERT", "public.x", None, {"b": ("'1010", "bit(4)", True)}, {}),
    X + "a[text]:'one' a[text]:'two'": ("INSERT", "public.x", None, {"a": ("two", "text", True)}, {}),
    X + "a[text]:'line\none: [x]' b[text]:''": ("INSERT", "public.x", None, {"a": ("line\none: [x]", "text", True), "b": ("", "text", True)}, {}),
    'table public."odd: name": DELETE: id[integer]:2': ("DELETE", 'public."odd: name"', None, {"id": ("2", "integer", False)}, {}),
}
WRONG = ["nil", "COMMIT 5 extra", "no such kind", "", None, X + "a[text]x", X, "table public.x", "table public.x: UPDATE: old-key:", X + "a[text]:'open"]


def _frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, wal_data string")


def test_messages(spark):
    rows = parsed(_frame(spark, CASES)).orderBy("i").collect()
    plain = lambda m: {k: (v["value"], v["type"], v["quoted"]) for k, v in m.items()}
    for row, (text, (operation, relation, xid, new, old)) in zip(rows, CASES.items(), strict=True):
        assert row["parse_error"] is None, text
        assert (row["operation"], row["relation"], row["transaction"]) == (operation, relation, xid)
        assert plain(row["columns"]) == new
        assert plain(row["old_columns"]) == old
        assert row["no_tuple_data"] == text.endswith("(no-tuple-data)")


def test_wrong_messages(spark):
    assert [r["parse_error"] is not None for r in parsed(_frame(spark, WRONG)).orderBy("i").collect()] == [True] * len(WRONG)
    with pytest.raises(Exception, match="unknown message"):
        parsed(_frame(spark, ["nil"]), mode="FAILFAST").select("operation").collect()


def test_long_values_with_many_quotes(spark):
    value = "'" * 20_000 + "x" * 40_000
    text = X + "a[text]:'" + value.replace("'", "''") + "' b[integer]:1"
    row = parsed(_frame(spark, [text])).select(F.length(F.col("columns")["a"]["value"]).alias("n"), "parse_error").first()
    assert (row["n"], row["parse_error"]) == (60_000, None)


def test_table_filter_goes_below_the_columns(spark):
    plan = parsed(_frame(spark, CASES)).filter("relation = 'public.x'").select("operation")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan
