"""Every registered change-stream query against its SQL, on the smallest tables."""

import duckdb
import pytest

from tidemark.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, data, duck, name):
    got = QUERIES[name](spark, data)
    cols = sorted(got.columns)
    theirs = duck.sql(ORACLES[name])
    assert sorted(theirs.columns) == cols
    a = sorted(tuple(map(str, r)) for r in got.select(cols).collect())
    b = sorted(tuple(map(str, r)) for r in theirs.select(*[f'"{c}"' for c in cols]).fetchall())
    assert a == b


def test_written_reports_hold_every_message(spark, data):
    messages = QUERIES["f2_count_batches"](spark, data).count()
    assert sum(r["count"] for r in QUERIES["h13_written_all"](spark, data).collect()) == messages
