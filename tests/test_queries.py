"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from tradewind.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    yield con
    con.close()


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, duck, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    sql = entry_point.oracle_sql()[name]
    found = duck.execute(sql)
    columns = [(d[0], str(d[1])) for d in found.description]
    place = sorted(range(len(columns)), key=lambda i: columns[i][0])
    want = [tuple(r[i] for i in place) for r in found.fetchall()]
    assert sorted((c, TYPES[t]) for c, t in df.dtypes) == sorted(columns)
    got = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    assert len(got) > 0
    assert _sorted(got) == _sorted(want)


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(entry_point.oracle_sql())
    assert set(REGISTRY) <= set(entry_point.queries())


def test_entry(spark):
    assert not entry_point.entry(spark).isEmpty()
