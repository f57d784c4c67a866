"""Every query of the catalogue, and its SQL on the same tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from lipika import plans

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (list, tuple)):
        return repr([plain(x) for x in v])
    return str(v)


def test_contract():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(plans.ORACLES) <= set(plans.QUERIES) <= set(entry.queries())


@pytest.mark.skipif(not Path(DATA).exists(), reason="no tables here")
@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    found = plans.QUERIES[name](spark, DATA)
    rows = found.collect()
    if name not in plans.ORACLES:
        return
    done = duck.execute(plans.ORACLES[name])
    columns = [d[0] for d in done.description]
    assert sorted(columns) == sorted(found.columns)
    order = sorted(columns)
    want = sorted(tuple(plain(r[columns.index(c)]) for c in order) for r in done.fetchall())
    assert sorted(tuple(plain(r[c]) for c in order) for r in rows) == want
