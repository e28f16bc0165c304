"""Every SQL-checked registered query equals its DuckDB oracle (sf 0.001)."""

import datetime as dt
import math
import os

import duckdb
import pytest

from tests.conftest import SF_SMALL

import __spark_entry__ as E
from tarmac.plans import catalog
from tarmac.sources.fixtures import DRIVER_TABLES

# Model-training queries are covered by test_ml; everything with an oracle here. Queries of the optional
# training-data part have tests of their own beside it.
SQL = catalog.oracle_sql()
NAMES = sorted(SQL)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in (x.asDict() for x in sdf.collect())), key=_key)
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    drows = sorted((tuple(_norm(r[i]) for i in order) for r in res.fetchall()), key=_key)
    assert srows == drows
