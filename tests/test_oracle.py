"""Every registered query equals its DuckDB oracle on the smallest data set."""

import decimal
import hashlib

import pytest

import __spark_entry__ as E
from conftest import SMALL
from tallyhall.plans import catalog

SQL = catalog.ORACLE
NAMES = sorted(SQL)


def _norm(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.execute(SQL[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(dcols, drows)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE) == set(NAMES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["refid", "site_name", "state"]
