"""Every query of the catalogue against its SQL on the smallest tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

from acreage.plans import catalog

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for path in glob.glob(f"{DIR}/*.parquet"):
        c.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(round(v, 9) + 0.0)
    return None if v is None else str(v)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(name, spark, db):
    df = catalog.QUERIES[name](spark, DIR)
    cursor = db.execute(catalog.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(tuple(str(plain(v)) for _, v in sorted(zip(names, r, strict=True))) for r in cursor.fetchall())
    got = sorted(tuple(str(plain(v)) for _, v in sorted(r.asDict().items())) for r in df.collect())
    assert got == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
