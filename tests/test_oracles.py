"""Every query against its SQL in DuckDB on the smallest tables, and the others for rows."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from taxaflow.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def cell(x):
    if isinstance(x, (list, tuple, np.ndarray)):
        return "[" + ",".join(map(cell, x)) + "]"
    if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
        return "null"
    if isinstance(x, (bool, np.bool_)):
        return str(bool(x))
    return repr(float(x)) if isinstance(x, (int, float, np.number)) else str(x)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    r = duck.execute(registry.ORACLES[name])
    columns = [c[0] for c in r.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal(df.columns, df.collect()) == normal(columns, r.fetchall())


@pytest.mark.parametrize("name", ["nj_classify", "local_search", "reference_reads_verified", "classify_confidence"])
def test_rows(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_every_oracle_has_a_query():
    assert set(registry.ORACLES) <= set(registry.QUERIES)
