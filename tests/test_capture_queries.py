"""Every query over capture data: the same rows as its SQL, or a result where SQL can't state it."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from capturelake.plans.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(data_dir):
    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for p in glob.glob(f"{data_dir}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def text(x):
    if x is None or (isinstance(x, float) and x != x):
        return "null"
    return f"{float(x):.6g}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data_dir, con, name):
    got = QUERIES[name](spark, data_dir)
    names = sorted(got.columns)
    rows = got.select(*names).collect()
    if name not in ORACLES:
        assert rows
        return
    want = con.sql(f"select {', '.join(f'\"{n}\"' for n in names)} from ({ORACLES[name]})").fetchall()
    assert Counter(tuple(map(text, r)) for r in rows) == Counter(tuple(map(text, r)) for r in want)
