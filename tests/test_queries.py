"""Every registered query against its SQL on the oracle engine."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

from skylattice.plans.oracles import ORACLES
from skylattice.plans.queries import QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def plain(v):
    return ("nan" if math.isnan(v) else round(v, 9) + 0.0) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = Counter(tuple(map(plain, r)) for r in df.select(*cols).collect())
    if name not in ORACLES:
        assert sum(got.values()) > 0
        return
    r = duck.sql(ORACLES[name])
    assert sorted(r.columns) == cols
    at = [r.columns.index(c) for c in cols]
    assert got == Counter(tuple(plain(x[i]) for i in at) for x in r.fetchall())
