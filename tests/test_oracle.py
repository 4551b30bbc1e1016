"""Every query of the library against its SQL, over the smallest tables."""

import numbers
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from plenum.queries import registry

SF = "/root/testdata/sf0.001"


def cell(x) -> str:
    if pd.isna(x):
        return "~"
    return repr(float(x)) if isinstance(x, numbers.Number) and not isinstance(x, (bool, np.bool_)) else str(x)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="the shared tables aren't here")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, name):
    assert rows(registry.queries()[name](spark, SF).toPandas()) == rows(duck.execute(registry.oracle_sql()[name]).df())
