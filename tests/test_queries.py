"""Every registered query of the library against its SQL, over the smallest tables."""

import numbers

import duckdb
import pandas as pd
import pytest

from varspark.queries import oracle_sql, queries

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def _rows(df, cols):
    def text(v):
        if pd.isna(v):
            return "<null>"
        # pandas holds integers with nulls as floats
        return repr(float(v)) if isinstance(v, numbers.Number) and not isinstance(v, bool) else str(v)

    return sorted(tuple(map(text, r)) for r in df[cols].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, duck, name):
    got = queries()[name](spark, DATA).toPandas()
    want = duck.sql(oracle_sql()[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert _rows(got, cols) == _rows(want, cols)
