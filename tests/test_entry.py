import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "shop_trade_sum" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    import math

    import pandas as pd

    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else round(v, 6)
    return v.item() if hasattr(v, "item") else v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_oracle_small(spark, duck, name):
    s = _rows(E.queries()[name](spark, SF_SMALL).toPandas())
    o = _rows(duck.execute(E.oracle_sql()[name]).fetchdf())
    assert s[0] == o[0]
    assert s[1] == o[1]
