import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from adfeat.operators.ranks import add_time_ranks


def _frame(spark, rows):
    df = spark.createDataFrame(rows, "rid long, k string, t string")
    return df.withColumn("ts", F.to_timestamp("t"))


def test_ties_share_the_mean_rank(spark):
    rows = [(1, "a", "2024-01-01 00:00:01"), (2, "a", "2024-01-01 00:00:03"),
            (3, "a", "2024-01-01 00:00:03"), (4, "a", "2024-01-01 00:00:02"),
            (5, None, "2024-01-01 00:00:02")]
    out = add_time_ranks(_frame(spark, rows), ["k"], "ts", "k", block_seconds=2)
    got = {r.rid: (r.k_first_rank, r.k_last_rank, r.k_if_first, r.k_if_last) for r in out.collect()}
    assert got[1] == (1.0, 4.0, 1, 0)
    assert got[2] == (3.5, 1.5, 0, 0)
    assert got[3] == (3.5, 1.5, 0, 0)
    assert got[4] == (2.0, 3.0, 0, 0)
    assert got[5] == (None, None, 0, 0)  # null key: no rank, no flag


@pytest.mark.parametrize("block_seconds", [1, 7, 3600])
def test_matches_pandas_average_rank(spark, block_seconds):
    rnd = random.Random(block_seconds)
    keys = ["hot"] * 300 + [f"k{i}" for i in range(40)] * 5  # one key holds most rows
    rows = [(i, k, f"2024-01-01 00:{rnd.randrange(0, 3):02d}:{rnd.randrange(0, 60):02d}")
            for i, k in enumerate(keys)]
    out = add_time_ranks(_frame(spark, rows), ["k"], "ts", "k", block_seconds=block_seconds).toPandas()
    pdf = pd.DataFrame(rows, columns=["rid", "k", "t"])
    pdf["first"] = pdf.groupby("k")["t"].rank(method="average", ascending=True)
    pdf["last"] = pdf.groupby("k")["t"].rank(method="average", ascending=False)
    m = out.merge(pdf, on="rid")
    assert (m["k_first_rank"] == m["first"]).all()
    assert (m["k_last_rank"] == m["last"]).all()
    n = m.groupby("k_x")["rid"].transform("count")
    assert ((m["k_first_rank"] + m["k_last_rank"]) == n + 1).all()
    assert m.groupby("k_x")["k_if_last"].sum().max() <= 1


def test_null_time_gets_no_rank(spark):
    rows = [(1, "a", "2024-01-01 00:00:01"), (2, "a", None), (3, "a", "2024-01-01 00:00:01")]
    out = add_time_ranks(_frame(spark, rows), ["k"], "ts", "k", counts={"n": "rid"})
    got = {r.rid: (r.k_first_rank, r.k_last_rank, r.n) for r in out.collect()}
    assert got == {1: (1.5, 1.5, 3), 2: (None, None, 3), 3: (1.5, 1.5, 3)}
