from pyspark.sql import functions as F

from adfeat.operators.counts import add_counts, key_counts

SCHEMA = "shop_id long, is_trade int"


def test_non_null_counts_and_conversions(spark):
    hist = spark.createDataFrame([(1, 1), (1, 0), (1, None), (1, 1), (2, 0), (None, 1)], SCHEMA)
    got = {r.shop_id: (r.n, r.c) for r in key_counts(hist, ["shop_id"], n="n", conv="c").collect()}
    assert got == {1: (3, 2), 2: (1, 0)}  # null label not counted, null key dropped


def test_mean_label(spark):
    hist = spark.createDataFrame([(1, 1), (1, 0), (1, None), (1, 1)], SCHEMA)
    (row,) = key_counts(hist, ["shop_id"], mean="m").collect()
    assert abs(row.m - 2 / 3) < 1e-12


def test_attach_fills_and_keeps_rows(spark):
    hist = spark.createDataFrame([(1, 1), (1, 0), (2, 1)], SCHEMA)
    tgt = spark.createDataFrame([(10, 1), (11, 1), (12, 3), (13, None)], "instance_id long, shop_id long")
    out = add_counts(tgt, hist, ["shop_id"], n="n", conv="c")
    rows = {r.instance_id: (r.n, r.c) for r in out.collect()}
    assert out.count() == 4
    assert rows == {10: (2, 1), 11: (2, 1), 12: (0, 0), 13: (0, 0)}
    assert dict(out.dtypes)["n"] == "bigint"


def test_sum_of_counts_equals_labelled_rows(spark):
    import random

    rnd = random.Random(7)
    rows = [(rnd.choice([None, 1, 2, 3, 4]), rnd.choice([None, 0, 1])) for _ in range(500)]
    hist = spark.createDataFrame(rows, SCHEMA)
    t = key_counts(hist, ["shop_id"], n="n", conv="c").agg(F.sum("n"), F.sum("c")).first()
    assert t[0] == sum(1 for k, y in rows if k is not None and y is not None)
    assert t[1] == sum(1 for k, y in rows if k is not None and y == 1)
