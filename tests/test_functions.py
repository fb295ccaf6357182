import math

from pyspark.sql import functions as F

from adfeat.functions import (
    category_key,
    digamma,
    digamma_diff,
    hour_of,
    index_or_minus1,
    list_length,
    predicted_categories,
    property_at,
)


def _one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_category_key_list_lengths(spark):
    got = _one(spark, category_key("c"), [("a",), ("a;b",), ("a;b;c",), ("a;b;c;d",)], "c string")
    assert got == [None, "b", "c", "c"]


def test_predicted_list_position(spark):
    rows = [("c2", "c1:p1,p2;c2:p3"), ("c9", "c1:p1,p2;c2:p3"), ("c1", "c1:p1;c1:p2"), ("c1", "c0:-1")]
    df = spark.createDataFrame(rows, "cat string, pred string")
    got = [r[0] for r in df.select(index_or_minus1("cat", predicted_categories("pred"))).collect()]
    assert got == [1, -1, 0, -1]


def test_predicted_categories(spark):
    got = _one(spark, predicted_categories("p"), [("c1:p1,p2;c2:p3;c3",)], "p string")
    assert got == [["c1", "c2", "c3"]]


def test_properties_and_length(spark):
    rows = [("p0;p1;p2",), ("p0",)]
    assert _one(spark, property_at("p", 2), rows, "p string") == ["p2", None]
    assert _one(spark, list_length("p"), rows, "p string") == [3, 1]


def test_hour(spark):
    got = _one(spark, hour_of("t"), [("2024-01-21 23:59:59",), ("2024-01-21 00:00:00",)], "t string")
    assert got == [23, 0]


def test_digamma_known_values(spark):
    euler = 0.5772156649015329
    rows = [(1.0,), (0.5,), (10.0,), (123.25,)]
    got = _one(spark, digamma(F.col("x")), rows, "x double")
    assert math.isclose(got[0], -euler, abs_tol=1e-13)
    assert math.isclose(got[1], -euler - 2 * math.log(2), abs_tol=1e-13)
    assert math.isclose(got[2], 2.251752589066721, abs_tol=1e-13)
    # ψ(123.25) via recurrence from ψ(0.25) = −γ − π/2 − 3 ln 2
    ref = -euler - math.pi / 2 - 3 * math.log(2) + sum(1 / (0.25 + k) for k in range(123))
    assert math.isclose(got[3], ref, rel_tol=1e-13)


def test_digamma_diff_is_harmonic_tail(spark):
    rows = [(v, a) for v in (0, 1, 3, 17, 250) for a in (0.3, 1.0, 7.5, 60.0)]
    df = spark.createDataFrame(rows, "v long, a double")
    got = df.select("v", "a", digamma_diff(F.col("v"), F.col("a")).alias("d")).collect()
    for r in got:
        exact = sum(1.0 / (r.a + k) for k in range(r.v))
        assert math.isclose(r.d, exact, rel_tol=1e-12, abs_tol=1e-14)
