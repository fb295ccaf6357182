import math

import pytest

from adfeat.operators.counts import key_counts
from adfeat.operators.smoothing import fit_beta_prior, smoothed_rate
from adfeat.sources.views import imp_lineitem

from conftest import SF_CHECK


@pytest.fixture(scope="module")
def shop_pairs(spark):
    return key_counts(imp_lineitem(spark, SF_CHECK), ["shop_id"], n="n", conv="c")


def test_fixed_steps_value(shop_pairs):
    # FIXTURES.md: imp_lineitem by shop, prior (1, 1), 20 steps, ε 0
    p = fit_beta_prior(shop_pairs, "n", "c", 1.0, 1.0, 20, 0.0)
    assert p.iterations == 20
    assert math.isclose(p.alpha, 1.4957049, abs_tol=1e-6)
    assert math.isclose(p.beta, 2.4922399, abs_tol=1e-6)


def _exact_fit(values, steps, epsilon):
    """The fixed point over ψ(v + a) − ψ(a) = Σ_{k<v} 1 / (a + k), summed term by term."""
    import numpy as np

    def total(v, a):
        sums = np.cumsum(1.0 / (a + np.arange(max(v))))
        return math.fsum(float(sums[x - 1]) for x in v if x > 0)

    n, c = [x for x, _ in values], [x for _, x in values]
    u = [x - y for x, y in values]
    alpha, beta = 1.0, 1.0
    for i in range(steps):
        d = total(n, alpha + beta)
        a, b = alpha * total(c, alpha) / d, beta * total(u, beta) / d
        if abs(a - alpha) < epsilon and abs(b - beta) < epsilon:
            return alpha, beta, i + 1
        alpha, beta = a, b
    return alpha, beta, steps


@pytest.mark.parametrize("scale", [1, 900, 40_000])
def test_summary_equals_the_exact_sums_at_convergence(spark, scale):
    import random

    rnd = random.Random(scale)
    values = [(n, rnd.randrange(0, n + 1)) for n in (rnd.randrange(1, 60) * scale + rnd.randrange(3) for _ in range(60))]
    want = _exact_fit(values, 1000, 1e-3)
    got = fit_beta_prior(spark.createDataFrame(values, "n long, c long"), "n", "c", 1.0, 1.0, 1000, 1e-3)
    assert got.iterations == want[2]
    assert math.isclose(got.alpha, want[0], rel_tol=1e-10) and math.isclose(got.beta, want[1], rel_tol=1e-10)


def test_summary_size_does_not_depend_on_the_data(spark):
    from pyspark.sql import functions as F

    from adfeat.operators.smoothing import EXACT, value_summary

    pairs = spark.range(1, 200_000).select((F.col("id") * 1_000_003).alias("n"), F.col("id").alias("c"))
    assert value_summary(pairs, "n", "c").count() < 3 * (EXACT + 64 * 23)


def test_convergence_breaks_before_storing(shop_pairs):
    one = fit_beta_prior(shop_pairs, "n", "c", 1.0, 1.0, 1, 0.0)
    moved = max(abs(one.alpha - 1.0), abs(one.beta - 1.0))
    # ε above the first move: the first step is computed but not stored
    p = fit_beta_prior(shop_pairs, "n", "c", 1.0, 1.0, 50, moved * 1.01)
    assert (p.alpha, p.beta, p.iterations) == (1.0, 1.0, 1)


def test_smoothed_rate_in_unit_interval(spark, shop_pairs):
    from pyspark.sql import functions as F

    p = fit_beta_prior(shop_pairs, "n", "c", 1.0, 1.0, 20, 0.0)
    r = shop_pairs.select(smoothed_rate("n", "c", p).alias("r")).agg(F.min("r"), F.max("r")).first()
    assert 0 < r[0] <= r[1] < 1
