"""Digamma as a native column expression (no SciPy, no UDF).

For z > 0: raise the argument by the recurrence ψ(z) = ψ(z + 1) − 1/z until
it reaches ``SHIFT_TO``, then apply the asymptotic (Bernoulli) series.  With
the argument at 10 or above the truncation error of the series below is under
1e-16, so the result agrees with a library digamma to double precision.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHIFT_TO = 10

# Coefficients of the asymptotic series
# ψ(x) ~ ln x − 1/(2x) − Σ_k B_2k / (2k · x^2k), k = 1..7.
SERIES = [
    (1.0 / 12.0, 2),
    (-1.0 / 120.0, 4),
    (1.0 / 252.0, 6),
    (-1.0 / 240.0, 8),
    (1.0 / 132.0, 10),
    (-691.0 / 32760.0, 12),
    (1.0 / 12.0, 14),
]


def _asymptotic(x: Column) -> Column:
    inv2 = F.lit(1.0) / (x * x)
    # Horner form in 1/x² of Σ c_k / x^(2k)
    poly = F.lit(SERIES[-1][0])
    for coef, _ in reversed(SERIES[:-1]):
        poly = F.lit(coef) + inv2 * poly
    return F.log(x) - F.lit(0.5) / x - inv2 * poly


def digamma(z: Column) -> Column:
    """ψ(z) for z > 0 (double)."""
    z = z.cast("double")
    shifts = F.greatest(F.lit(0.0), F.ceil(F.lit(float(SHIFT_TO)) - z).cast("double"))
    correction = F.lit(0.0)
    for j in range(SHIFT_TO):
        correction = correction + F.when(F.lit(float(j)) < shifts, F.lit(1.0) / (z + F.lit(float(j)))).otherwise(
            F.lit(0.0)
        )
    return _asymptotic(z + shifts) - correction


def digamma_diff(n: Column, a: Column) -> Column:
    """ψ(n + a) − ψ(a), exactly 0 for n = 0."""
    return F.when(n == 0, F.lit(0.0)).otherwise(digamma(n.cast("double") + a) - digamma(a))
