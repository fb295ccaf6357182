"""M1/M2: empirical-Bayes Beta prior for conversion rates, and the smoothed rate.

Fit (Minka's fixed point, as in the reference): from (α₀, β₀) repeat

    α' = α · Σ[ψ(c + α) − ψ(α)] / Σ[ψ(n + α + β) − ψ(α + β)]
    β' = β · Σ[ψ(n − c + β) − ψ(β)] / Σ[ψ(n + α + β) − ψ(α + β)]

over all (impressions n, conversions c) pairs, stopping after ``iter_num``
steps or as soon as both moves are below ``epsilon`` – in which case the last
step is *not* taken (the reference breaks before storing it).

Plan.  A sum over pairs depends on a pair only through its value v (c, n − c
or n), so one Spark aggregate reduces the pairs to a summary whose size does
not depend on the data: below ``EXACT`` the frequency of every value, above
it geometric bins (ratio 1 + 1/``BIN_PARTS``) that keep the power moments
Σ ((v − m)/m)^k, k = 0..``MOMENTS``, about the bin's middle m.  At most
3 × (EXACT + 64 · 23) rows reach the driver, and no row is dropped.

A step then sums frequency × ψ over the exact values and, per bin, the Taylor
series of ψ about m + shift against the moments.  With |v − m| ≤ m/64 the
series' next term is below 64⁻⁹/9 of the sum – under double precision – so a
step over the summary equals the step over all pairs, and up to 1000 steps
cost milliseconds instead of 1000 Spark jobs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeat.functions.digamma import SERIES, SHIFT_TO

#: Values that keep their own frequency, parts of a bin's width, and moments of a bin.
EXACT, BIN_PARTS, MOMENTS = 1024, 32, 8


@dataclass(frozen=True)
class BetaPrior:
    alpha: float
    beta: float
    iterations: int

    @property
    def mean(self) -> float:
        return self.alpha / (self.alpha + self.beta)


def value_summary(pairs: DataFrame, n: str, c: str, weight: str | None = None) -> DataFrame:
    """``(kind, bin, m0 … m8)``: the moments of the values c ("c"), n − c ("u") and n ("n"), v > 0.

    ``bin`` is v itself below EXACT, and −1 − (number of the geometric bin) above.
    """
    w = F.col(weight) if weight else F.lit(1)
    value = lambda kind, v: F.struct(F.lit(kind).alias("kind"), v.cast("bigint").alias("v"), w.cast("double").alias("w"))
    stacked = pairs.select(
        F.explode(F.array(value("c", F.col(c)), value("u", F.col(n) - F.col(c)), value("n", F.col(n)))).alias("s")
    ).select("s.*")
    v = F.col("v")
    number = F.floor(F.log(v / F.lit(float(EXACT))) / F.lit(math.log1p(1 / BIN_PARTS)))
    binned = stacked.where(v > 0).select(
        "kind", "w", "v", F.when(v < EXACT, v).otherwise(F.lit(-1) - number).cast("bigint").alias("bin")
    )
    middle = F.lit(float(EXACT)) * F.pow(F.lit(1 + 1 / BIN_PARTS), F.lit(-0.5) - F.col("bin"))
    offset = F.when(F.col("bin") < 0, v / middle - F.lit(1.0)).otherwise(F.lit(0.0))
    binned = binned.select("kind", "bin", "w", offset.alias("x"))
    moments = [F.sum(F.col("w") * (F.pow("x", F.lit(k)) if k else F.lit(1.0))).alias(f"m{k}") for k in range(MOMENTS + 1)]
    return binned.groupBy("kind", "bin").agg(*moments)


def _digamma(x: np.ndarray) -> np.ndarray:
    """Vectorised ψ for x > 0: the same shift + series as the column expression."""
    x = np.asarray(x, dtype=np.float64).copy()
    acc = np.zeros_like(x)
    for _ in range(SHIFT_TO):
        small = x < SHIFT_TO
        if not small.any():
            break
        acc[small] -= 1.0 / x[small]
        x[small] += 1.0
    inv2 = 1.0 / (x * x)
    poly = np.full_like(x, SERIES[-1][0])
    for coef, _ in reversed(SERIES[:-1]):
        poly = coef + inv2 * poly
    return acc + np.log(x) - 0.5 / x - inv2 * poly


def _taylor(x: np.ndarray, k: int) -> np.ndarray:
    """ψ⁽ᵏ⁾(x) / k! for k ≥ 1 and large x: the asymptotic series, differentiated term by term."""
    out = 1.0 / (k * x**k) + 1.0 / (2.0 * x ** (k + 1))
    for coef, power in SERIES[:4]:
        # coef · x^−power, differentiated k times, over k!
        out += coef * math.comb(power + k - 1, k) / x ** (power + k)
    return out if k % 2 else -out


class _Sums:
    """Σ [ψ(v + a) − ψ(a)] per kind, over the collected summary."""

    def __init__(self, rows) -> None:
        self.exact, self.bins = {}, {}
        for kind in "cun":
            own = [r for r in rows if r["kind"] == kind]
            exact = [r for r in own if r["bin"] > 0]
            wide = [r for r in own if r["bin"] < 0]
            self.exact[kind] = np.array([r["bin"] for r in exact], np.float64), np.array([r["m0"] for r in exact])
            middle = EXACT * (1 + 1 / BIN_PARTS) ** (np.array([-1 - r["bin"] for r in wide], np.float64) + 0.5)
            self.bins[kind] = middle, np.array([[r[f"m{k}"] for k in range(MOMENTS + 1)] for r in wide]).reshape(-1, MOMENTS + 1)

    def _one(self, kind: str, a: float) -> float:
        zero = _digamma(np.array([a]))[0]
        v, f = self.exact[kind]
        total = float(np.dot(f, _digamma(v + a) - zero)) if v.size else 0.0
        middle, m = self.bins[kind]
        if middle.size:
            x = middle + a
            total += float(np.dot(m[:, 0], _digamma(x) - zero))
            total += sum(float(np.dot(m[:, k], middle**k * _taylor(x, k))) for k in range(1, MOMENTS + 1))
        return total

    def __call__(self, alpha: float, beta: float) -> tuple[float, float, float]:
        return self._one("c", alpha), self._one("u", beta), self._one("n", alpha + beta)


def fit_beta_prior(
    pairs: DataFrame,
    n: str,
    c: str,
    alpha0: float = 1.0,
    beta0: float = 1.0,
    iter_num: int = 1000,
    epsilon: float = 0.001,
    weight: str | None = None,
) -> BetaPrior:
    """M1: fit Beta(α, β) to ``(n, c)`` pairs (one per row of ``pairs``, or ``weight`` rows)."""
    step = _Sums(value_summary(pairs, n, c, weight).collect())
    alpha, beta = float(alpha0), float(beta0)
    done = 0
    for _ in range(iter_num):
        na, nb, d = step(alpha, beta)
        if d == 0.0:
            break
        new_alpha, new_beta = alpha * (na / d), beta * (nb / d)
        done += 1
        if abs(new_alpha - alpha) < epsilon and abs(new_beta - beta) < epsilon:
            break
        alpha, beta = new_alpha, new_beta
    return BetaPrior(alpha, beta, done)


def smoothed_rate(n: str | Column, c: str | Column, prior: BetaPrior) -> Column:
    """M2: ``(c + α) / (n + α + β)``."""
    n = F.col(n) if isinstance(n, str) else n
    c = F.col(c) if isinstance(c, str) else c
    a, b = F.lit(prior.alpha), F.lit(prior.beta)
    return (c + a) / (n + a + b)
