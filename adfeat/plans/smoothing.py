"""M2: smoothed conversion rates per shop, item and user (the reference's disabled callers).

* shop / item: fit the prior over the per-key (impressions, conversions)
  table of the history, attach ``(c + α) / (n + α + β)``; a key unseen in the
  history gets the prior mean ``α / (α + β)`` (the reference's intent; its
  fill statement assigned None).  Items without conversions count 0 before
  the fit.
* user: the reference fits over the *target rows* after the counts were
  attached (so a user weighs as often as it appears, unseen users as 0/0),
  with 100 iterations; kept as is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfeat.operators.counts import attach, key_counts
from adfeat.operators.smoothing import BetaPrior, fit_beta_prior, smoothed_rate
from adfeat.sources.staging import stage


def _counts(hist: DataFrame, key: str, n: str, c: str) -> DataFrame:
    """Per-key counts, staged: the fit and the attached table read one aggregate."""
    return stage(key_counts(hist, [key], n=n, conv=c), f"{key}-counts")


def key_smoothing(
    hist: DataFrame,
    base: DataFrame,
    key: str,
    prefix: str,
    iter_num: int = 1000,
    epsilon: float = 0.001,
    alpha0: float = 1.0,
    beta0: float = 1.0,
) -> tuple[DataFrame, BetaPrior]:
    n, c, s = f"{prefix}_trade_sum", f"{prefix}_trade_count", f"{prefix}_trade_smooth"
    counts = _counts(hist, key, n, c)
    prior = fit_beta_prior(counts, n, c, alpha0, beta0, iter_num, epsilon)
    table = counts.select(key, n, c, smoothed_rate(n, c, prior).alias(s))
    return attach(base, table, [key], fills={n: 0, c: 0, s: prior.mean}), prior


def shop_smoothing(hist: DataFrame, base: DataFrame, **kw) -> tuple[DataFrame, BetaPrior]:
    return key_smoothing(hist, base, "shop_id", "shop", **kw)


def item_smoothing(hist: DataFrame, base: DataFrame, **kw) -> tuple[DataFrame, BetaPrior]:
    return key_smoothing(hist, base, "item_id", "item", **kw)


def user_smoothing(
    hist: DataFrame, base: DataFrame, iter_num: int = 100, epsilon: float = 0.001
) -> tuple[DataFrame, BetaPrior]:
    counts = _counts(hist, "user_id", "user_trade_sum", "user_trade_count")
    out = attach(base, counts, ["user_id"], 0)
    # Each target row weighs its user's (n, c).  Rows of unseen or null users carry
    # (0, 0), which adds nothing to any digamma sum, so the weights are the target's
    # row counts per *seen* user – an aggregate of the target, not a second join of it.
    rows = base.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count(F.lit(1)).alias("_rows"))
    pairs = rows.join(counts, "user_id").select("user_trade_sum", "user_trade_count", "_rows")
    prior = fit_beta_prior(pairs, "user_trade_sum", "user_trade_count", 1.0, 1.0, iter_num, epsilon, weight="_rows")
    return out.withColumn("user_trade_smooth", smoothed_rate("user_trade_sum", "user_trade_count", prior)), prior


def prior_of_shops(hist: DataFrame, iter_num: int = 1000, epsilon: float = 0.001) -> BetaPrior:
    counts = key_counts(hist, ["shop_id"], n="n", conv="c")
    return fit_beta_prior(counts, "n", "c", 1.0, 1.0, iter_num, epsilon)
