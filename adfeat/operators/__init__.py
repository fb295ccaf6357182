from adfeat.operators.counts import add_counts, attach, key_aggregate, key_counts
from adfeat.operators.ranks import add_time_ranks, rank_table
from adfeat.operators.smoothing import BetaPrior, fit_beta_prior, smoothed_rate

__all__ = [
    "BetaPrior",
    "add_counts",
    "add_time_ranks",
    "attach",
    "fit_beta_prior",
    "key_aggregate",
    "key_counts",
    "rank_table",
    "smoothed_rate",
]
