"""Mixing sources to target weights by soft memberships (operator 9); native expressions only.

A multinomial classifier over hashed words, fitted on the labelled table, gives every document
a posterior over the domains.  Nonnegative rates then solve

    minimise  1/2 sum_k (sum_d rate_d tokens_d posterior_dk - target_k)^2,   rate_d >= 0,

by projected gradient from rate 1: a step needs one aggregate over the documents (the
domains' expected totals and their Gram matrix over the rates that are not held at 0), whose
few numbers scale the next step.  A document's rate is the fold of the steps over its own
posterior, so nothing but the narrow table (id, tokens, posterior) is read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeat.llm.common import let, use_session
from adfeat.llm.native import labelled, numbers, total, word_hashes
from adfeat.sources.staging import stage


@dataclass(frozen=True)
class Domain:
    """``where`` is a condition on the labelled table; ``weight`` the wanted share of all tokens."""

    name: str
    where: str
    weight: float


#: Production domains of the labels table: mostly good text, a little of the rest.
DOMAINS = (
    Domain("good", "quality = 1 and toxic = 0", 0.92),
    Domain("low", "quality = 0 and toxic = 0", 0.05),
    Domain("toxic", "toxic = 1", 0.03),
)

#: Buckets of the classifier and added counts; words of evidence that a text counts for at most.
BUCKETS, SMOOTHING, EVIDENCE = 8192, 0.5, 400.0

#: Steps at most, and the relative distance from the targets at which they end.
STEPS, TOLERANCE = 25, 1e-6


def classifier(docs: DataFrame, labels: DataFrame, domains: Sequence[Domain], id_col: str = "doc_id", text_col: str = "text") -> tuple[list[list[float]], list[float]]:
    """Log-likelihoods per domain and bucket, and log priors, from at most 50,000 labelled rows."""
    kind = F.coalesce(*(F.when(F.expr(d.where), F.lit(i)) for i, d in enumerate(domains)))
    one = labels.select(F.col(id_col), kind.alias("k")).where("k is not null").groupBy(id_col).agg(F.min("k").alias("k"))
    picked = labelled(one, id_col)  # an id with two labels has the domain listed first
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t")).join(F.broadcast(picked.withColumnRenamed(id_col, "d")), "d")
    counts = np.full((len(domains), BUCKETS), SMOOTHING)
    words = rows.select("k", F.explode(F.transform(word_hashes(F.col("t")), lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))).alias("b"))
    for r in words.groupBy("k", "b").count().collect():  # at most len(domains) * BUCKETS rows
        counts[r.k, r.b] += r["count"]
    prior = np.ones(len(domains))
    for r in picked.groupBy("k").count().collect():
        prior[r.k] += r["count"]
    return np.log(counts / counts.sum(axis=1, keepdims=True)).tolist(), np.log(prior / prior.sum()).tolist()


def _softmax(scores: list[Column]) -> Column:
    return let(
        F.array(*scores),
        lambda x: let(F.transform(x, lambda v: F.exp(v - F.array_max(x))), lambda e: F.transform(e, lambda v: v / total(e))),
    )


def seed(doc_id: Column, text: Column) -> Column:
    """A row's own number: a hash of id and text."""
    return F.xxhash64(doc_id.cast("string"), F.coalesce(text, F.lit("")))


def _looked_up(h: Column, table: Column) -> Column:
    return F.transform(h, lambda w: F.get(table, F.pmod(w, F.lit(BUCKETS)).cast("int")))


def memberships(docs: DataFrame, log_likelihood: list[list[float]], log_prior: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, seed, n_words, posterior: array<double>) of every row; a text without words has the priors.

    Evidence beyond EVIDENCE words is scaled down to that many, so long texts stay soft.
    """
    tables = [numbers((np.array(row) - np.array(log_likelihood[0])).tolist()) for row in log_likelihood]

    def scores(h: Column) -> Column:
        scale = F.least(F.lit(1.0), F.lit(EVIDENCE) / F.greatest(F.size(h), F.lit(1)))
        parts = [F.lit(float(log_prior[0]))]
        for table, prior in zip(tables[1:], log_prior[1:], strict=True):
            parts.append(total(_looked_up(h, table)) * scale + F.lit(float(prior)))
        return F.struct(F.size(h).cast("bigint").alias("n"), _softmax(parts).alias("p"))

    text = F.col(text_col)
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), seed(F.col(id_col), text).alias("seed"), let(word_hashes(text), scores).alias("m"))
    return out.select("doc_id", "seed", F.col("m.n").alias("n_words"), F.col("m.p").alias("posterior"))


def _dot(posterior: Column, step: Column, k: int) -> Column:
    out = posterior[0] * step[0]
    for i in range(1, k):
        out = out + posterior[i] * step[i]
    return out


def rate_of(posterior: Column, steps: np.ndarray) -> Column:
    """The rate after the steps: from 1, minus each step's value for the posterior, never below 0."""
    k = steps.shape[1]
    if not len(steps):
        return F.lit(1.0)
    folded = F.array(*(numbers(s.tolist()) for s in steps))
    return F.aggregate(folded, F.lit(1.0), lambda r, s: F.greatest(F.lit(0.0), r - _dot(posterior, s, k)))


def solve(members: DataFrame, targets: np.ndarray) -> np.ndarray:
    """Steps (n, domains) of the projected gradient towards the token totals ``targets``."""
    k = len(targets)
    p, t = F.col("posterior"), F.col("n_words").cast("double")
    steps, best, least = np.zeros((0, k)), np.zeros((0, k)), np.inf
    whole = max(targets.sum(), 1.0)
    for _ in range(STEPS):
        rated = members.select(t.alias("t"), p.alias("posterior"), rate_of(p, steps).alias("r"))
        free = F.when(F.col("r") > 0, F.col("t")).otherwise(F.lit(0.0))
        sums = [F.sum(F.col("t") * F.col("r") * F.col("posterior")[i]) for i in range(k)]
        gram = [F.sum(free * F.col("posterior")[i] * F.col("posterior")[j]) for i in range(k) for j in range(k)]
        got = np.array([x or 0.0 for x in rated.agg(*sums, *gram).first()])
        miss, gram = (got[:k] - targets) / whole, got[k:].reshape(k, k) / whole
        if np.abs(miss).max() < least:
            least, best = np.abs(miss).max(), steps
        if least < TOLERANCE:
            break
        steps = np.vstack([steps, np.linalg.lstsq(gram, miss, rcond=1e-9)[0]])
    return best


def mix(docs: DataFrame, labels: DataFrame, domains: Sequence[Domain] = DOMAINS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, posterior, rate, copies, seed) of every row.

    The targets are the domains' weights times the words of all rows; ``copies`` rounds the
    rate by a hash of the row, so its expectation is the rate.  Rows without words keep rate 1
    as they move no total; a null id is allowed; repeated rows each get their rate.  Without
    labelled rows every posterior is the uniform prior, and the rates meet the total only.
    """
    use_session(docs.sparkSession)
    model = classifier(docs, labels, domains, id_col, text_col)
    members = stage(memberships(docs, *model, id_col, text_col), "mixing-members")
    words = members.agg(F.sum("n_words")).first()[0] or 0
    weights = np.array([d.weight for d in domains])
    steps = solve(members, weights / weights.sum() * words)
    rate = F.when(F.col("n_words") == 0, F.lit(1.0)).otherwise(rate_of(F.col("posterior"), steps))
    part = F.pmod(F.col("seed"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    out = members.select("doc_id", "seed", "n_words", "posterior", rate.alias("rate"))
    return out.select("doc_id", "n_words", "posterior", "rate", F.floor(F.col("rate") + part).cast("bigint").alias("copies"), "seed")
