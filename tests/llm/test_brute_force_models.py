"""Posteriors, rates and language probabilities computed again, one word, row and byte at a time."""

import math

import numpy as np
import pytest
import xxhash
from conftest import SF_SMALL  # tests/conftest.py

from adfeat.llm import language, mixing


def bucket(word):
    h = xxhash.xxh64_intdigest(word.encode(), seed=42)  # Spark's xxhash64
    return (h - (h >> 63 << 64)) % mixing.BUCKETS


def softmax(x):
    e = [math.exp(v - max(x)) for v in x]
    return [v / sum(e) for v in e]


@pytest.fixture(scope="module")
def mixed(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    return docs, labels, {d: [w.decode() for w in t.split()] for d, t in texts.items()}


def test_classifier_and_posteriors(spark, mixed):
    docs, labels, words = mixed
    counts, prior = np.full((3, mixing.BUCKETS), mixing.SMOOTHING), np.ones(3)
    kinds = {}
    for r in labels.collect():
        k = 2 if r.toxic == 1 else 0 if r.quality == 1 else 1
        kinds[r.doc_id] = min(k, kinds.get(r.doc_id, k))
    for d, k in kinds.items():
        prior[k] += 1
        for w in words.get(d, ()):
            counts[k, bucket(w)] += 1
    likelihood, log_prior = mixing.classifier(docs, labels, mixing.DOMAINS)
    np.testing.assert_allclose(likelihood, np.log(counts / counts.sum(axis=1, keepdims=True)), rtol=1e-12)
    np.testing.assert_allclose(log_prior, np.log(prior / prior.sum()), rtol=1e-12)
    for r in mixing.memberships(docs, likelihood, log_prior).collect():
        ws = words[r.doc_id]
        scale = min(1.0, mixing.EVIDENCE / max(len(ws), 1))
        want = softmax([p + scale * sum(row[bucket(w)] - likelihood[0][bucket(w)] for w in ws) for row, p in zip(likelihood, log_prior, strict=True)])
        assert r.n_words == len(ws) and np.allclose(r.posterior, want, atol=1e-9)


def test_rates_meet_the_targets_and_are_stationary(spark, mixed):
    """Expected tokens of every domain equal the targets, with no rate below 0."""
    docs, labels, words = mixed
    rows = mixing.mix(docs, labels).collect()
    got, total = np.zeros(3), 0
    for r in rows:
        assert r.rate >= 0 and r.copies in (math.floor(r.rate), math.floor(r.rate) + 1)
        got += np.array(r.posterior) * r.rate * r.n_words
        total += r.n_words
    weights = np.array([d.weight for d in mixing.DOMAINS])
    np.testing.assert_allclose(got, weights / weights.sum() * total, rtol=1e-4)


def test_the_network_forward_byte_by_byte():
    rng = np.random.default_rng(3)
    p = {k: v.astype(np.float64) for k, v in language._start(3, seed=5).items()}
    p["bias"] = rng.normal(size=(3, 1))
    model = language.LanguageModel(["a", "b", "c"], {k: v.astype(np.float32) for k, v in p.items()})
    h, sigmoid = language.HIDDEN, lambda x: 1 / (1 + np.exp(-x))

    def states(data, d):
        s, out = np.zeros(h), {}
        for i in range(len(data)) if d == "f" else range(len(data) - 1, -1, -1):
            x, u = p[f"{d}_x"][:, data[i]], p[f"{d}_u"] @ s
            z, r = sigmoid(x[:h] + u[:h]), sigmoid(x[h : 2 * h] + u[h : 2 * h])
            s = z * s + (1 - z) * np.tanh(x[2 * h :] + r * u[2 * h :])
            out[i] = s
        return out

    texts = ["a", "Der Hund läuft. ", "x" * (language.WINDOW + 7), ""]
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    got = model.pooled(data, offsets)
    for i, t in enumerate(texts):
        b, total = t.encode(), np.zeros(3)
        for lo in range(0, len(b), language.WINDOW):
            part = b[lo : lo + language.WINDOW]
            f, g = states(part, "f"), states(part, "b")
            for j in range(len(part)):
                total += softmax((p["f_out"] @ f[j] + p["b_out"] @ g[j] + p["bias"][:, 0]).tolist())
        assert np.allclose(got[i], total / max(len(b), 1), atol=1e-4)
