"""Spherical-cap filters against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from adfeat.llm import embedding_dedup as E

from .conftest import rows_of

SCHEMA = "vec_id long, embedding array<double>, label int"

#: Codewords of a table of 32,000 rows.
W = 2048


def brute(rows, cosine=0.9):
    unit = {}
    for i, (d, v) in enumerate(rows):
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            x = np.array(v) / np.abs(v).max()
            unit[i] = x / np.linalg.norm(x)
    links = {(i, j) for i in unit for j in unit if i != j and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine}
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in links:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, sum(i == a for a, _ in links), least[find(i)], least[find(i)] == d) for i, (d, _) in enumerate(rows))


def got(df):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def clustered(rng, n=300, d=64):
    centres = rng.normal(size=(12, d))
    out = []
    for i in range(n):
        c = centres[rng.integers(0, 12)]
        v = c + rng.normal(size=d) * rng.choice([0.05, 0.3, 0.45, 2.0])
        out.append((i, (v * rng.uniform(0.1, 10)).tolist()))
    return out


@pytest.mark.parametrize("block", [512, 16])
def test_clusters_against_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(E, "BLOCK_ROWS", block)  # small blocks: filters are compared block against block
    rows = clustered(np.random.default_rng(block))
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # equal vectors
    df = spark.createDataFrame([(a, b, 0) for a, b in rows], SCHEMA)
    assert got(E.near_vectors(df)) == brute(rows)


def test_vectors_that_link_with_nothing_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, None), (2, []), (3, [0.0] * 4), (4, [nan, 1.0, 1.0, 1.0]), (5, [inf, 1.0, 1.0, 1.0]), (6, [None, 1.0, 1.0, 1.0]),
            (7, v), (8, v), (9, [2.0, 4.0, 6.0, 8.0]), (10, [-1.0, -2.0, -3.0, -4.0]), (11, v[:3]), (12, [1e-200, 2e-200, 3e-200, 4e-200]), (13, [1e200, 2e200, 3e200, 4e200])]
    df = spark.createDataFrame([(a, b, None) for a, b in rows], SCHEMA)
    assert got(E.near_vectors(df)) == brute(rows)
    out = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in E.near_vectors(spark.createDataFrame([(None, v, 1), (None, v, 1), (3, v, 1), (None, None, 1)], SCHEMA)).collect()}
    assert out == {(None, 2, None, True), (3, 2, 3, True), (None, 0, None, True)}


def test_empty_table_and_clashing_columns(spark):
    assert E.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = clustered(np.random.default_rng(1), 60)
    df = spark.createDataFrame([(a, b, 0) for a, b in rows], SCHEMA)
    more = df.select("*", *[F.lit(1).alias(c) for c in ("id", "filters", "vector", "left", "rows", "component", "n_links", "kept")])
    assert rows_of(E.near_vectors(more)) == rows_of(E.near_vectors(df))


def test_lists_hold_the_best_directions():
    """Against scoring every direction of a small code."""
    rng = np.random.default_rng(2)
    v = rng.normal(size=(5, 8))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    codes = E.product_codes(8, W)
    lists = E.filters_of(v, W)
    for c, (rotation, (one, two)) in enumerate(codes):
        x = v @ rotation
        every = (x[:, : one.shape[1]] @ one.T)[:, :, None] + (x[:, one.shape[1] :] @ two.T)[:, None, :]
        first = (8 * E.CODES + c) * W**2
        for i in range(5):
            own = [f - first for f in lists[i] if first <= f < first + W**2]
            assert len(own) == E.listed(8)
            best = np.sort(every[i].ravel())[-E.listed(8)]
            assert all(every[i].ravel()[f] >= best - 1e-12 for f in own)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(3)
    v = rng.normal(size=(1500, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    o = rng.normal(size=v.shape)
    o -= (o * v).sum(axis=1, keepdims=True) * v
    o /= np.linalg.norm(o, axis=1, keepdims=True)
    a, b = E.filters_of(v, W), E.filters_of(0.9 * v + np.sqrt(1 - 0.81) * o, W)
    assert np.mean([len(np.intersect1d(x, y)) > 0 for x, y in zip(a, b)]) > 0.995


def test_codewords_follow_the_rows():
    """So many directions that each draws as few vectors by chance in a table of any size."""
    assert E.codewords(0) == E.codewords(500) == E.LEAST_WORDS and E.codewords(10**12) == E.MOST_WORDS
    for rows in (10_000, 50_000, 10**6, 10**8):
        assert 1 <= E.codewords(rows) ** 2 / (E.DIRECTIONS * rows) < 1.01
    assert W == E.codewords(32_766)


@pytest.mark.parametrize(("dimension", "n_words"), [(16, 256), (16, 2048), (64, 256), (64, 8192), (384, 2048)])
def test_recall_by_dimension_and_codewords(dimension, n_words):
    rng = np.random.default_rng(dimension + n_words)
    a, o = rng.normal(size=(2, 400, dimension))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    o -= (a * o).sum(axis=1, keepdims=True) * a
    o /= np.linalg.norm(o, axis=1, keepdims=True)
    one, two = E.filters_of(a, n_words), E.filters_of(0.9 * a + np.sqrt(1 - 0.81) * o, n_words)
    assert np.mean([len(np.intersect1d(x, y)) > 0 for x, y in zip(one, two, strict=True)]) >= 0.99
