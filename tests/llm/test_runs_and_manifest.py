"""Periodic runs and the Merkle manifest against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest import SF_SMALL  # tests/conftest.py
from pyspark.sql import functions as F

from adfeat.llm import queries
from adfeat.llm.merkle import build_manifest, descend, fold, leaf_digest, prove, segment
from adfeat.llm.periodic import first_gram, periodic_runs, runs_of

from .conftest import CLASHES, LONG, rows_of


def brute_runs(w, least=24, exponent=3):
    """Every stretch of equal words q apart that is long enough and has no smaller period."""
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            s = i
            while i < n - q and w[i] == w[i + q]:
                i += 1
            length = i - s + q
            if i > s and length >= max(least, exponent * q) and not any(w[s : s + length - d] == w[s + d : s + length] for d in range(1, q)):
                out.append((s, length, q))
            i += i == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_the_first_gram_is_what_every_period_guarantees():
    for least, exponent in ((24, 3), (1, 3), (10, 4), (100, 3)):
        overlaps = [max(least - q, (exponent - 1) * q) for q in range(1, 300)]
        assert first_gram(least, exponent) <= min(overlaps) < 2 * first_gram(least, exponent)


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(120):
        docs = []
        for _ in range(rng.randint(1, 4)):
            w = []
            for _ in range(rng.randint(0, 5)):
                k = rng.randint(1, 3)
                u = [rng.randrange(k) for _ in range(rng.randint(1, 40))]
                if rng.random() < 0.5:  # periods whose grams repeat inside
                    v = [rng.randrange(k) for _ in range(rng.randint(1, 6))]
                    u = v * rng.randint(1, 5) + u + v * rng.randint(1, 6)
                w += u * rng.randint(1, 6) + u[: rng.randrange(len(u))]
            docs.append(w)
        x, doc = np.array([a for d in docs for a in d], np.int64), np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        for least, exponent in ((24, 3), (10, 4)):
            want, at = [], 0
            for d in docs:
                want += [(s + at, n, q) for s, n, q in brute_runs(d, least, exponent)]
                at += len(d)
            assert [tuple(r) for r in runs_of(x, doc, least, exponent).tolist()] == want


def test_one_word_a_million_times_is_one_run():
    assert runs_of(np.zeros(10**6, np.int64), np.zeros(10**6, np.int64)).tolist() == [[0, 10**6, 1]]


def op12_brute(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    values = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *values, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_op12_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect() if len((r.text or "").split()) < 2000]
    got = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, SF_SMALL).collect()}
    want = {d: op12_brute(d, t) for d, t in docs}
    assert {d: got[d] for d in want} == want and any(w[1] for w in want.values())


def test_periodic_runs_on_edge_rows(spark, edges, nothing):
    wide = edges.select("*", *[F.lit("x").alias(c) for c in [*CLASHES, "runs", "collapsed"]])
    got = rows_of(periodic_runs(edges).select(*edges.columns, "runs", "collapsed"))
    assert rows_of(periodic_runs(wide).select(*edges.columns, "runs", "collapsed")) == got and len(got) == edges.count()
    by_text = {r.text: r for r in periodic_runs(edges).collect()}
    assert by_text[None].collapsed is None and by_text[None].runs == [] and by_text[""].collapsed == ""
    run = by_text[LONG].runs[0]
    assert (run.start, run.length, run.period) == (0, 14 * 3000, 14) and by_text[LONG].collapsed == LONG[:69].strip()
    assert periodic_runs(nothing).count() == 0


# ------------------------------------------------------------------ Merkle manifest

LEAF = queries.LEAF


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in LEAF))


def levels_of(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def proof_of(levels, i):
    out = []
    for nodes in levels[:-1]:
        s = i // 3 * 3
        out.append((nodes[s:i], nodes[i + 1 : s + 3]))
        i //= 3
    return out


def manifest_brute(rows):
    """[(row, leaf, subroot, root, proof)]"""
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        own = sorted((r for r in rows if r["source"] == s), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees.append((own, levels_of([leaf_of(r) for r in own])))
    top = levels_of([levels[-1][0] for _, levels in trees])
    return [
        (r, leaf_of(r), levels[-1][0], top[-1][0], proof_of(levels, i) + proof_of(top, k))
        for k, (own, levels) in enumerate(trees)
        for i, r in enumerate(own)
    ]


def op13_brute(rows):
    out = []
    for r, leaf, subroot, root, proof in manifest_brute(rows):
        brought = dict(r)
        if r["doc_id"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
            brought["text"] = r["text"].replace("\n", "")
        folded = leaf_of(brought)
        for left, right in proof:
            folded = H(*left, folded, *right)
        out.append((r["doc_id"], leaf, subroot, root, H(*(d for left, right in proof for d in left + right)), folded, folded == root))
    return sorted(out, key=repr)


def test_op13_equals_brute_force(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = rows_of(queries.op13_merkle_manifest(spark, SF_SMALL))
    assert got == op13_brute(rows) and {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_of_edge_rows_and_many_sources(spark, edges, levels):
    """Trees of 1 to 100 leaves and 40 sources in segments of 3, 9 and 729; repeated rows and null ids are leaves."""
    more = spark.range(100).selectExpr("id", "'t' || id % 7", "'en'", "CASE WHEN id < 60 THEN 'big' ELSE 's' || id END", "id")
    docs = edges.unionAll(more).unionAll(more.limit(1))
    rows = [r.asDict() for r in docs.collect()]
    clash = docs.select("*", *[F.lit("x").alias(c) for c in ("tree", "place", "digest", "size", "path", "proof", "top")])
    m = build_manifest(clash.repartition(7), LEAF, carry={"doc_id": F.col("doc_id")}, levels=levels)
    got = prove(m).select("doc_id", "digest", "subroot", F.lit(m.root), "proof").collect()
    want = [(r["doc_id"], leaf, sub, root, p) for r, leaf, sub, root, p in manifest_brute(rows)]
    flat = [(r[0], r[1], r[2], r[3], [(s.siblings[: s.at], s.siblings[s.at :]) for s in r[4]]) for r in got]
    assert sorted(flat, key=repr) == sorted(want, key=repr)
    assert prove(m).where(fold(F.col("digest"), F.col("proof")) != m.root).count() == 0
    some = m.leaves.where("doc_id % 10 = 3")
    assert rows_of(prove(m, some)) == rows_of(prove(m).where("doc_id % 10 = 3"))


def test_manifest_of_nothing_and_of_one_row(spark, nothing, edges):
    m = build_manifest(nothing, LEAF)
    assert m.root is None and prove(m).count() == 0
    m = build_manifest(edges.where("doc_id = 2"), LEAF)
    row = prove(m).first()
    assert row.digest == row.subroot == m.root == edges.where("doc_id = 2").select(leaf_digest(*(F.col(c) for c in LEAF))).first()[0] and row.proof == []


def test_descent_in_one_segment():
    digests = [H(str(i)) for i in range(20)]
    root, height, nodes, children = segment(digests, None)
    below = dict(zip(nodes, children, strict=True))
    assert height == 3 and [descend(root, below, i, height)[0] for i in range(20)] == digests
    assert segment(digests[:1], 2)[:2] == (H(H(digests[0])), 2)
