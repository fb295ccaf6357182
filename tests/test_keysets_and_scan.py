"""Many key sets in one aggregate and probe, and ranks by one sort and scan."""

import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from adfeat.operators import keysets, rank_scan
from adfeat.operators.rank_scan import add_scanned_ranks, borders, scan_ranks, scanned
from adfeat.operators.ranks import add_time_ranks
from adfeat.plans import frame as FR
from adfeat.plans import history as H
from adfeat.sources.views import history_and_target, imp_events, imp_lineitem

from conftest import SF_SMALL


def _frame(spark, rows):
    df = spark.createDataFrame(rows, "rid long, k string, j long, t string")
    return df.withColumn("ts", F.to_timestamp("t")).repartition(3)


def _pandas_ranks(rows):
    pdf = pd.DataFrame(rows, columns=["rid", "k", "j", "t"])
    g = pdf.groupby(["k", "j"])["t"]
    return pdf.assign(first=g.rank(method="average"), last=g.rank(method="average", ascending=False)).set_index("rid")


@pytest.mark.parametrize("seconds", [1, 3, 600])
@pytest.mark.parametrize("part_rows", [3, 40, 500_000])
def test_scan_equals_pandas_with_ties_across_borders(spark, seconds, part_rows):
    """Two keys hold most rows; with ``seconds`` = 1 all of a key's rows are one tie over many partitions."""
    rnd = random.Random(seconds)
    keys = [("hot", 1)] * 150 + [("hot", 2)] * 60 + [(f"k{i}", i % 3) for i in range(30)] * 3 + [(None, 1), ("hot", None)]
    rows = [(i, k, j, None if i % 29 == 0 else f"2024-01-01 00:{(s := rnd.randrange(seconds)) // 60:02d}:{s % 60:02d}") for i, (k, j) in enumerate(keys)]
    out = add_scanned_ranks(_frame(spark, rows), ["k", "j"], "ts", "x", part_rows=part_rows)
    got = out.toPandas().set_index("rid").sort_index()
    want = _pandas_ranks(rows).loc[got.index]
    pd.testing.assert_series_equal(got.x_first_rank, want["first"], check_names=False)
    pd.testing.assert_series_equal(got.x_last_rank, want["last"], check_names=False)
    assert ((got.x_if_first == 1) == (want["first"] == 1)).all() and ((got.x_if_last == 1) == (want["last"] == 1)).all()


def test_a_hot_key_lies_in_several_partitions(spark):
    rows = [(i, "hot", 1, "2024-01-01 00:00:00") for i in range(400)]
    df = scan_ranks(_frame(spark, rows), ["k", "j"], "ts", part_rows=50)
    staged = [p for p in df.inputFiles()]
    parts = spark.read.parquet(*staged).groupBy("_part").count().collect()
    assert len(parts) >= 4 and max(r["count"] for r in parts) <= 200
    assert {(r._first, r._last) for r in df.collect()} == {(200.5, 200.5)}


def test_scan_of_nothing(spark):
    df = _frame(spark, [(1, None, 1, "2024-01-01 00:00:00"), (2, "a", 1, None)])
    assert [tuple(r) for r in add_scanned_ranks(df, ["k", "j"], "ts", "x").select("x_last_rank", "x_if_last").collect()] == [(None, 0)] * 2
    assert add_scanned_ranks(df.limit(0), ["k", "j"], "ts", "x").count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_borders_equal_one_scan_of_everything(seed):
    """Any cut of a sorted table into partitions gives the ranks of the whole."""
    rng = np.random.default_rng(seed)
    for _ in range(60):
        n = int(rng.integers(1, 60))
        key, ts = rng.integers(0, 4, n), rng.integers(0, int(rng.integers(1, 8)), n)
        order = np.lexsort((ts, key))
        key, ts = key[order], ts[order]
        whole = scanned([key], ts)
        cuts = np.unique(np.r_[0, rng.integers(0, n + 1, rng.integers(0, 9)), n])
        parts, runs = [], []
        for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            s = scanned([key[a:b]], ts[a:b])
            parts.append((a, s))
            for r in set(s["_run"].tolist()) - {-1}:
                i = np.flatnonzero(s["_run"] == r)
                at = lambda c, i=i, s=s: int(s["_peers"][i][s[c][i]].max())
                runs.append({"part": p, "run": r, "key": (key[a + i[0]],), "n": int(s["_n"][i[0]]), "lo": ts[a + i].min(), "hi": ts[a + i].max(), "at_lo": at("_lo"), "at_hi": at("_hi")})
        fix = {(r[0], r[1]): r[2:] for r in borders(runs)}
        for p, (a, s) in enumerate(parts):
            for i in range(len(s["_run"])):
                before, peers, total = s["_before"][i], s["_peers"][i], s["_n"][i]
                f = fix.get((p, s["_run"][i]))
                if f:
                    add, total, same, lo_all, hi_all = f
                    before = before + add - (same if s["_lo"][i] else 0)
                    peers = lo_all if s["_lo"][i] else hi_all if s["_hi"][i] else peers
                assert (before, peers, total) == (whole["_before"][a + i], whole["_peers"][a + i], whole["_n"][a + i])


def test_both_rank_algorithms_agree(spark):
    log = imp_lineitem(spark, SF_SMALL).select("instance_id", "shop_id", F.to_timestamp("context_timestamp").alias("_ts"))
    a, b = add_scanned_ranks(log, ["shop_id"], "_ts", "shop", part_rows=700), add_time_ranks(log, ["shop_id"], "_ts", "shop")
    assert a.columns == b.columns and a.exceptAll(b).count() == 0 and a.count() == b.count()


@pytest.mark.parametrize("hot", [1, 20, 10**9])
def test_hot_and_cold_keys_give_the_same(spark, monkeypatch, hot):
    """Few keys broadcast, all of them, or none."""
    hist, tgt = history_and_target(spark, SF_SMALL, "imp_events")
    want = H.history_features(hist, tgt).collect()
    monkeypatch.setattr(keysets, "HOT", hot)
    assert sorted(map(repr, H.history_features(hist, tgt).collect())) == sorted(map(repr, want))


def _exchanges_of(spark, monkeypatch, build):
    """Shuffles of all plans that a query runs, staged tables included, with broadcasts off."""
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in before:
        spark.conf.set(k, "-1")
    plans, put = [], H.stage

    def staged(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return put(df, name)

    for module in (H, FR, rank_scan):
        monkeypatch.setattr(module, "stage", staged)
    try:
        plans.append(build()._jdf.queryExecution().executedPlan().toString())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return plans


def test_history_shuffles_six_times_at_most(spark, monkeypatch):
    hist, tgt = history_and_target(spark, SF_SMALL, "imp_events")
    plans = _exchanges_of(spark, monkeypatch, lambda: H.history_features(hist, tgt))
    assert sum(len(re.findall(r"Exchange (?:hash|range)partitioning", p)) for p in plans) <= 6
    joins = re.findall(r"SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin", plans[-1])
    assert len(joins) <= 4  # hot keys, what is not hot, cold keys, the wide rows


def test_frame_shuffles_eight_times_at_most_and_the_wide_rows_once(spark, monkeypatch):
    plans = _exchanges_of(spark, monkeypatch, lambda: FR.frame_features(imp_events(spark, SF_SMALL)))
    assert sum(len(re.findall(r"Exchange (?:hash|range)partitioning", p)) for p in plans) <= 8
    assert len(re.findall(r"SortMergeJoin \[_row#\d+L\], \[_row#\d+L\], LeftOuter", plans[-1])) == 1


def test_tasks_of_the_frame_hold_a_bounded_number_of_rows(spark, monkeypatch):
    """The keys are summed, and the answers of a row id met, in partitions that follow the row count."""
    label = imp_events(spark, SF_SMALL)
    n, want = label.count(), sorted(map(repr, FR.frame_features(label).collect()))
    monkeypatch.setattr(keysets, "MELT_ROWS", 1000)
    assert sorted(map(repr, FR.frame_features(label).collect())) == want
    plans = _exchanges_of(spark, monkeypatch, lambda: FR.frame_features(label))
    sums = next(p for p in plans if "RoundRobinPartitioning" in p)
    assert [int(x) for x in re.findall(r"RoundRobinPartitioning\((\d+)\)", sums)] == [n * k // 1000 + 1 for k in (5, 15)]
    parts = n * 32 // 1000 + 1  # 20 key sets and 12 rank sets; both sides of the join on the id
    assert len(re.findall(rf"hashpartitioning\(_row#\d+L, {parts}\), REPARTITION_BY_NUM", plans[-1])) == 2
    # the answers are shuffled as they are: no aggregate by the id under that exchange
    assert len(re.findall(r"HashAggregate\(keys=\[_row#", plans[-1].split("REPARTITION_BY_NUM")[-1])) == 0


def test_the_ends_of_a_partition_are_marked():
    assert rank_scan._ends(np.array([0, 0, 0, -1, 1, 1])).tolist() == [True, False, True, False, True, True]
    assert rank_scan._ends(np.array([0])).tolist() == [True] and rank_scan._ends(np.array([0, 0])).tolist() == [True, True]


@pytest.mark.parametrize("section", ["frame", "history"])
def test_cold_keys_meet_in_partitions_sized_by_rows_and_are_not_sorted(spark, monkeypatch, section):
    """Neither side of the cold keys' join is sorted, and a task holds a bounded part of the table."""
    hist, tgt = history_and_target(spark, SF_SMALL, "imp_events")
    label = imp_events(spark, SF_SMALL)
    rows, sets = (label.count(), 20) if section == "frame" else (tgt.count(), 11)
    monkeypatch.setattr(keysets, "MELT_ROWS", 100)
    build = (lambda: FR.frame_features(label, fill_inputs=True)) if section == "frame" else lambda: H.history_features(hist, tgt)
    plan = _exchanges_of(spark, monkeypatch, build)[-1]
    assert not re.search(r"SortMergeJoin \[_set#", plan) and len(re.findall(r"ShuffledHashJoin \[_set#", plan)) == 1
    parts = max(spark.sparkContext.defaultParallelism, rows * sets // 100 + 1)
    assert len(re.findall(rf"hashpartitioning\(_set#[^)]*, {parts}\), REPARTITION_BY_NUM", plan)) == 2


@pytest.mark.parametrize("hot", [1, 20, 10**9])
def test_filled_frame_is_the_same_however_many_keys_are_hot(spark, monkeypatch, hot):
    label = spark.createDataFrame(
        [(i, None if i % 7 == 0 else i % 5, i % 11 or None, i % 3, i % 2, f"2024-01-0{i % 4 + 1} 00:00:0{i % 9}", f"c0;c{i % 2}", f"p{i % 3};p{i % 4}", f"c{i % 2}:p1") for i in range(90)],
        "instance_id long, user_id long, item_id long, shop_id long, is_trade int, context_timestamp string, item_category_list string, item_property_list string, predict_category_property string",
    )
    got = {}
    for h in (1000, hot):
        monkeypatch.setattr(keysets, "HOT", h)
        got[h] = sorted(map(repr, FR.frame_features(label, fill_inputs=True).collect()))
    assert got[1000] == got[hot] and len(got[hot]) == 90
