"""Features without a whole recomputation: daily cells, streamed cells; damaged logs, wide pivots, one-digit times."""

import os
import re
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adfeat.functions import hour_of, parse_time
from adfeat.operators.profiles import gender_mix, gender_mix_map, occupation_ratio, occupation_ratio_map
from adfeat.plans import history as H
from adfeat.plans.daily import add_days, cells_of
from adfeat.sources import imp_events, imp_lineitem, split_by_time
from adfeat.sources.ingest import ingest_csv, read_csv_lines, read_log, write_log
from adfeat.sources.views import EVENTS_CUT, LINEITEM_CUT, history_and_target
from adfeat.streaming import compact_changelog, impression_stream, latest_cells, remove_folded, streaming_cells, write_changelog

from conftest import SF_SMALL


def _same(a, b):
    assert dict(a.dtypes) == dict(b.dtypes) and a.count() == b.count()
    b = b.select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _folder(name):
    return os.path.join(tempfile.mkdtemp(prefix=f"adfeat-{name}-"), "t")


# ------------------------------------------------------------------ one-digit fields


def test_times_with_one_digit_are_parsed_and_in_order(spark):
    texts = ["2018-9-3 7:05:00", "2018-09-03 07:05:00", "2018-10-3 0:0:9", "2018-9-24 0:00:00", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, context_timestamp string")
    got = [(r.t, r.h) for r in df.select("i", parse_time("context_timestamp").cast("string").alias("t"), hour_of("context_timestamp").alias("h")).orderBy("i").collect()]
    assert got[:2] == [("2018-09-03 07:05:00", 7)] * 2 and got[2] == ("2018-10-03 00:00:09", 0) and got[4] == (None, None)
    hist, target = split_by_time(df, "2018-09-24")
    assert {r.i for r in hist.collect()} == {0, 1} and {r.i for r in target.collect()} == {2, 3}  # as text, 9 is after 10


# ------------------------------------------------------------------ daily cells


def test_a_day_more_equals_a_full_recomputation_and_reads_that_day(spark):
    log, cells = _folder("log"), _folder("cells")
    write_log(imp_events(spark, SF_SMALL), log)
    days = sorted(r.day for r in spark.read.parquet(log).select("day").distinct().collect())
    last = days[-5]
    cut, after = str(last), str(days[-4])
    add_days(read_log(spark, log, until=cut), cells)
    day = read_log(spark, log, since=cut, until=after)
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ >= ", plan)
    assert day.count() and all(f"day={cut}" in f for f in day.inputFiles() if "day=" in f and f"day={cut}" in f)
    add_days(day, cells)
    add_days(day, cells)  # a day added again replaces itself
    target = read_log(spark, log, since=after)
    whole = read_log(spark, log, until=after)
    for features in (H.history_features, H.modular_features):
        _same(features(cells_of(spark, cells), target), features(whole, target))
    _same(H.history_features(cells_of(spark, cells, until=cut), target), H.history_features(read_log(spark, log, until=cut), target))
    pruned = cells_of(spark, cells, since=cut).df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ >= ", pruned)


# ------------------------------------------------------------------ streamed cells


def _stream(spark, sf_dir, root):
    stream = split_by_time(impression_stream(spark, sf_dir, max_files=1), EVENTS_CUT)[0]
    q = write_changelog(streaming_cells(stream), os.path.join(root, "log"), os.path.join(root, "ckpt"))
    q.awaitTermination(300)
    assert q.exception() is None
    return os.path.join(root, "log")


def _files_in(path):
    return [f for folder, _, files in os.walk(path) for f in files if f.endswith(".parquet")]


def test_streamed_cells_give_all_groups_over_batches_and_a_restart(spark):
    root = tempfile.mkdtemp(prefix="adfeat-cells-")
    table = os.path.join(root, "events.parquet")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.where("event_id % 4 <> 0").repartition(5).write.parquet(table)
    log = _stream(spark, root, root)
    assert len([x for x in os.listdir(log) if x.startswith("_batch_id=")]) >= 3
    _, target = history_and_target(spark, SF_SMALL, "imp_events")
    part = imp_events(spark, root, until=EVENTS_CUT)
    _same(H.history_features(latest_cells(spark, log), target), H.history_features(part, target))
    assert compact_changelog(spark, log, H.CELL_KEYS, ["_n", "_c", "_s"]) >= 2
    assert remove_folded(spark, log) >= 3 and not _files_in(log)
    _same(H.history_features(latest_cells(spark, log), target), H.history_features(part, target))
    events.where("event_id % 4 = 0").coalesce(1).write.mode("append").parquet(table)
    _stream(spark, root, root)  # a restart from the checkpoint reads the new file alone
    hist, _ = history_and_target(spark, SF_SMALL, "imp_events")
    _same(H.history_features(latest_cells(spark, log), target), H.history_features(hist, target))
    _same(H.modular_features(latest_cells(spark, log), target), H.modular_features(hist, target))
    compact_changelog(spark, log, H.CELL_KEYS, ["_n", "_c", "_s"])
    remove_folded(spark, log)
    snapshots = [x for x in os.listdir(f"{log}__snapshots") if x.startswith("_snapshot_of=")]
    assert len(snapshots) == 1 and not _files_in(log)  # what is kept does not grow with the batches
    _same(H.history_features(latest_cells(spark, log), target), H.history_features(hist, target))


def test_a_stream_of_nothing_gives_zero_features(spark):
    root = tempfile.mkdtemp(prefix="adfeat-nothing-")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(0).write.parquet(os.path.join(root, "events.parquet"))
    _, target = history_and_target(spark, SF_SMALL, "imp_events")
    out = H.history_features(latest_cells(spark, _stream(spark, root, root)), target)
    assert out.count() == target.count() and out.agg(F.max("user_trade_sum")).first()[0] == 0
    assert remove_folded(spark, os.path.join(root, "log")) == 0


# ------------------------------------------------------------------ damaged logs, day partitions

HEADER = "instance_id,user_id,item_id,shop_id,is_trade,context_timestamp,other"
GOOD = ["1,5,7,2,1,2018-09-03 07:00:00,x", "2,,7,2,,2018-9-4 7:0:0,y", '3,5,7,2,0,,"a,b"']
BAD = ["4,5,7,2,1,yesterday,x", "five,5,7,2,1,2018-09-03 07:00:00,x", "6,5", "7,5,7,2,1,2018-09-03 07:00:00,x,y,z", "9999999999999999999999,1,1,1,1,2018-09-03 07:00:00,x"]


@pytest.mark.parametrize("header", [True, False])
def test_damaged_lines_are_all_in_quarantine(spark, header):
    folder = tempfile.mkdtemp(prefix="adfeat-bad-")
    for name, lines in (("a.csv", GOOD[:2] + BAD[:2]), ("b.csv", BAD[2:] + GOOD[2:])):
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write("\n".join([HEADER] * header + lines) + "\n")
    log, quarantine = _folder("log"), _folder("quarantine")
    columns = None if header else HEADER.split(",")
    ingest_csv(spark, folder, log, quarantine, columns)
    bad = spark.read.parquet(quarantine).collect()
    assert sorted(r.line for r in bad if r.reason == "malformed") == sorted(BAD[1:])
    assert [r.line.split(",")[:1] for r in bad if r.reason == "time"] == [["4"]] and all(r.file.endswith(".csv") for r in bad)
    rows = {r.instance_id: r for r in read_log(spark, log).collect()}
    assert sorted(rows) == [1, 2, 3] and rows[2].user_id is None and rows[3].context_timestamp is None
    days = {x for x in os.listdir(log) if x.startswith("day=")}
    assert days == {"day=2018-09-03", "day=2018-09-04", "day=__HIVE_DEFAULT_PARTITION__"}
    assert {r.instance_id for r in read_log(spark, log, since="2018-09-04").collect()} == {2}


def test_a_sound_log_has_an_empty_quarantine(spark):
    out = _folder("csv")
    df = imp_events(spark, SF_SMALL)
    df.write.option("header", "true").csv(out)
    good, bad = read_csv_lines(spark, out)
    assert bad.count() == 0
    _same(good, df.select(*good.columns))


# ------------------------------------------------------------------ pivots as maps


def test_twenty_thousand_occupations(spark):
    n = 20_000
    hist = spark.range(3 * n).select((F.col("id") % 3).alias("item_id"), F.concat(F.lit("o"), F.col("id") % n).alias("user_occupation_id"), (F.col("id") % 2).cast("int").alias("is_trade"))
    hist = hist.unionAll(hist.where("item_id = 0").withColumn("is_trade", F.lit(0)))
    base = spark.createDataFrame([(0,), (1,), (9,), (None,)], "item_id long")
    got = {r.item_id: r.item_occ_ratio for r in occupation_ratio_map(hist, base).collect()}
    imps, conv = Counter(), Counter()
    for i in range(3 * n):
        key = (i % 3, f"o{i % n}")
        imps[key] += 1 + (i % 3 == 0)
        conv[key] += i % 2
    assert got[9] is None and got[None] is None
    for item in (0, 1):
        assert got[item] == {o: conv[item, o] / c for (it, o), c in imps.items() if it == item and conv[item, o]}
    assert len(got[1]) == n // 2


def test_maps_equal_the_wide_form(spark):
    hist, target = split_by_time(imp_lineitem(spark, SF_SMALL), LINEITEM_CUT)
    wide = {r.instance_id: r.asDict() for r in occupation_ratio(hist, target).dropDuplicates(["instance_id"]).collect()}
    for r in occupation_ratio_map(hist, target).dropDuplicates(["instance_id"]).collect():
        entries = {k.lower(): v for k, v in (r.item_occ_ratio or {}).items()}
        assert entries == {c[len("item_occ_"):-len("_ratio")]: v for c, v in wide[r.instance_id].items() if c.startswith("item_occ_") and v is not None} or r.item_id != wide[r.instance_id]["item_id"]
    wide = {(r.instance_id, r.item_id): r for r in gender_mix(hist, target).collect()}
    for r in gender_mix_map(hist, target).collect():
        w, counts, ratios = wide[r.instance_id, r.item_id], r.gender_counts or {}, r.gender_ratios or {}
        for g in range(3):
            assert w[f"gender_{g}"] == counts.get(str(g)) and w[f"ad_gender{g}_ratio"] == ratios.get(str(g))
