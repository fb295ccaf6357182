"""Plan-shape guards for the properties the 100 TB design depends on."""

import re

import pytest

import __spark_entry__ as E
from adfeat.functions import parse_time
from adfeat.operators.ranks import add_time_ranks
from adfeat.sources.views import imp_lineitem

from conftest import SF_SMALL

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["history_features", "frame_features", "shop_profile", "user_smoothed_rate"])
def test_no_cartesian_or_python(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    for bad in BAD:
        assert bad not in plan, f"{name}: {bad}"


def test_time_cut_reaches_the_scan(spark):
    plan = _plan(E.queries()["shop_counts"](spark, SF_SMALL))
    scans = re.findall(r"FileScan parquet [^\n]*", plan)
    assert scans and all("LessThan(ts" in s or "GreaterThanOrEqual(ts" in s for s in scans)


def test_branches_read_pruned_columns(spark):
    plan = _plan(E.queries()["shop_counts"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert any("value" not in s for s in schemas)  # the unused event column is never read
    assert all("value:" not in s for s in schemas)


def test_block_plan_has_no_key_only_window_over_rows(spark):
    base = imp_lineitem(spark, SF_SMALL).withColumn("_ts", parse_time("context_timestamp"))
    plan = _plan(add_time_ranks(base, ["shop_id"], "_ts", "shop"))
    # the running count is partitioned by (key, block), and every window sits above an aggregate
    assert re.search(r"Window \[.*\], \[shop_id#\d+L, _blk#\d+L\]", plan)
    assert "HashAggregate" in plan


def _exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", _plan(df)))


def test_one_melted_rank_table_serves_the_properties(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()["property_time_rank"](spark, SF_SMALL)
        plan = _plan(df)
        assert _exchanges(df) <= 10
        # no raw row is shuffled by a property alone: every exchange on a value also has the time or the index
        for keys in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan):
            assert not re.fullmatch(r"_value#\d+, \d+", keys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["frame_counts", "property_counts", "property_cross_counts", "predict_rank_counts"])
def test_step_queries_shuffle_the_frame_once_by_row(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(E.queries()[name](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    wide = [x for x in re.findall(r"Exchange hashpartitioning\(_row#\d+L, \d+\)", plan)]
    parts = len(re.findall(r"SortMergeJoin \[_row#\d+L\], \[_row#\d+L\], LeftOuter", plan))
    assert parts and len(wide) == parts + 1


def test_scalars_start_no_job(spark):
    """D14 plans its scalar as a subquery, and so does B17."""
    from adfeat.operators.profiles import gender_mix
    from adfeat.sources.views import history_and_target

    tracker = spark.sparkContext.statusTracker()
    hist, tgt = history_and_target(spark, SF_SMALL, "imp_lineitem")
    spark.sparkContext.setJobGroup("plan-only", "")
    gender_mix(hist, tgt)
    assert not tracker.getJobIdsForGroup("plan-only")
    spark.sparkContext.setJobGroup("", "")
    assert "Subquery" in _plan(E.queries()["category_popularity"](spark, SF_SMALL))


def test_null_keys_are_split_by_the_skew_rule(spark):
    """A third of the target without a key: AQE splits that partition of the attach."""
    from pyspark.sql import functions as F

    from adfeat.operators.counts import attach

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 != 0, F.col("id") % 997)
        target = spark.range(0, 60_000, numPartitions=8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        out = attach(target, spark.range(0, 997).select(F.col("id").alias("k"), F.lit(1).alias("n")), ["k"])
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 60_000 and out.where("k is null and n = 0").count() == 20_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
