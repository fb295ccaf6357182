from pyspark.sql import functions as F

from adfeat.operators.profiles import category_indicators
from adfeat.plans.frame import frame_features, frame_subset
from adfeat.plans import history as H
from adfeat.plans.history import history_features, modular_features
from adfeat.sources.schema import IMPRESSION_FIELDS
from adfeat.sources.views import history_and_target, imp_events

from conftest import SF_SMALL

ROW = "instance_id long, user_id long, item_id long, shop_id long, is_trade int, context_timestamp string, " \
      "item_category_list string, item_property_list string, predict_category_property string"


def test_single_category_scales_to_null(spark):
    rows = [(i, 1, 1, 1, 0, "2024-01-01 00:00:0%d" % i, "a;b", "p0;p1;p2;p3;p4;p5;p6", "b:x") for i in range(3)]
    out = frame_subset(spark.createDataFrame(rows, ROW), "category_popularity")
    vals = [r.item_category_sum for r in out.collect()]
    assert vals == [None, None, None]


def test_frame_features_shape(spark):
    out = frame_features(imp_events(spark, SF_SMALL))
    n = imp_events(spark, SF_SMALL).count()
    assert out.count() == n
    assert "item_pro1_sum_x" in out.columns and "item_pro1_sum_y" in out.columns
    assert "shop_preidct_sum" in out.columns and "user_item_pre_count" in out.columns
    for dropped in ("item_property_list", "predict_category_property", "item_pro1", "_ts"):
        assert dropped not in out.columns
    feats = [c for c in out.columns if c not in {f.name for f in IMPRESSION_FIELDS}]
    assert len(feats) == 71  # 70 of the reference + user_item_pre_count


def test_history_features_properties(spark):
    hist, tgt = history_and_target(spark, SF_SMALL, "imp_events")
    out = history_features(hist, tgt)
    assert out.count() == tgt.count()
    assert "item_category_list" not in out.columns
    pairs = [("shop_trade_sum", "shop_trade_count"), ("ad_user_count", "ad_user_trade"),
             ("user_item_hour_sum", "user_item_hour_count"), ("time_user_sum", "time_user_count")]
    bad = out.where(" OR ".join(f"{c} > {n}" for n, c in pairs)).count()
    assert bad == 0  # conversions never exceed impressions
    assert dict(out.dtypes)["user_shop_hour_sum"] == "double"  # the mean form
    assert out.where(F.col("user_id").isNull() & (F.col("user_trade_sum") != 0)).count() == 0


def test_modular_chain_columns(spark):
    hist, tgt = history_and_target(spark, SF_SMALL, "imp_events")
    out = modular_features(hist, tgt)
    assert dict(out.dtypes)["user_shop_hour_sum"] == "bigint"  # the count form
    assert "item_trade_count" not in out.columns and "time_user_count" not in out.columns


def test_category_indicators(spark):
    df = spark.createDataFrame([("x",), ("c1",), (None,)], "cat string")
    got = [tuple(r) for r in category_indicators(df, "cat", ["c1", "c2"]).collect()]
    assert got == [("x", 1, 0, 0), ("c1", 0, 1, 0), (None, 1, 0, 0)]


def _direct(hist, target, groups):
    """Each group aggregated from the log and attached to the rows, one after the other."""
    h, t = H.prepare_history(hist), H.prepare_target(target).drop("item_category_list")
    for g in groups:
        t = H.add_group(t, h, g)
    return t.drop(H.CAT_KEY)


def _same(a, b):
    assert a.columns == b.columns and dict(a.dtypes) == dict(b.dtypes)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_history_features_equal_the_plain_chain(spark):
    hist, tgt = history_and_target(spark, SF_SMALL, "imp_events")
    _same(history_features(hist, tgt), _direct(hist, tgt, H.SECTION.values()))


def test_modular_features_equal_the_plain_chain(spark):
    hist, tgt = history_and_target(spark, SF_SMALL, "imp_events")
    out = modular_features(hist, tgt)
    _same(out, _direct(hist, tgt, H.MODULAR))
    given = [c for c in tgt.columns if c != "item_category_list"]
    assert out.columns == [*given, "hour", *[c for g in H.MODULAR for c in g.outputs()]]


def test_modular_methods_one_by_one(spark):
    hist, tgt = history_and_target(spark, SF_SMALL, "imp_events")
    steps = [H.shop_feat, H.ad_feat, H.user_feat, H.user_ad, H.user_shop, H.user_context, H.ad_context,
             H.shop_context, H.user_shop_context, H.user_ad_context]
    t = tgt
    for step in steps:
        t = step(hist, t)
    out = modular_features(hist, tgt)
    assert set(t.columns) == set(out.columns)
    assert out.exceptAll(t.select(*out.columns)).count() == 0


def test_fill_inputs_makes_null_keys_the_key_zero(spark):
    hist = spark.createDataFrame([(1, 0, 1, 1, 1, "2024-01-01 00:00:00", "a;b", "p", "b:x"),
                                  (2, 5, 1, 1, 0, "2024-01-01 00:00:00", "a;b", "p", "b:x")], ROW)
    tgt = spark.createDataFrame([(9, None, 1, 1, None, "2024-02-01 00:00:00", "a;b", "p", "b:x")], ROW)
    plain = history_features(hist, tgt).first()
    filled = history_features(hist, tgt, fill_inputs=True).first()
    assert (plain.user_id, plain.user_trade_sum, plain.is_trade) == (None, 0, None)
    assert (filled.user_id, filled.user_trade_sum, filled.user_trade_count, filled.is_trade) == (0, 1, 1, 0)


def test_fill_inputs_in_the_frame(spark):
    rows = [(i, u, 1, 1, 0, "2024-01-01 00:00:0%d" % i, "a;b", "p0;p1;p2;p3;p4;p5;p6", "b:x")
            for i, u in enumerate([None, None, 7])]
    label = spark.createDataFrame(rows, ROW)
    plain = {r.instance_id: r for r in frame_features(label).collect()}
    filled = {r.instance_id: r for r in frame_features(label, fill_inputs=True).collect()}
    assert [plain[i].user_first_rank for i in range(3)] == [None, None, 1.0]
    assert [filled[i].user_first_rank for i in range(3)] == [1.0, 2.0, 1.0]
    assert [filled[i].user_sum_label for i in range(3)] == [0, 0, 1]  # counted before the fill
    assert [filled[i].user_pro1_sum for i in range(3)] == [2, 2, 1]  # and after it


def test_frame_steps_equal_the_whole_section(spark):
    label = imp_events(spark, SF_SMALL)
    whole = frame_features(label)
    for step in ("counts", "entity_ranks", "category_popularity", "property_counts", "property_crosses",
                 "property_ranks", "predict_rank_counts"):
        part = frame_subset(label, step)
        cols = ["instance_id", *[c for c in part.columns if c in whole.columns and c not in label.columns]]
        assert whole.select(*cols).exceptAll(part.select(*cols)).count() == 0
