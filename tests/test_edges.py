from pyspark.sql import functions as F

from adfeat.operators.counts import key_counts
from adfeat.operators.smoothing import fit_beta_prior
from adfeat.plans.history import SECTION, history_features
from adfeat.sources.views import history_and_target

from conftest import SF_SMALL


def test_empty_history_gives_zero_features(spark):
    hist, tgt = history_and_target(spark, SF_SMALL, "imp_events")
    out = history_features(hist.limit(0), tgt)
    assert out.count() == tgt.count()
    feats = [c for g in SECTION.values() for c in g.outputs()]
    row = out.select(*[F.max(F.abs(F.col(c))).alias(c) for c in feats]).first()
    assert all(v == 0 for v in row)


def test_all_null_labels_count_nothing(spark):
    hist, tgt = history_and_target(spark, SF_SMALL, "imp_events")
    out = history_features(hist.withColumn("is_trade", F.lit(None).cast("int")), tgt)
    assert out.agg(F.max("shop_trade_sum"), F.max("user_shop_hour_sum")).first() == (0, 0.0)


def test_beta_fit_on_nothing_keeps_the_prior(spark):
    pairs = spark.createDataFrame([], "n long, c long")
    p = fit_beta_prior(pairs, "n", "c", 2.0, 3.0, 10, 0.0)
    assert (p.alpha, p.beta, p.iterations) == (2.0, 3.0, 0)


def test_counts_of_empty_log(spark):
    empty = spark.createDataFrame([], "shop_id long, is_trade int")
    assert key_counts(empty, ["shop_id"], n="n", conv="c").count() == 0
