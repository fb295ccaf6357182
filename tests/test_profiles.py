from adfeat.operators import profiles as P

HIST = "shop_id long, item_id long, user_id long, is_trade int, user_gender_id int, user_occupation_id string, user_age_level int, item_brand_id string"


def _hist(spark):
    rows = [
        (1, 10, 100, 1, 0, "A", 20, "b1"),
        (1, 10, 101, 0, 1, "B", 30, "b1"),
        (1, 11, 102, 1, 1, "A", 40, "b2"),
        (2, 12, None, 1, 2, "B", None, "b2"),
        (2, 12, 103, None, 0, "A", 50, "b2"),
    ]
    return spark.createDataFrame(rows, HIST)


def _tgt(spark):
    rows = [(1, 10, 100, 1), (2, 12, 103, 2), (3, 13, 104, 3), (4, 10, 101, None)]
    return spark.createDataFrame(rows, "instance_id long, item_id long, user_id long, shop_id long")


def test_untrade_minus_one_when_none(spark):
    out = P.untrade(_hist(spark), _tgt(spark), "shop_id", "shop")
    got = {r.instance_id: (r.shop_untrade_count, r.shop_untrade_ratio) for r in out.collect()}
    assert got[1] == (1, 1 / 3)  # shop 1: one non-conversion over three labelled rows
    assert got[2] == (-1, -1.0)  # shop 2: seen, but no non-conversion
    assert got[3] == (-1, -1.0) and got[4] == (-1, -1.0)  # unseen / null key


def test_trade_ratio_and_flags(spark):
    out = P.trade_ratio(_hist(spark), _tgt(spark), "shop_id", "shop")
    got = {r.instance_id: (r.shop_trade_sum, r.shop_trade_count, r.shop_trade_ratio) for r in out.collect()}
    assert got[1] == (3, 2, 2 / 3) and got[2] == (1, 1, 1.0) and got[3] == (0, 0, 0.0)
    flags = {r.instance_id: (r.shop_plus_2, r.ad_plus_5, r.user_plus_5) for r in P.threshold_flags(_hist(spark), _tgt(spark)).collect()}
    assert flags[1] == (1, 0, 0) and flags[2] == (0, 0, 0)


def test_occupation_ratio_null_without_conversions(spark):
    out = P.occupation_ratio(_hist(spark), _tgt(spark), ["A", "B"])
    got = {r.instance_id: (r.item_occ_a_ratio, r.item_occ_b_ratio) for r in out.collect()}
    assert got[1] == (1.0, None)  # item 10: A converts 1/1, B has 0 conversions → null
    assert got[2] == (None, 1.0)  # item 12: A row unlabelled, B converts 1/1
    assert got[3] == (None, None)


def test_gender_mix_over_grand_total(spark):
    out = P.gender_mix(_hist(spark), _tgt(spark))
    got = {r.instance_id: (r.gender_0, r.gender_1, r.gender_2, r.ad_gender0_ratio) for r in out.collect()}
    # labelled rows with a gender: 4 in all
    assert got[1] == (1, 1, None, 0.25)
    assert got[2] == (None, None, 1, None)


def test_audience_age_and_brand(spark):
    out = P.item_audience_age(_hist(spark), _tgt(spark))
    got = {r.instance_id: r.item_user_age_mean for r in out.collect()}
    assert got[1] == 25.0 and got[2] == 50.0 and got[3] == -1.0
    tgt = spark.createDataFrame([(1, "b1"), (2, "zz")], "instance_id long, item_brand_id string")
    got = {r.instance_id: (r.item_brand_sum, r.item_brand_count, r.item_brand_ratio) for r in P.attribute_ratio(_hist(spark), tgt, "item_brand_id").collect()}
    assert got[1] == (2, 1, 0.5) and got[2] == (0, 0, None)
