"""``name → DuckDB SQL`` for every query in ``queries.registry()`` that SQL can express."""

from __future__ import annotations

from adfeat.plans import oracle_frame as OF
from adfeat.plans import oracle_history as OH
from adfeat.plans import oracle_profiles as OP
from adfeat.plans import oracle_smoothing as OS
from adfeat.plans.sql_views import frame_view

EVENT_BASE = ["instance_id", "user_id", "item_id", "shop_id", "is_trade", "context_timestamp"]

_HISTORY_GROUPS = {
    "shop_counts": "shop",
    "item_counts": "item",
    "user_counts": "user",
    "user_item_counts": "user_item",
    "user_category_counts": "user_category",
    "user_shop_counts": "user_shop",
    "user_hour_counts": "user_hour",
    "item_hour_counts": "item_hour",
    "shop_hour_counts": "shop_hour",
    "user_shop_hour_rate": "user_shop_hour_rate",
    "user_shop_hour_counts": "user_shop_hour_counts",
    "user_item_hour_counts": "user_item_hour",
}


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for name, group in _HISTORY_GROUPS.items():
        keys, _ = OH.GROUPS[group]
        base = EVENT_BASE + (["hour"] if "hour" in keys else [])
        out[name] = OH.group_sql(group, base)
    out["history_features"] = OH.history_features_sql()
    out["modular_features"] = OH.modular_features_sql()
    out["frame_counts"] = OF.frame_counts_sql()
    out["predicted_category_rank"] = OF.predicted_rank_sql()
    out["category_popularity"] = OF.category_popularity_sql()
    out["property_counts"] = OF.property_counts_sql()
    out["property_cross_counts"] = OF.property_cross_sql()
    out["property_time_rank"] = OF.property_time_rank_sql()
    out["predict_rank_counts"] = OF.predict_rank_counts_sql()
    for name, keys, prefix in [
        ("shop_time_rank", ["shop_id"], "shop"),
        ("user_time_rank", ["user_id"], "user"),
        ("item_time_rank", ["item_id"], "item"),
        ("user_item_time_rank", ["user_id", "item_id"], "user_item"),
        ("user_shop_time_rank", ["user_id", "shop_id"], "user_shop"),
    ]:
        out[name] = OF.entity_time_rank_sql(keys, prefix)
    out["frame_features"] = OF.frame_features_sql()
    out["filled_frame"] = OF.filled_frame_sql()
    out["csv_user_item_counts"] = OH.group_sql("user_item", EVENT_BASE)
    out["csv_log_features"] = OH.group_sql("user_item", EVENT_BASE).replace("FROM events) e", "FROM events WHERE event_id % 13 <> 0) e")
    out["csv_quarantine"] = (
        "SELECT CASE WHEN event_id % 39 = 26 THEN 'time' ELSE 'malformed' END AS reason, count(*) AS n_lines "
        "FROM events WHERE event_id % 13 = 0 GROUP BY ALL"
    )
    one_digit = "strftime(CAST(tx.context_timestamp AS TIMESTAMP), '%Y-%-m-%-d %-H:%-M:%-S') AS context_timestamp"
    out["one_digit_times"] = OH.group_sql("user_hour", [*EVENT_BASE, "hour"]).replace("tx.context_timestamp", one_digit)
    out["daily_history_features"] = out["streaming_history_features"] = out["history_features"]
    out["shop_digamma"] = OS.shop_digamma_sql()
    out["beta_prior"] = OS.beta_prior_sql()
    out["shop_smoothed_rate"] = OS.key_smoothed_sql("shop_id", "shop")
    out["item_smoothed_rate"] = OS.key_smoothed_sql("item_id", "item")
    out["user_smoothed_rate"] = OS.user_smoothed_sql()
    out["shop_profile"] = OP.shop_profile_sql()
    out["item_profile"] = OP.item_profile_sql()
    out["user_profile"] = OP.user_profile_sql()
    out["user_item_profile"] = OP.user_item_profile_sql()
    out["item_audience_age"] = OP.item_audience_age_sql()
    for key, prefix in (("shop_id", "shop"), ("item_id", "item"), ("user_id", "user")):
        out[f"{prefix}_ratio"] = OP.trade_ratio_sql(key, prefix)
        out[f"{prefix}_untrade"] = OP.untrade_sql(key, prefix)
    out["threshold_flags"] = OP.threshold_flags_sql()
    out["brand_ratio"] = OP.attribute_ratio_sql("item_brand_id")
    out["city_ratio"] = OP.attribute_ratio_sql("item_city_id")
    out["item_occupation_ratio"] = OP.occupation_ratio_sql()
    out["item_occupation_map"] = OP.occupation_map_sql()
    out["item_gender_map"] = OP.gender_map_sql()
    out["item_gender_mix"] = OP.gender_mix_sql()
    out["shop_user_trade"] = OP.shop_user_trade_sql()
    out["hour_ratio"] = OP.hour_ratio_sql()
    out["category_indicators"] = OP.category_indicators_sql()
    out["streaming_user_shop_counts"] = (
        frame_view("imp_events")
        + "\nSELECT user_id, shop_id, count(is_trade) AS user_shop_sum, "
        "count(*) FILTER (WHERE is_trade = 1) AS user_shop_trade FROM imp_events "
        "WHERE user_id IS NOT NULL AND shop_id IS NOT NULL GROUP BY user_id, shop_id"
    )
    return out
