"""DuckDB oracle SQL for the history → target queries."""

from __future__ import annotations

from adfeat.plans.sql_views import cat_key, hour, with_views

N = "count(is_trade)"
CONV = "count(*) FILTER (WHERE is_trade = 1)"
MEAN = "avg(is_trade)"

# name → (keys, [(column, aggregate)])  — one CTE per entry.
GROUPS: dict[str, tuple[list[str], list[tuple[str, str]]]] = {
    "shop": (["shop_id"], [("shop_trade_sum", N), ("shop_trade_count", CONV)]),
    "item": (["item_id"], [("item_trade_sum", N), ("item_trade_count", CONV)]),
    "user": (["user_id"], [("user_trade_sum", N), ("user_trade_count", CONV)]),
    "user_item": (["user_id", "item_id"], [("ad_user_count", N), ("ad_user_trade", CONV)]),
    "user_category": (["user_id", "ck"], [("user_cat_sum", N), ("user_cat_count", CONV)]),
    "user_shop": (["user_id", "shop_id"], [("user_shop_sum", N), ("user_shop_trade", CONV)]),
    "user_hour": (["user_id", "hour"], [("time_user_sum", N), ("time_user_count", CONV)]),
    "item_hour": (["item_id", "hour"], [("hour_item_sum", N), ("hour_item_count", CONV)]),
    "shop_hour": (["shop_id", "hour"], [("hour_shop_sum", N), ("hour_shop_count", CONV)]),
    "user_shop_hour_rate": (
        ["user_id", "shop_id", "hour"],
        [("user_shop_hour_sum", MEAN), ("user_shop_hour_count", CONV)],
    ),
    "user_item_hour": (
        ["user_id", "item_id", "hour"],
        [("user_item_hour_sum", N), ("user_item_hour_count", CONV)],
    ),
    "user_shop_hour_counts": (
        ["user_id", "shop_id", "hour"],
        [("user_shop_hour_sum", N), ("user_shop_hour_count", CONV)],
    ),
    # modular variants with a single column
    "item_n": (["item_id"], [("item_trade_sum", N)]),
    "user_hour_n": (["user_id", "hour"], [("time_user_sum", N)]),
}

SECTION_ORDER = [
    "shop", "item", "user", "user_item", "user_category", "user_shop",
    "user_hour", "item_hour", "shop_hour", "user_shop_hour_rate", "user_item_hour",
]
MODULAR_ORDER = [
    "shop", "item_n", "user", "user_item", "user_category", "user_shop",
    "user_hour_n", "item_hour", "shop_hour", "user_shop_hour_counts", "user_item_hour",
]


def _prelude() -> str:
    return (
        with_views("imp_events")
        + ",\nhx AS (SELECT user_id, item_id, shop_id, is_trade, "
        + f"{cat_key('item_category_list')} AS ck, {hour('context_timestamp')} AS hour FROM hist),\n"
        + f"tx AS (SELECT *, {cat_key('item_category_list')} AS ck, {hour('context_timestamp')} AS hour FROM tgt)"
    )


def _cte(name: str) -> str:
    keys, cols = GROUPS[name]
    aggs = ", ".join(f"{expr} AS {col}" for col, expr in cols)
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"g_{name} AS (SELECT {', '.join(keys)}, {aggs} FROM hx WHERE {present} GROUP BY {', '.join(keys)})"


def _join(name: str) -> str:
    keys, _ = GROUPS[name]
    cond = " AND ".join(f"tx.{k} = g_{name}.{k}" for k in keys)
    return f"LEFT JOIN g_{name} ON {cond}"


def _cols(name: str) -> list[str]:
    return [f"coalesce(g_{name}.{col}, 0) AS {col}" for col, _ in GROUPS[name][1]]


def group_sql(name: str, base_cols: list[str]) -> str:
    """Target rows (``base_cols``) plus one group's columns."""
    select = [f"tx.{c}" for c in base_cols] + _cols(name)
    return f"{_prelude()},\n{_cte(name)}\nSELECT {', '.join(select)}\nFROM tx {_join(name)}"


def chain_sql(order: list[str], base_cols: list[str]) -> str:
    ctes = ",\n".join(_cte(n) for n in order)
    select = [f"tx.{c}" for c in base_cols] + [c for n in order for c in _cols(n)]
    joins = "\n".join(_join(n) for n in order)
    return f"{_prelude()},\n{ctes}\nSELECT {', '.join(select)}\nFROM tx\n{joins}"


HISTORY_BASE = [
    "instance_id", "user_id", "item_id", "shop_id", "is_trade", "context_timestamp",
    "item_property_list", "predict_category_property", "hour",
]


def history_features_sql() -> str:
    return chain_sql(SECTION_ORDER, HISTORY_BASE)


def modular_features_sql() -> str:
    return chain_sql(MODULAR_ORDER, HISTORY_BASE)
