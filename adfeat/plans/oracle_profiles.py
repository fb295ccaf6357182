"""DuckDB oracle SQL for the tier-2 queries."""

from __future__ import annotations

from adfeat.plans.sql_views import cat_key, hour, with_views

N = "count(is_trade)"
CONV = "count(*) FILTER (WHERE is_trade = 1)"
UNCONV = "count(*) FILTER (WHERE is_trade = 0)"

OCCUPATIONS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
INDICATOR_IDS = ["c10", "c11", "c12", "c13", "c14"]


class Keyed:
    """``tgt`` rows with one or more per-key aggregates of ``hist`` attached."""

    def __init__(self, view: str = "imp_lineitem", hist: str = "hist", tgt: str = "tgt") -> None:
        self.view, self.hist, self.tgt = view, hist, tgt
        self.ctes: list[str] = []
        self.joins: list[str] = []
        self.cols: list[str] = []

    def add(self, keys: list[str], aggs: list[tuple[str, str]], fill: dict[str, str | None] | str | None = "0",
            post: dict[str, str] | None = None) -> Keyed:
        g = f"g{len(self.ctes)}"
        present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        body = ", ".join(f"{e} AS {c}" for c, e in aggs)
        self.ctes.append(f"{g} AS (SELECT {', '.join(keys)}, {body} FROM {self.hist} WHERE {present} GROUP BY {', '.join(keys)})")
        self.joins.append(f"LEFT JOIN {g} ON " + " AND ".join(f"t.{k} = {g}.{k}" for k in keys))
        for c, _ in aggs:
            f = fill.get(c) if isinstance(fill, dict) else fill
            expr = (post or {}).get(c, f"{g}.{c}").replace("{g}", g)
            self.cols.append(f"{expr} AS {c}" if f is None else f"coalesce({expr}, {f}) AS {c}")
        return self

    def sql(self, base: list[str], extra_ctes: str = "") -> str:
        ctes = "".join(f",\n{c}" for c in self.ctes)
        select = ", ".join([f"t.{c}" for c in base] + self.cols)
        return f"{with_views(self.view)}{extra_ctes}{ctes}\nSELECT {select}\nFROM {self.tgt} t\n" + "\n".join(self.joins)


SHOP_ATTRS = [
    "shop_review_num_level", "shop_review_positive_rate", "shop_star_level",
    "shop_score_service", "shop_score_delivery", "shop_score_description",
]
ITEM_ATTRS = ["item_price_level", "item_sales_level", "item_collected_level", "item_pv_level"]


def shop_profile_sql() -> str:
    aggs = [
        (f"{a}_mean", f"avg({a} - 4998)" if a == "shop_star_level" else f"avg({a})") for a in SHOP_ATTRS
    ]
    k = Keyed().add(["shop_id"], aggs, None)
    k.cols = [f"round(coalesce(g0.{c}, 0), 6) AS {c}" for c, _ in aggs]
    return k.sql(["instance_id", "shop_id"])


def item_profile_sql() -> str:
    return Keyed().add(["item_id"], [(f"{a}_mean", f"avg({a})") for a in ITEM_ATTRS]).sql(["instance_id", "item_id"])


def user_profile_sql() -> str:
    attrs = ["user_age_level", "user_star_level"]
    return Keyed().add(["user_id"], [(f"{a}_mean", f"avg({a})") for a in attrs]).sql(["instance_id", "user_id"])


def user_item_profile_sql() -> str:
    return (
        Keyed()
        .add(["user_id", "item_id"], [(f"{a}_mean", f"avg({a})") for a in ITEM_ATTRS])
        .sql(["instance_id", "user_id", "item_id"])
    )


def item_audience_age_sql() -> str:
    return (
        Keyed()
        .add(["item_id"], [("item_user_age_mean", "avg(user_age_level)")], "-1.0")
        .sql(["instance_id", "item_id"])
    )


def trade_ratio_sql(key: str, prefix: str) -> str:
    aggs = [
        (f"{prefix}_trade_sum", N),
        (f"{prefix}_trade_count", CONV),
        (f"{prefix}_trade_ratio", f"CASE WHEN {N} = 0 THEN NULL ELSE CAST({CONV} AS DOUBLE) / {N} END"),
    ]
    return Keyed().add([key], aggs).sql(["instance_id", key])


def untrade_sql(key: str, prefix: str) -> str:
    aggs = [
        (f"{prefix}_untrade_count", f"CASE WHEN {UNCONV} = 0 THEN NULL ELSE {UNCONV} END"),
        (f"{prefix}_untrade_ratio", f"CASE WHEN {UNCONV} = 0 THEN NULL ELSE CAST({UNCONV} AS DOUBLE) / {N} END"),
    ]
    fills = {f"{prefix}_untrade_count": "-1", f"{prefix}_untrade_ratio": "-1.0"}
    return Keyed().add([key], aggs, fills).sql(["instance_id", key])


def threshold_flags_sql() -> str:
    k = Keyed()
    k.add(["shop_id"], [("shop_plus_2", f"CASE WHEN {N} >= 2 THEN 1 ELSE 0 END")])
    k.add(["item_id"], [("ad_plus_5", f"CASE WHEN {CONV} >= 5 THEN 1 ELSE 0 END")])
    k.add(["user_id"], [("user_plus_5", f"CASE WHEN {N} >= 5 THEN 1 ELSE 0 END")])
    return k.sql(["instance_id", "shop_id", "item_id", "user_id"])


def attribute_ratio_sql(key: str) -> str:
    stem = key[: -len("_id")]
    aggs = [
        (f"{stem}_sum", N),
        (f"{stem}_count", CONV),
        (f"{stem}_ratio", f"CASE WHEN {N} = 0 THEN NULL ELSE CAST({CONV} AS DOUBLE) / {N} END"),
    ]
    fills = {f"{stem}_sum": "0", f"{stem}_count": "0", f"{stem}_ratio": None}
    return Keyed().add([key], aggs, fills).sql(["instance_id", key])


def occupation_ratio_sql() -> str:
    aggs = []
    for o in OCCUPATIONS:
        conv = f"count(*) FILTER (WHERE user_occupation_id = '{o}' AND is_trade = 1)"
        imps = f"count(is_trade) FILTER (WHERE user_occupation_id = '{o}')"
        aggs.append((f"item_occ_{o.lower()}_ratio", f"CASE WHEN {conv} = 0 THEN NULL ELSE CAST({conv} AS DOUBLE) / {imps} END"))
    return Keyed().add(["item_id"], aggs, None).sql(["instance_id", "item_id"])


def _map_sql(value: str, entries: dict[str, str]) -> str:
    """Text of ``key=millionths`` pairs per item, by key; null entries are left out."""
    pairs = ", ".join(
        f"string_agg(v || '=' || CAST(CAST(round(({e}) * 1e6) AS BIGINT) AS VARCHAR), ';' ORDER BY v) AS {name}" for name, e in entries.items()
    )
    return (
        with_views("imp_lineitem")
        + f""",
cells AS (SELECT item_id, CAST({value} AS VARCHAR) AS v, count(is_trade) AS n, count(*) FILTER (WHERE is_trade = 1) AS c
  FROM hist WHERE item_id IS NOT NULL AND {value} IS NOT NULL GROUP BY ALL),
maps AS (SELECT item_id, {pairs} FROM cells GROUP BY item_id)
SELECT tgt.instance_id, tgt.item_id, {', '.join(entries)} FROM tgt LEFT JOIN maps USING (item_id)"""
    )


def occupation_map_sql() -> str:
    return _map_sql("user_occupation_id", {"item_occ_ratio": "CASE WHEN c > 0 THEN c / CAST(n AS DOUBLE) END"})


def gender_map_sql() -> str:
    return _map_sql(
        "user_age_level",
        {"gender_counts": "CASE WHEN n > 0 THEN n END", "gender_ratios": "CASE WHEN n > 0 THEN n / (SELECT CAST(sum(n) AS DOUBLE) FROM cells) END"},
    )


def gender_mix_sql() -> str:
    total = "(SELECT CAST(count(is_trade) AS DOUBLE) FROM hist WHERE item_id IS NOT NULL AND user_gender_id IN (0, 1, 2))"
    aggs = [(f"gender_{g}", f"CASE WHEN count(is_trade) FILTER (WHERE user_gender_id = {g}) = 0 THEN NULL "
             f"ELSE count(is_trade) FILTER (WHERE user_gender_id = {g}) END") for g in range(3)]
    aggs += [(f"ad_gender{g}_ratio", f"CASE WHEN count(is_trade) FILTER (WHERE user_gender_id = {g}) = 0 THEN NULL "
              f"ELSE count(is_trade) FILTER (WHERE user_gender_id = {g}) / {total} END") for g in range(3)]
    return Keyed().add(["item_id"], aggs, None).sql(["instance_id", "item_id"])


def shop_user_trade_sql() -> str:
    conv = "count(user_id) FILTER (WHERE is_trade = 1)"
    unconv = "count(user_id) FILTER (WHERE is_trade = 0)"
    aggs = [
        ("shop_user_trade_count", f"CASE WHEN {conv} = 0 THEN NULL ELSE {conv} END"),
        ("shop_user_trade_ratio", f"CASE WHEN {conv} = 0 THEN NULL ELSE CAST({conv} AS DOUBLE) / {N} END"),
        ("shop_user_untrade_count", f"CASE WHEN {unconv} = 0 THEN NULL ELSE {unconv} END"),
        ("shop_user_untrade_ratio", f"CASE WHEN {unconv} = 0 THEN NULL ELSE CAST({unconv} AS DOUBLE) / {N} END"),
    ]
    fills = {"shop_user_trade_count": "-1", "shop_user_trade_ratio": "-1.0",
             "shop_user_untrade_count": "-1", "shop_user_untrade_ratio": "-1.0"}
    return Keyed().add(["shop_id"], aggs, fills).sql(["instance_id", "shop_id"])


def hour_ratio_sql() -> str:
    extra = (
        f",\nhx AS (SELECT *, {hour('context_timestamp')} AS hour FROM hist),\n"
        f"tx AS (SELECT *, {hour('context_timestamp')} AS hour FROM tgt)"
    )
    k = Keyed(view="imp_events", hist="hx", tgt="tx")
    k.add(["user_id", "hour"], [("time_user_sum", N)])
    k.add(["hour"], [("hour_trade_count", CONV)])
    k.cols.append(
        "CASE WHEN coalesce(g0.time_user_sum, 0) = 0 THEN NULL "
        "ELSE CAST(coalesce(g1.hour_trade_count, 0) AS DOUBLE) / g0.time_user_sum END AS time_user_ratio"
    )
    return k.sql(["instance_id", "user_id", "hour"], extra)


def category_indicators_sql() -> str:
    ids = ", ".join(f"'{i}'" for i in INDICATOR_IDS)
    cat = cat_key("item_category_list")
    flags = ", ".join(f"CASE WHEN {cat} = '{i}' THEN 1 ELSE 0 END AS cat_{i}" for i in INDICATOR_IDS)
    return (
        with_views("imp_events")
        + f"\nSELECT instance_id, item_category_list, CASE WHEN {cat} IN ({ids}) THEN 0 ELSE 1 END AS item_cat_dummies, "
        + flags
        + " FROM imp_events"
    )
