"""DuckDB oracle SQL for the within-frame queries.

Average ranks are written the textbook way — ``rank()`` plus half the extra
peers over a window — rather than the block decomposition the Spark plan uses.
"""

from __future__ import annotations

from adfeat.plans.sql_views import cat_key, frame_view

PARSED = f"""
fx AS (
  SELECT *,
         strptime(context_timestamp, '%Y-%m-%d %H:%M:%S') AS ts_,
         {cat_key('item_category_list')} AS item_category,
         list_transform(string_split(predict_category_property, ';'), lambda x: string_split(x, ':')[1]) AS pred,
         string_split(item_property_list, ';') AS props
  FROM imp_events
),
fy AS (
  SELECT *,
         CAST(CASE WHEN item_category IS NULL THEN NULL
                   ELSE coalesce(list_position(pred, item_category), 0) - 1 END AS BIGINT) AS predict_category_rank,
         CAST(len(props) AS INTEGER) AS property_len,
         props[1] AS item_pro1, props[2] AS item_pro2, props[3] AS item_pro3, props[4] AS item_pro4,
         props[5] AS item_pro5, props[6] AS item_pro6, props[7] AS item_pro7
  FROM fx
)"""

FRAME_COUNTS = [
    (["user_id"], "user_sum_label"),
    (["item_id"], "item_sum_label"),
    (["shop_id"], "shop_sum_label"),
    (["user_id", "item_id"], "user_item_sum_label"),
    (["user_id", "shop_id"], "user_shop_sum_label"),
]
PROPERTY_COUNTS = [
    (["item_pro1"], "item_pro1_sum_x"),
    (["item_pro2"], "item_pro2_sum"),
    (["item_pro3"], "item_pro3_sum"),
    (["item_pro4"], "item_pro4_sum"),
]
PROPERTY_CROSSES = [
    (["user_id", "item_pro1"], "user_pro1_sum"),
    (["item_id", "item_pro1"], "item_pro1_sum_y"),
    (["shop_id", "item_pro1"], "shop_pro1_sum"),
    (["user_id", "shop_id", "item_pro1"], "user_shop_pro1_sum"),
    (["user_id", "item_id", "item_pro1"], "user_item_pro1_sum"),
]
ENTITY_RANKS = [
    (["shop_id"], "shop", ("last", "first")),
    (["user_id"], "user", ("last", "first")),
    (["item_id"], "item", ("last", "first")),
    (["user_id", "item_id"], "user_item", ("last", "first")),
    (["user_id", "shop_id"], "user_shop", ("last", "first")),
]
PROPERTY_RANKS = [
    (["item_pro1"], "item_pro1", ("last", "first")),
    (["item_pro2"], "item_pro2", ("first", "last")),
    (["item_pro3"], "item_pro3", ("first", "last")),
    (["item_pro4"], "item_pro4", ("last", "first")),
    (["item_pro5"], "item_pro5", ("first", "last")),
    (["item_pro6"], "item_pro6", ("first", "last")),
    (["item_pro7"], "item_pro7", ("first", "last")),
]
PRED = "predict_category_rank"
PREDICT_COUNTS = [
    (["user_id", PRED], [("user_predict_sum", "count(instance_id)")]),
    (["shop_id", PRED], [("shop_preidct_sum", "count(instance_id)")]),
    (["item_id", PRED], [("item_predict_sum", "count(instance_id)")]),
    (["user_id", "item_id", PRED], [("user_item_pre_sum", "avg(instance_id)"), ("user_item_pre_count", "count(instance_id)")]),
    (["user_id", "shop_id", PRED], [("user_shop_pre_sum", "count(instance_id)")]),
]


class Parts:
    """Accumulates CTEs, joins and select items of one oracle query over ``fy``."""

    def __init__(self) -> None:
        self.ctes: list[str] = []
        self.joins: list[str] = []
        self.cols: list[str] = []
        self.n = 0

    def counts(self, specs, src: str = "fy", fill: str = "0") -> None:
        for keys, cols in specs:
            if isinstance(cols, str):
                cols = [(cols, "count(instance_id)")]
            self.n += 1
            a = f"a{self.n}"
            present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
            aggs = ", ".join(f"{e} AS {c}" for c, e in cols)
            self.ctes.append(
                f"{a} AS (SELECT {', '.join(keys)}, {aggs} FROM {src} WHERE {present} GROUP BY {', '.join(keys)})"
            )
            cond = " AND ".join(f"t.{k} = {a}.{k}" for k in keys)
            self.joins.append(f"LEFT JOIN {a} ON {cond}")
            self.cols += [f"coalesce({a}.{c}, {fill}) AS {c}" for c, _ in cols]

    def ranks(self, specs) -> None:
        for keys, prefix, order in specs:
            self.cols += rank_columns(keys, prefix, order, alias="t")

    def sql(self, prelude: str, base_cols: list[str], src: str = "fy") -> str:
        ctes = "".join(f",\n{c}" for c in self.ctes)
        select = ", ".join([f"t.{c}" for c in base_cols] + self.cols)
        joins = "\n".join(self.joins)
        return f"{prelude}{ctes}\nSELECT {select}\nFROM {src} t\n{joins}"


def rank_columns(keys: list[str], prefix: str, order, alias: str = "t", ts: str = "ts_") -> list[str]:
    part = ", ".join(f"{alias}.{k}" for k in keys)
    valid = " AND ".join([f"{alias}.{k} IS NOT NULL" for k in keys] + [f"{alias}.{ts} IS NOT NULL"])
    first = (
        f"(rank() OVER (PARTITION BY {part} ORDER BY {alias}.{ts}) "
        f"+ (count(*) OVER (PARTITION BY {part}, {alias}.{ts}) - 1) / 2.0)"
    )
    n = f"count({alias}.{ts}) OVER (PARTITION BY {part})"
    exprs = {
        "first": f"CASE WHEN {valid} THEN {first} END",
        "last": f"CASE WHEN {valid} THEN {n} + 1 - {first} END",
    }
    out = []
    for d in order:
        out.append(f"CAST({exprs[d]} AS DOUBLE) AS {prefix}_{d}_rank")
        out.append(f"CASE WHEN {exprs[d]} = 1 THEN 1 ELSE 0 END AS {prefix}_if_{d}")
    return out


def _prelude() -> str:
    return frame_view("imp_events") + "," + PARSED


def category_cte(parts: Parts) -> None:
    parts.ctes.append(
        "cat_n AS (SELECT item_category, count(instance_id) AS n FROM fy "
        "WHERE item_category IS NOT NULL GROUP BY item_category)"
    )
    parts.ctes.append("cat_r AS (SELECT min(n) AS lo, max(n) AS hi FROM cat_n)")
    parts.ctes.append(
        "cat_s AS (SELECT item_category, CASE WHEN hi = lo THEN NULL "
        "ELSE CAST(n - lo AS DOUBLE) / (hi - lo) END AS item_category_sum FROM cat_n, cat_r)"
    )
    parts.joins.append("LEFT JOIN cat_s ON t.item_category = cat_s.item_category")
    parts.cols.append("cat_s.item_category_sum AS item_category_sum")


def frame_counts_sql() -> str:
    p = Parts()
    p.counts(FRAME_COUNTS)
    return p.sql(_prelude(), ["instance_id", "user_id", "item_id", "shop_id", "context_timestamp"])


def predicted_rank_sql() -> str:
    return (
        _prelude()
        + "\nSELECT instance_id, item_category_list, predict_category_property, predict_category_rank FROM fy"
    )


def category_popularity_sql() -> str:
    p = Parts()
    category_cte(p)
    return p.sql(_prelude(), ["instance_id", "item_category_list"])


def property_counts_sql() -> str:
    p = Parts()
    p.cols.append("t.property_len")
    p.counts(PROPERTY_COUNTS)
    return p.sql(_prelude(), ["instance_id", "item_property_list"])


def property_cross_sql() -> str:
    p = Parts()
    p.counts(PROPERTY_CROSSES)
    return p.sql(_prelude(), ["instance_id", "user_id", "item_id", "shop_id", "item_property_list"])


def property_time_rank_sql() -> str:
    p = Parts()
    p.ranks(PROPERTY_RANKS)
    return p.sql(_prelude(), ["instance_id", "item_property_list", "context_timestamp"])


def predict_rank_counts_sql() -> str:
    p = Parts()
    p.counts(PREDICT_COUNTS)
    return p.sql(_prelude(), ["instance_id", "user_id", "item_id", "shop_id", PRED])


def entity_time_rank_sql(keys: list[str], prefix: str) -> str:
    """Ranks on ``imp_lineitem`` (every time is midnight, so ties abound)."""
    prelude = (
        frame_view("imp_lineitem")
        + ",\nfy AS (SELECT *, strptime(context_timestamp, '%Y-%m-%d %H:%M:%S') AS ts_ FROM imp_lineitem)"
    )
    p = Parts()
    p.ranks([(keys, prefix, ("last", "first"))])
    return p.sql(prelude, ["instance_id", "user_id", "item_id", "shop_id", "context_timestamp"])


def frame_features_sql() -> str:
    p = Parts()
    p.cols += ["t.predict_category_rank", "t.property_len"]
    p.counts(FRAME_COUNTS)
    p.ranks(ENTITY_RANKS)
    category_cte(p)
    p.counts(PROPERTY_COUNTS + PROPERTY_CROSSES)
    p.ranks(PROPERTY_RANKS)
    p.counts(PREDICT_COUNTS)
    base = ["instance_id", "user_id", "item_id", "shop_id", "is_trade", "context_timestamp", "item_category_list"]
    return p.sql(_prelude(), base)


def filled_frame_sql() -> str:
    """After the first counts a null user is user 0; those counts still know which were null."""
    fill = "coalesce(user_id, 0) AS user_id, coalesce(is_trade, 0) AS is_trade"
    prelude = _prelude() + f",\nfz AS (SELECT * REPLACE ({fill}), user_id AS raw_user FROM fy)"
    p = Parts()
    p.ctes.append(
        "raw_n AS (SELECT user_id AS raw_user, count(instance_id) AS n FROM fy WHERE user_id IS NOT NULL GROUP BY user_id)"
    )
    p.joins.append("LEFT JOIN raw_n ON t.raw_user = raw_n.raw_user")
    p.cols.append("coalesce(raw_n.n, 0) AS user_sum_label")
    p.ranks([(["user_id"], "user", ("last", "first"))])
    p.counts([(["user_id", "item_pro1"], "user_pro1_sum"), (["user_id", PRED], "user_predict_sum")], src="fz")
    return p.sql(prelude, ["instance_id", "user_id", "is_trade"], src="fz")
