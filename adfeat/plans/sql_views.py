"""DuckDB SQL for the fixture views and shared fragments of the oracle queries.

These are written independently of the Spark plans (plain SQL over the
driver's tables) so that ``oracle_sql()`` is a real cross-check.
"""

from __future__ import annotations

EVENTS_CUT = "2024-01-21"
LINEITEM_CUT = "2000-01-01"

IMP_EVENTS = """
imp_events AS (
  SELECT event_id AS instance_id,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS user_id,
         k AS item_id,
         k % 10 AS shop_id,
         CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_trade,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS context_timestamp,
         CASE WHEN k % 3 = 0 THEN concat('c0;c', k % 5)
              ELSE concat('c0;c', k % 5, ';c', 10 + k % 20) END AS item_category_list,
         concat('p', k % 3, ';p', k % 7, ';p', k % 11, ';p', k % 13, ';p', k % 17, ';p', k % 19,
                ';p', k % 23) AS item_property_list,
         CASE WHEN user_id % 4 = 0 THEN 'c99:p1'
              ELSE concat('c', user_id % 5, ':p1,p2;c', k % 5, ':p3;c', 10 + k % 20, ':-1') END
           AS predict_category_property
  FROM (SELECT *, CAST(replace(replace(props, '{"k": ', ''), '}', '') AS BIGINT) AS k FROM events) e
)"""

IMP_LINEITEM = """
imp_lineitem AS (
  SELECT l_orderkey * 10 + l_linenumber AS instance_id,
         o_custkey AS user_id,
         l_partkey AS item_id,
         l_suppkey AS shop_id,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_trade,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS context_timestamp,
         p_size AS item_price_level,
         CAST(p_partkey % 17 AS INTEGER) AS item_sales_level,
         CAST(p_partkey % 13 AS INTEGER) AS item_collected_level,
         CAST(p_partkey % 19 AS INTEGER) AS item_pv_level,
         p_brand AS item_brand_id,
         s_nationkey AS item_city_id,
         c_nationkey AS user_age_level,
         CAST(c_custkey % 11 AS INTEGER) AS user_star_level,
         c_nationkey % 3 AS user_gender_id,
         c_mktsegment AS user_occupation_id,
         CAST(s_suppkey % 15 AS INTEGER) AS shop_review_num_level,
         CAST(4999 + s_suppkey % 20 AS INTEGER) AS shop_star_level,
         s_acctbal / 10000 AS shop_review_positive_rate,
         s_acctbal / 11000 AS shop_score_service,
         s_acctbal / 12000 AS shop_score_delivery,
         s_acctbal / 13000 AS shop_score_description
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

# S1 / S3 in DuckDB terms (lists are 1-based, an index past the end is NULL).
CAT_KEY_SQL = (
    "CASE WHEN len(string_split({c}, ';')) <= 2 THEN string_split({c}, ';')[2] "
    "ELSE string_split({c}, ';')[3] END"
)
HOUR_SQL = "CAST(hour(strptime({c}, '%Y-%m-%d %H:%M:%S')) AS INTEGER)"


def cat_key(c: str) -> str:
    return CAT_KEY_SQL.format(c=c)


def hour(c: str) -> str:
    return HOUR_SQL.format(c=c)


def with_views(view: str) -> str:
    """``WITH <view>, hist, tgt`` for one fixture view and its cut."""
    body = IMP_EVENTS if view == "imp_events" else IMP_LINEITEM
    cut = EVENTS_CUT if view == "imp_events" else LINEITEM_CUT
    return (
        f"WITH {body.strip()},\n"
        f"hist AS (SELECT * FROM {view} WHERE context_timestamp < '{cut}'),\n"
        f"tgt AS (SELECT * FROM {view} WHERE context_timestamp >= '{cut}')"
    )


def frame_view(view: str) -> str:
    body = IMP_EVENTS if view == "imp_events" else IMP_LINEITEM
    return f"WITH {body.strip()}"
