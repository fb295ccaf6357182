"""Impression logs derived from the driver's tables, and the history/target split.

``imp_events``   – ``events`` reshaped into an impression log (hour features, lists).
``imp_lineitem`` – ``lineitem ⋈ orders ⋈ part ⋈ customer ⋈ supplier`` with the
                   attribute columns (ties in time, tier-2 profiles).

Both accept ``since`` / ``until`` bounds that are applied to the *raw*
timestamp column, so the cut reaches the parquet scan as a pushed filter
instead of being evaluated on a formatted string after the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adfeat.functions import parse_time

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Fixed split points of the two fixture views (target = on or after the cut).
EVENTS_CUT = "2024-01-21"
LINEITEM_CUT = "2000-01-01"


def _bounded(df: DataFrame, ts: str, since: str | None, until: str | None) -> DataFrame:
    ts_type = df.schema[ts].dataType
    if since is not None:
        df = df.where(F.col(ts) >= F.lit(since).cast(ts_type))
    if until is not None:
        df = df.where(F.col(ts) < F.lit(until).cast(ts_type))
    return df


def imp_events(
    spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    return imp_events_from(_bounded(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts", since, until))


def imp_events_from(ev: DataFrame) -> DataFrame:
    """Shape an ``events`` DataFrame (batch or streaming) into the impression log."""
    k = F.replace(F.replace(F.col("props"), F.lit('{"k": '), F.lit("")), F.lit("}"), F.lit("")).cast(
        "bigint"
    )
    ev = ev.select("event_id", "ts", "user_id", "event_type", k.alias("k"))
    k = F.col("k")

    def mod(c: Column, m: int) -> Column:
        return c % F.lit(m)

    props = [F.lit("p"), mod(k, 3)]
    for m in (7, 11, 13, 17, 19, 23):
        props += [F.lit(";p"), mod(k, m)]
    src_user = F.col("user_id")
    return ev.select(
        F.col("event_id").alias("instance_id"),
        F.when(mod(F.col("event_id"), 97) == 0, F.lit(None).cast("bigint"))
        .otherwise(src_user)
        .alias("user_id"),
        k.alias("item_id"),
        mod(k, 10).alias("shop_id"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("int"))
        .when(F.col("event_type") == "purchase", F.lit(1))
        .otherwise(F.lit(0))
        .alias("is_trade"),
        F.date_format("ts", TS_FORMAT).alias("context_timestamp"),
        F.when(mod(k, 3) == 0, F.concat(F.lit("c0;c"), mod(k, 5)))
        .otherwise(F.concat(F.lit("c0;c"), mod(k, 5), F.lit(";c"), F.lit(10) + mod(k, 20)))
        .alias("item_category_list"),
        F.concat(*props).alias("item_property_list"),
        F.when(mod(src_user, 4) == 0, F.lit("c99:p1"))
        .otherwise(
            F.concat(
                F.lit("c"), mod(src_user, 5), F.lit(":p1,p2;c"), mod(k, 5),
                F.lit(":p3;c"), F.lit(10) + mod(k, 20), F.lit(":-1"),
            )
        )
        .alias("predict_category_property"),
    )


def imp_lineitem(
    spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    li = _bounded(read("lineitem"), "l_shipdate", since, until).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate"
    )
    orders = read("orders").select("o_orderkey", "o_custkey")
    part = read("part").select("p_partkey", "p_brand", "p_size")
    cust = read("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    supp = read("supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    j = (
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .join(part, li.l_partkey == part.p_partkey)
        .join(cust, F.col("o_custkey") == cust.c_custkey)
        .join(supp, li.l_suppkey == supp.s_suppkey)
    )
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("instance_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_suppkey").alias("shop_id"),
        F.when(F.col("l_returnflag") == "R", F.lit(1)).otherwise(F.lit(0)).alias("is_trade"),
        F.date_format("l_shipdate", TS_FORMAT).alias("context_timestamp"),
        F.col("p_size").alias("item_price_level"),
        (F.col("p_partkey") % 17).cast("int").alias("item_sales_level"),
        (F.col("p_partkey") % 13).cast("int").alias("item_collected_level"),
        (F.col("p_partkey") % 19).cast("int").alias("item_pv_level"),
        F.col("p_brand").alias("item_brand_id"),
        F.col("s_nationkey").alias("item_city_id"),
        F.col("c_nationkey").alias("user_age_level"),
        (F.col("c_custkey") % 11).cast("int").alias("user_star_level"),
        (F.col("c_nationkey") % 3).alias("user_gender_id"),
        F.col("c_mktsegment").alias("user_occupation_id"),
        (F.col("s_suppkey") % 15).cast("int").alias("shop_review_num_level"),
        (F.lit(4999) + F.col("s_suppkey") % 20).cast("int").alias("shop_star_level"),
        (F.col("s_acctbal") / 10000).alias("shop_review_positive_rate"),
        (F.col("s_acctbal") / 11000).alias("shop_score_service"),
        (F.col("s_acctbal") / 12000).alias("shop_score_delivery"),
        (F.col("s_acctbal") / 13000).alias("shop_score_description"),
    )


def split_by_time(
    df: DataFrame, cut: str, ts: str = "context_timestamp"
) -> tuple[DataFrame, DataFrame]:
    """(history, target): rows before ``cut`` and rows on or after it.

    Compares times, not their text, so fields of one digit are in order too.  Rows with a
    null time fall in neither side.
    """
    at, since = parse_time(ts), F.lit(cut).cast("timestamp")
    return df.where(at < since), df.where(at >= since)


VIEWS = {"imp_events": (imp_events, EVENTS_CUT), "imp_lineitem": (imp_lineitem, LINEITEM_CUT)}


def history_and_target(spark: SparkSession, sf_dir: str, view: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of a fixture view, each read with its cut pushed to the scan."""
    loader, cut = VIEWS[view]
    return loader(spark, sf_dir, until=cut), loader(spark, sf_dir, since=cut)
