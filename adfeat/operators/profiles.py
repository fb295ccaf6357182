"""Tier-2 features (D1-D20): attribute means, ratios, flags, pivots, indicators.

These are present in the reference only as commented-out code; their
semantics are read from it and pinned down here (README lists the fill
choices).  Each is one aggregate of the history per key – conditional
aggregates instead of a pivot shuffle where the value list is known – and a
left join onto the target.  Global denominators (category range, grand
totals) are scalar subqueries over the already-aggregated table, planned with
the query: no job runs while it is built, no one-row table is joined to every row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeat.operators.counts import (
    LABEL,
    attach,
    conversions,
    impressions,
    key_aggregate,
    non_conversions,
)
from adfeat.sources.staging import stage

SHOP_ATTRS = [
    "shop_review_num_level",
    "shop_review_positive_rate",
    "shop_star_level",
    "shop_score_service",
    "shop_score_delivery",
    "shop_score_description",
]
ITEM_ATTRS = ["item_price_level", "item_sales_level", "item_collected_level", "item_pv_level"]
USER_ATTRS = ["user_age_level", "user_star_level"]

# The star-level offset and the five category ids of the
# reference's indicator block (its data's ids; callers pass their own).
STAR_LEVEL_OFFSET = 4998
REFERENCE_CATEGORY_IDS = [
    "509660095530134768",
    "5755694407684602296",
    "5799347067982556520",
    "7258015885215914736",
    "8277336076276184272",
]


def attribute_means(
    hist: DataFrame, base: DataFrame, keys: list[str], attrs: list[str], fill: object = 0, suffix: str = "_mean"
) -> DataFrame:
    """Mean of attribute columns per key, attached."""
    table = key_aggregate(hist, keys, {f"{a}{suffix}": F.avg(F.col(a)) for a in attrs})
    return attach(base, table, keys, fill)


def shop_profile(hist: DataFrame, base: DataFrame, star_offset: int = STAR_LEVEL_OFFSET) -> DataFrame:
    """D1 + D20: shop attribute means, star level shifted down by ``star_offset``."""
    shifted = hist.withColumn("shop_star_level", F.col("shop_star_level") - F.lit(star_offset))
    return attribute_means(shifted, base, ["shop_id"], SHOP_ATTRS)


def item_profile(hist: DataFrame, base: DataFrame) -> DataFrame:
    """D2."""
    return attribute_means(hist, base, ["item_id"], ITEM_ATTRS)


def user_profile(hist: DataFrame, base: DataFrame) -> DataFrame:
    """D3."""
    return attribute_means(hist, base, ["user_id"], USER_ATTRS)


def user_item_profile(hist: DataFrame, base: DataFrame) -> DataFrame:
    """Item attribute means per user × item."""
    return attribute_means(hist, base, ["user_id", "item_id"], ITEM_ATTRS)


def item_audience_age(hist: DataFrame, base: DataFrame) -> DataFrame:
    """Mean user age level per item, −1 when unseen."""
    table = key_aggregate(hist, ["item_id"], {"item_user_age_mean": F.avg("user_age_level")})
    return attach(base, table, ["item_id"], -1.0)


def trade_ratio(hist: DataFrame, base: DataFrame, key: str, prefix: str) -> DataFrame:
    """Impressions, conversions and their ratio per key; 0 when unseen."""
    n, c = impressions(), conversions()
    table = key_aggregate(
        hist,
        [key],
        {
            f"{prefix}_trade_sum": n,
            f"{prefix}_trade_count": c,
            f"{prefix}_trade_ratio": F.try_divide(c.cast("double"), n),
        },
    )
    return attach(base, table, [key], 0)


def untrade(hist: DataFrame, base: DataFrame, key: str, prefix: str) -> DataFrame:
    """Non-converting rows and their share of impressions; −1 when there are none."""
    u = F.nullif(non_conversions(), F.lit(0))
    table = key_aggregate(
        hist,
        [key],
        {
            f"{prefix}_untrade_count": u,
            f"{prefix}_untrade_ratio": F.try_divide(u.cast("double"), impressions()),
        },
    )
    return attach(base, table, [key], fills={f"{prefix}_untrade_count": -1, f"{prefix}_untrade_ratio": -1.0})


def threshold_flags(hist: DataFrame, base: DataFrame) -> DataFrame:
    """Shop impressions ≥ 2, item conversions ≥ 5, user impressions ≥ 5 (0 when unseen)."""

    keys = ["shop_id", "item_id", "user_id"]
    cells = hist.groupBy(*keys).agg(impressions().alias("_n"), conversions().alias("_c"))
    cells = stage(cells, "threshold-cells")  # the history is read once, the three keys roll up from it

    def flag(measure: str, k: int) -> Column:
        return F.when(F.sum(measure) >= F.lit(k), F.lit(1)).otherwise(F.lit(0))

    out = attach(base, key_aggregate(cells, ["shop_id"], {"shop_plus_2": flag("_n", 2)}), ["shop_id"], 0)
    out = attach(out, key_aggregate(cells, ["item_id"], {"ad_plus_5": flag("_c", 5)}), ["item_id"], 0)
    return attach(out, key_aggregate(cells, ["user_id"], {"user_plus_5": flag("_n", 5)}), ["user_id"], 0)


def attribute_ratio(hist: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """Impressions, conversions and ratio per brand or city (ratio null when unseen)."""
    stem = key[: -len("_id")] if key.endswith("_id") else key
    n, c = impressions(), conversions()
    table = key_aggregate(
        hist, [key], {f"{stem}_sum": n, f"{stem}_count": c, f"{stem}_ratio": F.try_divide(c.cast("double"), n)}
    )
    return attach(base, table, [key], fills={f"{stem}_sum": 0, f"{stem}_count": 0, f"{stem}_ratio": None})


def _slug(value: object) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in str(value)).lower()


def distinct_values(df: DataFrame, col: str, limit: int = 10_000) -> list:
    """Observed values of a low-cardinality column (one aggregate job), bounded like Spark's pivot."""
    rows = df.where(F.col(col).isNotNull()).select(col).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} distinct values; pass them explicitly")
    return sorted(r[0] for r in rows)


def occupation_ratio(
    hist: DataFrame, base: DataFrame, values: list | None = None, col: str = "user_occupation_id"
) -> DataFrame:
    """Per item and occupation, conversions / impressions (null without conversions)."""
    values = values if values is not None else distinct_values(hist, col)
    label = F.col(LABEL)
    aggs: dict[str, Column] = {}
    for v in values:
        hit = F.col(col) == F.lit(v)
        imps = F.count(F.when(hit, label))
        conv = F.count_if(hit & (label == 1))
        aggs[f"item_occ_{_slug(v)}_ratio"] = F.try_divide(F.nullif(conv, F.lit(0)).cast("double"), imps)
    return attach(base, key_aggregate(hist, ["item_id"], aggs), ["item_id"], None)


def value_map(hist: DataFrame, key: str, value: str, name: str, entry: Column, extra: dict[str, Column] | None = None) -> DataFrame:
    """``(key, name: map of value → entry)``: a pivot of any number of values in one column.

    ``entry`` is an expression over ``_imps`` (labelled rows), ``_conv`` (conversions) of a key
    and value; values whose entry is null are left out, and a key without entries has no row.
    Rows are reduced to one per key and value before a key's values are gathered, so a group
    holds as many entries as there are values, however many rows a key has.  ``extra`` adds
    map columns of other entries over the same values.
    """
    cells = key_aggregate(hist, [key, value], {"_imps": impressions(), "_conv": conversions()})
    columns = {name: entry, **(extra or {})}
    cells = cells.select(key, value, *[e.alias(n) for n, e in columns.items()]).where(F.coalesce(*columns).isNotNull())
    gathered = [
        F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col(n).isNotNull(), F.struct(F.col(value).cast("string"), F.col(n)))))).alias(n)
        for n in columns
    ]
    return cells.groupBy(key).agg(*gathered)


def occupation_ratio_map(hist: DataFrame, base: DataFrame, col: str = "user_occupation_id") -> DataFrame:
    """D13 for any number of occupations: ``item_occ_ratio``, a map of occupation → conversions / impressions.

    Occupations without a conversion are not in the map (null in the wide form); items without
    an entry get null.
    """
    ratio = F.try_divide(F.nullif(F.col("_conv"), F.lit(0)).cast("double"), F.col("_imps"))
    return attach(base, value_map(hist, "item_id", col, "item_occ_ratio", ratio), ["item_id"], None)


def gender_mix_map(hist: DataFrame, base: DataFrame, col: str = "user_gender_id") -> DataFrame:
    """D14 for any number of genders: maps of gender → labelled rows, and → share of all items' labelled rows."""
    n = F.nullif(F.col("_imps"), F.lit(0))
    total = key_aggregate(hist, ["item_id", col], {"t": impressions()}).agg(F.sum("t")).scalar()
    share = F.try_divide(n.cast("double"), total)
    table = value_map(hist, "item_id", col, "gender_counts", n, {"gender_ratios": share})
    return attach(base, table, ["item_id"], None)


def gender_mix(hist: DataFrame, base: DataFrame, genders: tuple[int, ...] = (0, 1, 2)) -> DataFrame:
    """Labelled rows per item and gender, and each over the grand total of all items.

    The grand total is a scalar subquery over the per-item table, not a second scan of the log.
    """
    label = F.col(LABEL)
    counts = {
        f"gender_{g}": F.nullif(F.count(F.when(F.col("user_gender_id") == F.lit(g), label)), F.lit(0))
        for g in genders
    }
    table = key_aggregate(hist, ["item_id"], counts)
    total = table.agg(sum(F.coalesce(F.sum(f"gender_{g}"), F.lit(0)) for g in genders).alias("t")).scalar()
    ratios = [F.try_divide(F.col(f"gender_{g}").cast("double"), total).alias(f"ad_gender{g}_ratio") for g in genders]
    table = table.select("item_id", *[f"gender_{g}" for g in genders], *ratios)
    return attach(base, table, ["item_id"], None)


def shop_user_trade(hist: DataFrame, base: DataFrame) -> DataFrame:
    """Converting and non-converting rows with a user, per shop, over shop impressions; −1 when none."""
    label = F.col(LABEL)
    conv = F.nullif(F.count(F.when(label == 1, F.col("user_id"))), F.lit(0))
    unconv = F.nullif(F.count(F.when(label == 0, F.col("user_id"))), F.lit(0))
    n = impressions()
    table = key_aggregate(
        hist,
        ["shop_id"],
        {
            "shop_user_trade_count": conv,
            "shop_user_trade_ratio": F.try_divide(conv.cast("double"), n),
            "shop_user_untrade_count": unconv,
            "shop_user_untrade_ratio": F.try_divide(unconv.cast("double"), n),
        },
    )
    fills = {
        "shop_user_trade_count": -1,
        "shop_user_trade_ratio": -1.0,
        "shop_user_untrade_count": -1,
        "shop_user_untrade_ratio": -1.0,
    }
    return attach(base, table, ["shop_id"], fills=fills)


def hour_ratio(hist: DataFrame, base: DataFrame, hour: str = "hour") -> DataFrame:
    """Conversions per hour, over the user × hour impressions already on ``base``.

    ``base`` must carry ``time_user_sum`` (the user × hour count feature).
    """
    table = key_aggregate(hist, [hour], {"hour_trade_count": conversions()})
    out = attach(base, table, [hour], 0)
    return out.withColumn(
        "time_user_ratio", F.try_divide(F.col("hour_trade_count").cast("double"), F.col("time_user_sum"))
    )


def category_indicators(
    df: DataFrame, category: str | Column, ids: list[str] = REFERENCE_CATEGORY_IDS
) -> DataFrame:
    """One 0/1 column per id, and ``item_cat_dummies`` = 1 when the category is none of them."""
    cat = F.col(category) if isinstance(category, str) else category
    flags = [F.when(cat == F.lit(i), F.lit(1)).otherwise(F.lit(0)).alias(f"cat_{_slug(i)}") for i in ids]
    other = F.when(cat.isin(ids), F.lit(0)).otherwise(F.lit(1)).alias("item_cat_dummies")
    return df.select("*", other, *flags)
