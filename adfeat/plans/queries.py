"""Named queries over the driver's tables: ``name → (spark, sf_dir) -> DataFrame``.

Every query reads whole tables (through the fixture views) so its work grows
with the data.  ``oracle.py`` holds the matching DuckDB SQL under the same
names and with the same output column names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adfeat.functions import category_key, digamma_diff, parse_time
from adfeat.operators import profiles as P
from adfeat.operators.counts import key_counts
from adfeat.operators.keysets import MEASURES
from adfeat.operators.rank_scan import add_scanned_ranks
from adfeat.plans import frame as FR
from adfeat.plans.daily import add_days, cells_of
from adfeat.plans import history as H
from adfeat.plans import smoothing as SM
from adfeat.session import ensure_checkpoint_dir, tune_session
from adfeat.sources.ingest import ingest_csv, read_log
from adfeat.sources.schema import read_impressions
from adfeat.sources.staging import stage
from adfeat.sources.views import EVENTS_CUT, history_and_target, imp_events, imp_lineitem, split_by_time
from adfeat.streaming import (
    compact_changelog,
    impression_stream,
    latest_cells,
    latest_counts,
    remove_folded,
    streaming_cells,
    streaming_key_counts,
    write_changelog,
)

Query = Callable[[SparkSession, str], DataFrame]

#: The last day of the history.
LAST_DAY = "2024-01-20"

EVENT_BASE = ["instance_id", "user_id", "item_id", "shop_id", "is_trade", "context_timestamp"]

# query name → group of the primary section (hour-keyed groups also output ``hour``)
HISTORY_GROUP_QUERIES = {
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


def _group_query(group: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        hist, tgt = history_and_target(spark, sf_dir, "imp_events")
        out = H.section_group(hist, tgt, group)
        spec = H.USER_SHOP_HOUR_COUNTS if group == "user_shop_hour_counts" else H.SECTION[group]
        base = EVENT_BASE + ([H.HOUR] if H.HOUR in spec.keys else [])
        return H.keep(out, base + spec.outputs())

    run.__name__ = f"history_{group}"
    return run


def history_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist, tgt = history_and_target(spark, sf_dir, "imp_events")
    return H.history_features(hist, tgt)


def modular_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist, tgt = history_and_target(spark, sf_dir, "imp_events")
    return H.modular_features(hist, tgt)


# ---------------------------------------------------------------- within-frame

PRED = "predict_category_rank"

FRAME_STEP_QUERIES = {
    "frame_counts": (
        "counts",
        ["instance_id", "user_id", "item_id", "shop_id", "context_timestamp"]
        + [name for _, name in FR.FRAME_COUNTS],
    ),
    "predicted_category_rank": (
        "parsed",
        ["instance_id", "item_category_list", "predict_category_property", PRED],
    ),
    "category_popularity": ("category_popularity", ["instance_id", "item_category_list", "item_category_sum"]),
    "property_counts": (
        "property_counts",
        ["instance_id", "item_property_list", "property_len"] + [name for _, name in FR.PROPERTY_COUNTS],
    ),
    "property_cross_counts": (
        "property_crosses",
        ["instance_id", "user_id", "item_id", "shop_id", "item_property_list"]
        + [name for _, name in FR.PROPERTY_CROSSES],
    ),
    "property_time_rank": (
        "property_ranks",
        ["instance_id", "item_property_list", "context_timestamp"]
        + [
            f"item_pro{i}_{c}"
            for i, order in FR.PROPERTY_RANK_ORDER.items()
            for d in order
            for c in (f"{d}_rank", f"if_{d}")
        ],
    ),
    "predict_rank_counts": (
        "predict_rank_counts",
        ["instance_id", "user_id", "item_id", "shop_id", PRED]
        + [name for _, cols in FR.PREDICT_RANK_COUNTS for name in cols],
    ),
}


def _frame_query(step: str, cols: list[str]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return H.keep(FR.frame_subset(imp_events(spark, sf_dir), step), cols)

    run.__name__ = f"frame_{step}"
    return run


ENTITY_RANK_QUERIES = {
    "shop_time_rank": (["shop_id"], "shop"),
    "user_time_rank": (["user_id"], "user"),
    "item_time_rank": (["item_id"], "item"),
    "user_item_time_rank": (["user_id", "item_id"], "user_item"),
    "user_shop_time_rank": (["user_id", "shop_id"], "user_shop"),
}


def _entity_rank_query(keys: list[str], prefix: str) -> Query:
    """Ranks on ``imp_lineitem``, where every time is midnight and ties abound.

    The five-table join is run once, to a staged narrow log, which is sorted and scanned.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        log = imp_lineitem(spark, sf_dir).select("instance_id", "user_id", "item_id", "shop_id", "context_timestamp")
        base = stage(log.withColumn(FR.TS, parse_time("context_timestamp")), f"{prefix}-log")
        out = add_scanned_ranks(base, keys, FR.TS, prefix, order=("last", "first"))
        cols = [f"{prefix}_{d}" for d in ("last_rank", "if_last", "first_rank", "if_first")]
        return H.keep(out, ["instance_id", "user_id", "item_id", "shop_id", "context_timestamp"] + cols)

    run.__name__ = f"rank_{prefix}"
    return run


def filled_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 with ``fill_inputs``: rows without a user are the group of user 0 from the ranks on."""
    out = FR.frame_features(imp_events(spark, sf_dir), fill_inputs=True)
    cols = ["user_sum_label", "user_last_rank", "user_if_last", "user_first_rank", "user_if_first", "user_pro1_sum", "user_predict_sum"]
    return H.keep(out, ["instance_id", "user_id", "is_trade", *cols])


def csv_user_item_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log written as CSV to the checkpoint folder, read back with the declared schema."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/adfeat-stage/csv-{uuid.uuid4().hex}"
    imp_events(spark, sf_dir).write.option("header", "true").csv(root)
    hist, tgt = split_by_time(read_impressions(spark, root, fmt="csv"), EVENTS_CUT)
    spec = H.SECTION["user_item"]
    return H.keep(H.section_group(hist, tgt, "user_item"), EVENT_BASE + spec.outputs())


ONE_DIGIT = "yyyy-M-d H:m:s"


def one_digit_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 on times with fields of one digit: split, hour and user × hour counts of such a log."""
    log = imp_events(spark, sf_dir)
    log = log.withColumn("context_timestamp", F.date_format(parse_time("context_timestamp"), ONE_DIGIT))
    hist, tgt = split_by_time(log, EVENTS_CUT)
    spec = H.SECTION["user_hour"]
    return H.keep(H.section_group(hist, tgt, "user_hour"), EVENT_BASE + [H.HOUR] + spec.outputs())


def _csv_with_damage(spark: SparkSession, sf_dir: str) -> tuple[str, str, str, list[str]]:
    """The event log as headerless CSV, every 13th event's line cut short or with a word for an id or the time."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/adfeat-stage/csv-{uuid.uuid4().hex}"
    log = imp_events(spark, sf_dir)
    i, whole = F.col("instance_id"), F.to_csv(F.struct(*log.columns))
    short = F.concat_ws(",", i.cast("string"), "user_id", "item_id")
    word = F.concat(F.lit("x"), whole)
    late = F.to_csv(F.struct(*[F.lit("yesterday").alias(c) if c == "context_timestamp" else F.col(c) for c in log.columns]))
    line = F.when(i % 13 != 0, whole).when(i % 39 == 0, short).when(i % 39 == 13, word).otherwise(late)
    log.select(line.alias("value")).write.text(f"{root}/raw")
    return f"{root}/raw", f"{root}/log", f"{root}/quarantine", log.columns


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that a damaged CSV log leaves in quarantine, by reason."""
    raw, log, bad, columns = _csv_with_damage(spark, sf_dir)
    ingest_csv(spark, raw, log, bad, columns)
    return spark.read.parquet(bad).groupBy("reason").agg(F.count("*").alias("n_lines"))


def csv_log_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User × item counts from the day-partitioned log that the sound lines of a damaged CSV make."""
    raw, path, bad, columns = _csv_with_damage(spark, sf_dir)
    ingest_csv(spark, raw, path, bad, columns)
    hist, tgt = read_log(spark, path, until=EVENTS_CUT), read_log(spark, path, since=EVENTS_CUT)
    return H.keep(H.section_group(hist, tgt, "user_item"), EVENT_BASE + H.SECTION["user_item"].outputs())


def daily_history_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1-H23 from cells by day: all days but the last in one go, then the last on its own."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/adfeat-stage/cells-{uuid.uuid4().hex}"
    add_days(imp_events(spark, sf_dir, until=LAST_DAY), root)
    add_days(imp_events(spark, sf_dir, since=LAST_DAY, until=EVENTS_CUT), root)
    return H.history_features(cells_of(spark, root, until=EVENTS_CUT), imp_events(spark, sf_dir, since=EVENTS_CUT))


def streaming_history_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1-H23 from the cells that a stream of the history keeps, after folding its changelog."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/adfeat-stream-{uuid.uuid4().hex}"
    stream = split_by_time(impression_stream(spark, sf_dir), EVENTS_CUT)[0]
    q = write_changelog(streaming_cells(stream), f"{root}/log", f"{root}/state")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    compact_changelog(spark, f"{root}/log", H.CELL_KEYS, list(MEASURES))
    remove_folded(spark, f"{root}/log")
    return H.history_features(latest_cells(spark, f"{root}/log"), imp_events(spark, sf_dir, since=EVENTS_CUT))


def shop_digamma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ψ(n + 1) − ψ(1) of every shop's impressions n, as a native expression."""
    hist, _ = history_and_target(spark, sf_dir, "imp_lineitem")
    counts = key_counts(hist, ["shop_id"], n="n")
    return counts.select("shop_id", "n", F.round(digamma_diff(F.col("n"), F.lit(1.0)), 9).alias("digamma_diff"))


def frame_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FR.frame_features(imp_events(spark, sf_dir))


# ---------------------------------------------------------------- smoothing


def beta_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 on the shop table of the ``imp_lineitem`` history: prior (1, 1), 1000 steps, ε 0.001."""
    hist, _ = history_and_target(spark, sf_dir, "imp_lineitem")
    prior = SM.prior_of_shops(hist)
    row = spark.createDataFrame([(prior.alpha, prior.beta)], "alpha double, beta double")
    return row.select(F.round("alpha", 6).alias("alpha"), F.round("beta", 6).alias("beta"))


def _smoothed_query(kind: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        hist, tgt = history_and_target(spark, sf_dir, "imp_lineitem")
        fn = {"shop": SM.shop_smoothing, "item": SM.item_smoothing, "user": SM.user_smoothing}[kind]
        out, _ = fn(hist, tgt)
        key = f"{kind}_id"
        return out.select(
            "instance_id",
            key,
            f"{kind}_trade_sum",
            f"{kind}_trade_count",
            F.round(f"{kind}_trade_smooth", 6).alias(f"{kind}_trade_smooth"),
        )

    run.__name__ = f"{kind}_smoothed_rate"
    return run


# ---------------------------------------------------------------- tier 2 (disabled in the reference)

# The category ids whose indicators the query builds.
INDICATOR_IDS = ["c10", "c11", "c12", "c13", "c14"]


def _lineitem_query(fn: Callable[[DataFrame, DataFrame], DataFrame], cols: list[str], rnd: tuple = ()) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        hist, tgt = history_and_target(spark, sf_dir, "imp_lineitem")
        out = fn(hist, tgt)
        return out.select(*[F.round(c, 6).alias(c) if c in rnd else F.col(c) for c in cols])

    run.__name__ = getattr(fn, "__name__", "tier2")
    return run


def _tier2() -> dict[str, Query]:
    q: dict[str, Query] = {}
    shop_means = [f"{a}_mean" for a in P.SHOP_ATTRS]
    item_means = [f"{a}_mean" for a in P.ITEM_ATTRS]
    q["shop_profile"] = _lineitem_query(P.shop_profile, ["instance_id", "shop_id", *shop_means], tuple(shop_means))
    q["item_profile"] = _lineitem_query(P.item_profile, ["instance_id", "item_id", *item_means])
    q["user_profile"] = _lineitem_query(
        P.user_profile, ["instance_id", "user_id", *[f"{a}_mean" for a in P.USER_ATTRS]]
    )
    q["user_item_profile"] = _lineitem_query(P.user_item_profile, ["instance_id", "user_id", "item_id", *item_means])
    q["item_audience_age"] = _lineitem_query(P.item_audience_age, ["instance_id", "item_id", "item_user_age_mean"])
    for key, prefix in (("shop_id", "shop"), ("item_id", "item"), ("user_id", "user")):
        q[f"{prefix}_ratio"] = _lineitem_query(
            lambda h, t, k=key, p=prefix: P.trade_ratio(h, t, k, p),
            ["instance_id", key, f"{prefix}_trade_sum", f"{prefix}_trade_count", f"{prefix}_trade_ratio"],
        )
        q[f"{prefix}_untrade"] = _lineitem_query(
            lambda h, t, k=key, p=prefix: P.untrade(h, t, k, p),
            ["instance_id", key, f"{prefix}_untrade_count", f"{prefix}_untrade_ratio"],
        )
    q["threshold_flags"] = _lineitem_query(
        P.threshold_flags,
        ["instance_id", "shop_id", "item_id", "user_id", "shop_plus_2", "ad_plus_5", "user_plus_5"],
    )
    for key in ("item_brand_id", "item_city_id"):
        stem = key[: -len("_id")]
        q[f"{key.split('_')[1]}_ratio"] = _lineitem_query(
            lambda h, t, k=key: P.attribute_ratio(h, t, k),
            ["instance_id", key, f"{stem}_sum", f"{stem}_count", f"{stem}_ratio"],
        )
    q["item_occupation_ratio"] = item_occupation_ratio
    q["item_occupation_map"] = item_occupation_map
    q["item_gender_map"] = item_gender_map
    q["item_gender_mix"] = _lineitem_query(
        P.gender_mix,
        ["instance_id", "item_id", *[f"gender_{g}" for g in range(3)], *[f"ad_gender{g}_ratio" for g in range(3)]],
    )
    q["shop_user_trade"] = _lineitem_query(
        P.shop_user_trade,
        ["instance_id", "shop_id", "shop_user_trade_count", "shop_user_trade_ratio",
         "shop_user_untrade_count", "shop_user_untrade_ratio"],
    )
    q["hour_ratio"] = hour_ratio
    q["category_indicators"] = category_indicators
    return q


def item_occupation_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D13 on ``imp_lineitem``: one column per occupation of the customers."""
    hist, tgt = history_and_target(spark, sf_dir, "imp_lineitem")
    values = P.distinct_values(spark.read.parquet(f"{sf_dir}/customer.parquet"), "c_mktsegment")
    out = P.occupation_ratio(hist, tgt, values)
    return H.keep(out, ["instance_id", "item_id", *[c for c in out.columns if c.startswith("item_occ_")]])


def _entries(c: str) -> Column:
    """A map of doubles as text, by key, in millionths."""
    pairs = F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat_ws("=", e["key"], F.round(e["value"] * 1e6).cast("long")))
    return F.array_join(pairs, ";")


def item_occupation_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D13 as a map, whatever the number of occupations."""
    hist, tgt = history_and_target(spark, sf_dir, "imp_lineitem")
    out = P.occupation_ratio_map(hist, tgt)
    return out.select("instance_id", "item_id", _entries("item_occ_ratio").alias("item_occ_ratio"))


def item_gender_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D14 as maps, whatever the number of genders (here nations, of which there are 25)."""
    hist, tgt = history_and_target(spark, sf_dir, "imp_lineitem")
    out = P.gender_mix_map(hist, tgt, "user_age_level")
    return out.select("instance_id", "item_id", _entries("gender_counts").alias("gender_counts"), _entries("gender_ratios").alias("gender_ratios"))


def hour_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D18 on ``imp_events``: conversions per hour over the user × hour impressions."""
    hist, tgt = history_and_target(spark, sf_dir, "imp_events")
    h = H.prepare_history(hist)
    t = H.add_group(H.prepare_target(tgt, need_key=False), h, H.Group(("user_id", H.HOUR), n="time_user_sum"))
    out = P.hour_ratio(h, t)
    return out.select("instance_id", "user_id", H.HOUR, "time_user_sum", "hour_trade_count", "time_user_ratio")


def category_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D19 on the whole ``imp_events`` frame."""
    ev = imp_events(spark, sf_dir).select("instance_id", "item_category_list")
    out = P.category_indicators(ev, category_key("item_category_list"), INDICATOR_IDS)
    return out


# ---------------------------------------------------------------- streaming


def streaming_user_shop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User × shop counts maintained by a Structured Streaming aggregate over ``events``."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/adfeat-stream-{uuid.uuid4().hex}"
    keys, measures = ["user_id", "shop_id"], ["user_shop_sum", "user_shop_trade"]
    counts = streaming_key_counts(impression_stream(spark, sf_dir), keys, *measures)
    q = write_changelog(counts, f"{root}/log", f"{root}/state")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return latest_counts(spark, f"{root}/log", keys, measures)


def _tuned(fn: Query) -> Query:
    """Apply the session settings the plans assume (UTC, AQE, skew join, ANSI) first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune_session(spark)
        return fn(spark, sf_dir)

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def registry() -> dict[str, Query]:
    return {name: _tuned(fn) for name, fn in _registry().items()}


def _registry() -> dict[str, Query]:
    q: dict[str, Query] = {name: _group_query(g) for name, g in HISTORY_GROUP_QUERIES.items()}
    q["history_features"] = history_features
    q["modular_features"] = modular_features
    for name, (step, cols) in FRAME_STEP_QUERIES.items():
        q[name] = _frame_query(step, cols)
    for name, (keys, prefix) in ENTITY_RANK_QUERIES.items():
        q[name] = _entity_rank_query(keys, prefix)
    q["frame_features"] = frame_features
    q["filled_frame"] = filled_frame
    q["csv_user_item_counts"] = csv_user_item_counts
    q["csv_quarantine"] = csv_quarantine
    q["csv_log_features"] = csv_log_features
    q["one_digit_times"] = one_digit_times
    q["daily_history_features"] = daily_history_features
    q["shop_digamma"] = shop_digamma
    q["beta_prior"] = beta_prior
    for kind in ("shop", "item", "user"):
        q[f"{kind}_smoothed_rate"] = _smoothed_query(kind)
    q.update(_tier2())
    q["streaming_user_shop_counts"] = streaming_user_shop_counts
    q["streaming_history_features"] = streaming_history_features
    return q
