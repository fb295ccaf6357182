"""History → target count features (H1-H23) and the modular per-topic variants.

``history_features(hist, target)`` adds the 22 columns of the primary feature
section; each ``*_feat`` / ``*_context`` function adds one topic's columns
(the modular classes).  All are lazy DataFrame plans: the history is read
with only the columns a group needs (Catalyst prunes the scan per aggregate),
the category key and the hour are derived once per side, and impressions and
conversions of a key come from one aggregate.

Quirks kept under the reference's column names (see README):

* ``user_shop_hour_sum`` in the primary section is the *mean* label of
  user × shop × hour (no aggregate function was given); the modular
  ``user_shop_context`` counts it.
* The target's ``item_category_list`` is dropped by the primary section and by
  ``user_ad`` (the category key replaces it).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfeat.functions import category_key, hour_of
from adfeat.operators.counts import LABEL, add_counts, attach, fill_frame, key_aggregate
from adfeat.operators.keysets import CONVERSIONS, MEASURES, N, SUM, answered, melted, of_set, rolled_up, slots_of
from adfeat.sources.staging import stage

CAT_KEY = "_cat_key"
HOUR = "hour"


@dataclass(frozen=True)
class Group:
    keys: tuple[str, ...]
    n: str | None = None
    conv: str | None = None
    mean: str | None = None

    def outputs(self) -> list[str]:
        return [c for c in (self.n, self.mean, self.conv) if c]


def _g(keys, n=None, conv=None, mean=None) -> Group:
    return Group(tuple(keys), n=n, conv=conv, mean=mean)


# The primary section, in its column order.
SECTION: dict[str, Group] = {
    "shop": _g(["shop_id"], "shop_trade_sum", "shop_trade_count"),
    "item": _g(["item_id"], "item_trade_sum", "item_trade_count"),
    "user": _g(["user_id"], "user_trade_sum", "user_trade_count"),
    "user_item": _g(["user_id", "item_id"], "ad_user_count", "ad_user_trade"),
    "user_category": _g(["user_id", CAT_KEY], "user_cat_sum", "user_cat_count"),
    "user_shop": _g(["user_id", "shop_id"], "user_shop_sum", "user_shop_trade"),
    "user_hour": _g(["user_id", HOUR], "time_user_sum", "time_user_count"),
    "item_hour": _g(["item_id", HOUR], "hour_item_sum", "hour_item_count"),
    "shop_hour": _g(["shop_id", HOUR], "hour_shop_sum", "hour_shop_count"),
    "user_shop_hour_rate": _g(["user_id", "shop_id", HOUR], conv="user_shop_hour_count", mean="user_shop_hour_sum"),
    "user_item_hour": _g(["user_id", "item_id", HOUR], "user_item_hour_sum", "user_item_hour_count"),
}

# Count form of user × shop × hour (the modular method).
USER_SHOP_HOUR_COUNTS = _g(["user_id", "shop_id", HOUR], "user_shop_hour_sum", "user_shop_hour_count")


def prepare_history(hist: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Derive the category key and the hour once; Catalyst prunes unused ones."""
    return hist.select(
        *(carry or []),
        "user_id",
        "item_id",
        "shop_id",
        "is_trade",
        category_key("item_category_list").alias(CAT_KEY),
        hour_of("context_timestamp").alias(HOUR),
    )


def prepare_target(target: DataFrame, need_key: bool = True) -> DataFrame:
    """Add ``hour`` when the caller did not supply it, and the category key."""
    if HOUR not in target.columns:
        target = target.withColumn(HOUR, hour_of("context_timestamp"))
    if need_key:
        target = target.withColumn(CAT_KEY, category_key("item_category_list"))
    return target


CELL_KEYS = ["user_id", "item_id", "shop_id", CAT_KEY, HOUR]


def measured(hist: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Prepared history rows with their measures: labelled or not, conversion or not, label."""
    label = F.col(LABEL)
    return prepare_history(hist, carry).select(
        *(carry or []),
        *CELL_KEYS,
        F.when(label.isNotNull(), 1).otherwise(0).cast("long").alias(N),
        F.when(label == 1, 1).otherwise(0).cast("long").alias(CONVERSIONS),
        label.cast("long").alias(SUM),
    )


class Cells:
    """The history aggregated once to its finest key (user, item, shop, category, hour).

    Every key group of the section is a roll-up of these cells: impressions and
    conversions add up, and the mean label is Σ label / Σ impressions.  Null keys stay in
    the cells as their own value and are dropped per roll-up.  Cells are sums, so cells of
    several parts of a log together are cells of the whole (``plans/daily.py`` keeps them by day).
    """

    def __init__(self, hist: DataFrame | None = None, cells: DataFrame | None = None) -> None:
        """Cells of a log, staged; or ``cells`` (keys and measures) that are there already."""
        if cells is None:
            cells = stage(measured(hist).groupBy(*CELL_KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES]), "history-cells")
        self.df = cells

    def table(self, group: Group) -> DataFrame:
        aggs = {}
        if group.n:
            aggs[group.n] = F.sum(N)
        if group.mean:
            aggs[group.mean] = F.try_divide(F.sum(SUM), F.sum(N))
        if group.conv:
            aggs[group.conv] = F.sum(CONVERSIONS)
        return key_aggregate(self.df, list(group.keys), aggs)


def add_group(target: DataFrame, hist: DataFrame | Cells, group: Group) -> DataFrame:
    if isinstance(hist, Cells):
        return attach(target, hist.table(group), list(group.keys), 0)
    return add_counts(target, hist, list(group.keys), n=group.n, conv=group.conv, mean=group.mean)


ROW = "_row"


def attach_groups(target: DataFrame, source: DataFrame, groups: list[Group]) -> DataFrame:
    """Attach groups of ``source`` (keys and measures) to the target: see ``operators/keysets.py``.

    The target is staged with a row id.  Its melted keys take part in the aggregate of the
    melted source, are answered by one join, return to one row per id by a conditional
    aggregate, and meet the wide rows on the id: five exchanges, however many groups.
    """
    rows = stage(target.withColumn(ROW, F.monotonically_increasing_id()), "target")
    sets = [{k: k for k in g.keys} for g in groups]
    slots = slots_of(source, sets)
    asked = melted(rows, sets, slots, [ROW])
    table = stage(rolled_up(melted(source, sets, slots, list(MEASURES)), asked, slots), "history-sums")
    values = {N: N, CONVERSIONS: CONVERSIONS, SUM: F.try_divide(F.col(SUM), F.col(N))}
    outputs = [(i, name, values[m]) for i, g in enumerate(groups) for name, m in ((g.n, N), (g.mean, SUM), (g.conv, CONVERSIONS)) if name]
    n_rows = rows.count()
    wide = answered(asked, table, slots, n_rows, ROW, n_rows * len(groups)).groupBy(ROW).agg(*[of_set(i, v).alias(name) for i, name, v in outputs])
    filled = [F.coalesce(F.col(name), F.lit(0)).alias(name) for _, name, _ in outputs]
    return rows.join(wide, ROW, "left").select(*target.columns, *filled)


def _section(source: DataFrame, target: DataFrame, groups: list[Group], fill_inputs: bool) -> DataFrame:
    t = prepare_target(target).drop("item_category_list")
    if fill_inputs:
        t = fill_frame(attach_groups(t, source, groups[:1]))
        groups = groups[1:]
    return attach_groups(t, source, groups).drop(CAT_KEY)


def _source(hist: DataFrame | Cells) -> DataFrame:
    return hist.df if isinstance(hist, Cells) else measured(hist)


def history_features(hist: DataFrame | Cells, target: DataFrame, fill_inputs: bool = False) -> DataFrame:
    """The 22 history count features attached to every target row.

    ``hist`` is the log, or cells of it that are there already.

    ``fill_inputs`` fills the whole target with 0 after the first group, as the reference
    does, so that a null key is the key 0 for the later groups.
    """
    return _section(_source(hist), target, list(SECTION.values()), fill_inputs)


def section_group(hist: DataFrame, target: DataFrame, name: str) -> DataFrame:
    """One topic of the primary section on its own (target + its columns)."""
    group = USER_SHOP_HOUR_COUNTS if name == "user_shop_hour_counts" else SECTION[name]
    t = prepare_target(target, need_key=CAT_KEY in group.keys)
    out = add_group(t, prepare_history(hist), group)
    return out.drop(CAT_KEY) if CAT_KEY in group.keys else out


# ---------------------------------------------------------------- modular form


def _h(hist: DataFrame | Cells) -> DataFrame | Cells:
    if isinstance(hist, Cells) or CAT_KEY in hist.columns:
        return hist
    return prepare_history(hist)


def shop_feat(hist: DataFrame | Cells, base: DataFrame) -> DataFrame:
    return add_group(base, _h(hist), SECTION["shop"])


def ad_feat(hist: DataFrame | Cells, base: DataFrame) -> DataFrame:
    return add_group(base, _h(hist), _g(["item_id"], "item_trade_sum"))


def user_feat(hist: DataFrame | Cells, base: DataFrame) -> DataFrame:
    return add_group(base, _h(hist), SECTION["user"])


def user_ad(hist: DataFrame | Cells, base: DataFrame) -> DataFrame:
    h = _h(hist)
    t = add_group(base, h, SECTION["user_item"])
    t = t.withColumn(CAT_KEY, category_key("item_category_list")).drop("item_category_list")
    return add_group(t, h, SECTION["user_category"]).drop(CAT_KEY)


def user_shop(hist: DataFrame | Cells, base: DataFrame) -> DataFrame:
    return add_group(base, _h(hist), SECTION["user_shop"])


def user_context(hist: DataFrame | Cells, base: DataFrame) -> DataFrame:
    t = prepare_target(base, need_key=False)
    return add_group(t, _h(hist), _g(["user_id", HOUR], "time_user_sum"))


def ad_context(hist: DataFrame | Cells, base: DataFrame) -> DataFrame:
    return add_group(prepare_target(base, need_key=False), _h(hist), SECTION["item_hour"])


def shop_context(hist: DataFrame | Cells, base: DataFrame) -> DataFrame:
    return add_group(prepare_target(base, need_key=False), _h(hist), SECTION["shop_hour"])


def user_shop_context(hist: DataFrame | Cells, base: DataFrame) -> DataFrame:
    return add_group(prepare_target(base, need_key=False), _h(hist), USER_SHOP_HOUR_COUNTS)


def user_ad_context(hist: DataFrame | Cells, base: DataFrame) -> DataFrame:
    return add_group(prepare_target(base, need_key=False), _h(hist), SECTION["user_item_hour"])


# The ten modular methods in order, as groups.
MODULAR = [
    SECTION["shop"],
    _g(["item_id"], "item_trade_sum"),
    SECTION["user"],
    SECTION["user_item"],
    SECTION["user_category"],
    SECTION["user_shop"],
    _g(["user_id", HOUR], "time_user_sum"),
    SECTION["item_hour"],
    SECTION["shop_hour"],
    USER_SHOP_HOUR_COUNTS,
    SECTION["user_item_hour"],
]


def modular_features(hist: DataFrame | Cells, target: DataFrame, fill_inputs: bool = False) -> DataFrame:
    """All ten modular methods in order (20 columns), sharing one history source.

    The columns are the target's without ``item_category_list``, ``hour``, then the features.
    """
    return _section(_source(hist), target, MODULAR, fill_inputs)


def keep(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c) for c in cols])
