"""Within-frame features (B1-B41): counts, time ranks, list parsing, one frame.

``frame_features(label)`` is the whole section; ``frame_subset`` runs one step.
The frame is both the source of every aggregate and the target the results
are attached to.  It is parsed and staged once with a row id.  All counts come
from one melted aggregate and probe (``operators/keysets.py``), all ranks from
one melted sort and scan (``operators/rank_scan.py``); both return to one row
per id in one conditional aggregate, and the wide rows are shuffled once.

Quirks kept under the reference's names: ``item_pro1_sum_x`` (global count of
property 1) and ``item_pro1_sum_y`` (item × property 1) come from a pandas
name collision; ``shop_preidct_sum`` is spelled as in the reference; and
``user_item_pre_sum`` is the *mean instance id* of user × item × predicted
rank (no aggregate was given) — ``user_item_pre_count`` beside it counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeat.functions import (
    category_key,
    index_or_minus1,
    list_length,
    min_max_scaled,
    parse_time,
    predicted_categories,
    property_at,
)
from adfeat.operators.keysets import CONVERSIONS, MEASURES, N, SET, SUM, KeySet, answered, melted, of_set, one_row_each, parts_of, rolled_up_own, slots_of, union_melted
from adfeat.operators.rank_scan import FIRST, LAST, PART_ROWS, scan_ranks
from adfeat.operators.ranks import flag_one
from adfeat.sources.staging import stage

TS = "_ts"
N_PROPS = 7

# (keys, count column) for B1-B5
FRAME_COUNTS = [
    (["user_id"], "user_sum_label"),
    (["item_id"], "item_sum_label"),
    (["shop_id"], "shop_sum_label"),
    (["user_id", "item_id"], "user_item_sum_label"),
    (["user_id", "shop_id"], "user_shop_sum_label"),
]

# (keys, prefix, column order) for B6-B15
ENTITY_RANKS = [
    (["shop_id"], "shop", ("last", "first")),
    (["user_id"], "user", ("last", "first")),
    (["item_id"], "item", ("last", "first")),
    (["user_id", "item_id"], "user_item", ("last", "first")),
    (["user_id", "shop_id"], "user_shop", ("last", "first")),
]

# Rows per property 1-4
PROPERTY_COUNTS = [
    (["item_pro1"], "item_pro1_sum_x"),
    (["item_pro2"], "item_pro2_sum"),
    (["item_pro3"], "item_pro3_sum"),
    (["item_pro4"], "item_pro4_sum"),
]

# Rows per entity × property 1
PROPERTY_CROSSES = [
    (["user_id", "item_pro1"], "user_pro1_sum"),
    (["item_id", "item_pro1"], "item_pro1_sum_y"),
    (["shop_id", "item_pro1"], "shop_pro1_sum"),
    (["user_id", "shop_id", "item_pro1"], "user_shop_pro1_sum"),
    (["user_id", "item_id", "item_pro1"], "user_item_pro1_sum"),
]

# The reference writes properties 1 and 4 last-first, the others first-last
PROPERTY_RANK_ORDER = {
    1: ("last", "first"),
    2: ("first", "last"),
    3: ("first", "last"),
    4: ("last", "first"),
    5: ("first", "last"),
    6: ("first", "last"),
    7: ("first", "last"),
}

PREDICT_RANK = "predict_category_rank"

# B36-B40 (B39 is a mean, with a count beside it)
PREDICT_RANK_COUNTS = [
    (["user_id", PREDICT_RANK], {"user_predict_sum": "count"}),
    (["shop_id", PREDICT_RANK], {"shop_preidct_sum": "count"}),
    (["item_id", PREDICT_RANK], {"item_predict_sum": "count"}),
    (["user_id", "item_id", PREDICT_RANK], {"user_item_pre_sum": "mean", "user_item_pre_count": "count"}),
    (["user_id", "shop_id", PREDICT_RANK], {"user_shop_pre_sum": "count"}),
]

DROPPED = [
    "item_category",
    "predict_category_property",
    "item_property_list",
    *[f"item_pro{i}" for i in range(1, N_PROPS + 1)],
]


def prepare_frame(label: DataFrame) -> DataFrame:
    """Parse time, category, predicted list and properties once, as native expressions."""
    cat = category_key("item_category_list")
    pred = predicted_categories("predict_category_property")
    return label.select(
        "*",
        parse_time("context_timestamp").alias(TS),
        cat.alias("item_category"),
        pred.alias("predict_category"),
        index_or_minus1(cat, pred).alias(PREDICT_RANK),
        list_length("item_property_list").alias("property_len"),
        *[property_at("item_property_list", i - 1).alias(f"item_pro{i}") for i in range(1, N_PROPS + 1)],
    )



def _output_order(label: DataFrame, columns: list[str]) -> list[str]:
    ranks = [
        c
        for keys, prefix, order in ENTITY_RANKS
        for d in order
        for c in (f"{prefix}_{d}_rank", f"{prefix}_if_{d}")
    ]
    prop_ranks = [
        f"item_pro{i}_{c}" for i, order in PROPERTY_RANK_ORDER.items() for d in order for c in (f"{d}_rank", f"if_{d}")
    ]
    order = (
        [c for c in label.columns if c not in DROPPED]
        + [PREDICT_RANK, "property_len"]
        + [name for _, name in FRAME_COUNTS]
        + ranks
        + ["item_category_sum"]
        + [name for _, name in PROPERTY_COUNTS + PROPERTY_CROSSES]
        + prop_ranks
        + [name for _, cols in PREDICT_RANK_COUNTS for name in cols]
    )
    missing = set(order) - set(columns)
    if missing:
        raise AssertionError(f"frame features missing {sorted(missing)}")
    return order


ROW = "_row"


def stage_frame(label: DataFrame) -> DataFrame:
    """The parsed frame with a row id, written once; every feature group reads it pruned.

    The ids are written with the rows, so they are stable however often a branch is computed.
    """
    base = prepare_frame(label).drop("predict_category").withColumn(ROW, F.monotonically_increasing_id())
    return stage(base, "frame")


@dataclass(frozen=True)
class Counted:
    """One key set of the frame and the features it gives (name → count, mean or scaled)."""

    keys: KeySet
    outputs: dict[str, str]


def _text(c: str) -> str:
    """Properties and the category share a slot, the other keys have their own."""
    return "text" if c.startswith("item_pro") or c == "item_category" else c


def _counted(keys: list[str], **outputs: str) -> Counted:
    return Counted({_text(k): k for k in keys}, outputs)


COUNTS = [_counted(keys, **{name: "count"}) for keys, name in FRAME_COUNTS]
CATEGORY = [_counted(["item_category"], item_category_sum="scaled")]
PROPERTIES = [_counted(keys, **{name: "count"}) for keys, name in PROPERTY_COUNTS]
CROSSES = [_counted(keys, **{name: "count"}) for keys, name in PROPERTY_CROSSES]
PREDICTED = [_counted(keys, **cols) for keys, cols in PREDICT_RANK_COUNTS]


@dataclass(frozen=True)
class Ranked:
    """One key set whose rows are ranked in time; ``order`` is that of the output columns."""

    keys: KeySet
    prefix: str
    order: tuple[str, ...]

    def columns(self) -> list[Column]:
        out = []
        for d in self.order:
            rank = F.col(f"_{d}_{self.prefix}")
            out += [rank.alias(f"{self.prefix}_{d}_rank"), flag_one(rank).alias(f"{self.prefix}_if_{d}")]
        return out


ENTITIES = [Ranked({_text(k): k for k in keys}, prefix, order) for keys, prefix, order in ENTITY_RANKS]
PROPERTY_RANKS = [Ranked({"text": f"item_pro{i}"}, f"item_pro{i}", order) for i, order in PROPERTY_RANK_ORDER.items()]

def _measures() -> list[Column]:
    """Of a frame row: its instance id counts if it is not null, and has a mean."""
    instance = F.col("instance_id")
    return [instance.isNotNull().cast("long").alias(N), F.lit(0).cast("long").alias(CONVERSIONS), instance.cast("double").alias(SUM)]


def count_answers(sources: list[tuple[DataFrame, list[Counted]]], n_rows: int) -> tuple[DataFrame, list[Column]]:
    """(melted answers, output aggregates) of key sets, each list over its own copy of the frame.

    The frame asks for the keys of its own rows, so one melting is source and probe.  Before
    it is summed the frame is dealt out, so a task holds the keys of so many rows only.
    """
    every = [c for _, counted in sources for c in counted]
    slots = {s: t for frame, counted in sources for s, t in slots_of(frame, [c.keys for c in counted]).items()}
    asked, dealt, first = [], [], 0
    for frame, counted in sources:
        keys = [c.keys for c in counted]
        asked.append(melted(frame, keys, slots, [ROW], first))
        needed = sorted({c for k in keys for c in k.values()})
        own = frame.select(*needed, *_measures()).repartition(parts_of(frame.sparkSession, n_rows * len(counted)))
        dealt.append(melted(own, keys, slots, list(MEASURES), first))
        first += len(counted)
    table = stage(rolled_up_own(union_melted(dealt), slots), "frame-sums")
    outputs = []
    for i, c in enumerate(every):
        for name, kind in c.outputs.items():
            value = F.col(N)
            if kind == "mean":
                value = F.try_divide(F.col(SUM), F.col(N))
            elif kind == "scaled":  # over all categories; null if there is one count only
                own = table.where(F.col(SET) == i)
                value = min_max_scaled(N, own.agg(F.min(N)).scalar(), own.agg(F.max(N)).scalar())
            outputs.append(of_set(i, value).alias(name))
    return answered(union_melted(asked), table, slots, n_rows, ROW, n_rows * len(every)), outputs


#: Rank sets are numbered from here, after all key sets.
RANKS_FROM = 100


def rank_answers(base: DataFrame, ranked: list[Ranked], n_rows: int, part_rows: int) -> tuple[DataFrame, list[Column]]:
    """(melted ranks, output aggregates): all key sets in one sort."""
    slots = slots_of(base, [r.keys for r in ranked])
    rows = melted(base.where(F.col(TS).isNotNull()), [r.keys for r in ranked], slots, [ROW, TS], RANKS_FROM)
    by = [c for c in rows.columns if c not in (ROW, TS)]
    found = scan_ranks(rows, by, TS, "frame-ranks", part_rows, n_rows * len(ranked), [ROW, SET])
    return found, [of_set(i, c).alias(f"{c}_{r.prefix}") for i, r in enumerate(ranked, start=RANKS_FROM) for c in (FIRST, LAST)]


def with_features(
    rows: DataFrame, sources: list[tuple[DataFrame, list[Counted]]], ranked: list[Ranked], part_rows: int = PART_ROWS
) -> DataFrame:
    """``rows`` with the features of the key sets and rank sets, by one melted table.

    Counts are 0 and ranks null where a row has no key; every key set is counted over the
    frame given with it, the ranks over ``rows``.
    """
    n_rows, parts = rows.count(), []
    if sources:
        parts.append(count_answers(sources, n_rows))
    if ranked:
        parts.append(rank_answers(rows, ranked, n_rows, part_rows))
    answers = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [found for found, _ in parts])
    n_parts = parts_of(rows.sparkSession, n_rows * (sum(len(counted) for _, counted in sources) + len(ranked)))
    wide = one_row_each(answers, ROW, [c for _, own in parts for c in own], n_parts)
    out = rows.repartition(n_parts, ROW).join(wide, ROW, "left")
    names = [name for _, counted in sources for c in counted for name in c.outputs]
    filled = [F.col(c) if c in KEEP_NULL else F.coalesce(F.col(c), F.lit(0)).alias(c) for c in names]
    return out.select(*rows.columns, *filled, *[c for r in ranked for c in r.columns()])


RANK_COLUMNS = tuple(
    [f"{prefix}_{d}_rank" for _, prefix, order in ENTITY_RANKS for d in order]
    + [f"item_pro{i}_{d}_rank" for i, order in PROPERTY_RANK_ORDER.items() for d in order]
)
#: Columns in which a row without a match stays null instead of 0.
KEEP_NULL = (*RANK_COLUMNS, "item_category_sum")


def filled_keys(base: DataFrame) -> DataFrame:
    """The frame after the reference's whole-frame fill: a null id or label is 0."""
    ids = ("user_id", "item_id", "shop_id", "is_trade")
    return base.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast(base.schema[c].dataType) for c in ids})


def frame_features(label: DataFrame, part_rows: int = PART_ROWS, fill_inputs: bool = False) -> DataFrame:
    """All within-frame features (70 columns + ``user_item_pre_count``).

    The parsed frame is written once (``stage_frame``).  Column order follows the reference.

    ``fill_inputs`` follows the reference's fill of the whole frame after the first five
    counts: from there on rows with a null id form the group of key 0, and are returned so.
    """
    base = stage_frame(label)
    rows = filled_keys(base) if fill_inputs else base
    others = CATEGORY + PROPERTIES + CROSSES + PREDICTED
    out = with_features(rows, [(base, COUNTS), (rows, others)], ENTITIES + PROPERTY_RANKS, part_rows)
    # parsed temporaries (DROPPED, _ts, _row) fall away here
    return out.select(*_output_order(label, out.columns))


FRAME_STEPS: dict[str, tuple[list[Counted], list[Ranked]]] = {
    "counts": (COUNTS, []),
    "entity_ranks": ([], ENTITIES),
    "category_popularity": (CATEGORY, []),
    "property_counts": (PROPERTIES, []),
    "property_crosses": (CROSSES, []),
    "property_ranks": ([], PROPERTY_RANKS),
    "predict_rank_counts": (PREDICTED, []),
}


def frame_subset(label: DataFrame, step: str, part_rows: int = PART_ROWS) -> DataFrame:
    """One step of the section on the parsed frame (keeps the parsed columns)."""
    if step == "parsed":
        return prepare_frame(label)
    base = stage_frame(label)
    counted, ranked = FRAME_STEPS[step]
    return with_features(base, [(base, counted)] if counted else [], ranked, part_rows)


__all__ = ["frame_features", "frame_subset", "prepare_frame", "stage_frame"]
