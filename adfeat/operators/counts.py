"""P1-P4 + P3/P11: per-key aggregates of a log, attached to a target by left join.

Impressions are the *non-null* count of the label column, conversions the rows
with label 1; both come from one aggregate (one shuffle, with map-side partial
aggregation, so a hot key costs one row per map task, not a third of the log).
Rows with a null key are dropped before grouping, as pandas grouping does.

The aggregated side is unique per key, so the left join never changes the
target row count.  The join strategy is left to AQE: a feature table that is
small after aggregation (shop, hour, category …) is broadcast at runtime after
its size was measured; a large one (user × item × hour) stays a sort-merge
join, and a hot target key is split by the skew-join rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL = "is_trade"


def keys_present(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def impressions(label: str = LABEL) -> Column:
    return F.count(F.col(label))


def conversions(label: str = LABEL) -> Column:
    return F.count_if(F.col(label) == 1)


def non_conversions(label: str = LABEL) -> Column:
    return F.count_if(F.col(label) == 0)


def key_aggregate(log: DataFrame, keys: list[str], aggs: dict[str, Column]) -> DataFrame:
    """``(keys…, name…)``: one aggregate per non-null key tuple."""
    return log.where(keys_present(keys)).groupBy(*keys).agg(
        *[expr.alias(name) for name, expr in aggs.items()]
    )


def key_counts(
    log: DataFrame,
    keys: list[str],
    n: str | None = None,
    conv: str | None = None,
    mean: str | None = None,
    label: str = LABEL,
) -> DataFrame:
    """P1 (impressions), P2 (conversions) and P4 (mean label) in one aggregate."""
    aggs: dict[str, Column] = {}
    if n:
        aggs[n] = impressions(label)
    if mean:
        aggs[mean] = F.avg(F.col(label))
    if conv:
        aggs[conv] = conversions(label)
    return key_aggregate(log, keys, aggs)


def fill_frame(df: DataFrame) -> DataFrame:
    """P11 in full: null becomes 0 in every number or flag and ``"0"`` in every text column."""
    return df.na.fill(0).na.fill(False).na.fill("0")


def attach(
    target: DataFrame,
    feats: DataFrame,
    keys: list[str],
    fill: object = 0,
    fills: dict[str, object] | None = None,
    fill_inputs: bool = False,
) -> DataFrame:
    """P3 + P11: left equi-join of a unique-per-key table, misses filled.

    ``fill`` applies to every attached column (``None`` keeps nulls);
    ``fills`` overrides it per column.  By default only attached columns are
    filled, inputs and keys keep their nulls (a null key never matches);
    ``fill_inputs`` fills the whole frame after the join, as the reference
    does, so that a null key is the key 0 from then on.

    Rows with a null key all meet in one partition of a sort-merge join; it is
    the left side of a left join, so AQE's skew rule splits it like any hot key.
    """
    added = [c for c in feats.columns if c not in keys]
    fills = fills or {}
    joined = target.join(feats, on=keys, how="left")

    def filled(c: str) -> Column:
        value = fills.get(c, fill)
        return F.col(c) if value is None else F.coalesce(F.col(c), F.lit(value)).alias(c)

    out = joined.select(*[F.col(c) for c in target.columns], *[filled(c) for c in added])
    return fill_frame(out) if fill_inputs else out


def group_part(rows: DataFrame, feats: DataFrame, row: str, keys: list[str]) -> DataFrame:
    """``(row, features)`` of the rows that have all keys and a match: the narrow half of an attach.

    Rows with a null key take no part in the keyed join; ``assemble`` fills them.
    """
    added = [c for c in feats.columns if c not in keys]
    return rows.where(keys_present(keys)).select(row, *keys).join(feats, on=keys).select(row, *added)


def assemble(rows: DataFrame, parts: list[DataFrame], row: str, fill: object = 0, keep_null: tuple[str, ...] = ()) -> DataFrame:
    """Join parts back on the row id; misses get ``fill`` except in the ``keep_null`` columns.

    Every part is hash-partitioned on the row id, so ``rows`` is shuffled once.
    """
    out, added = rows, []
    for part in parts:
        out = out.join(part, on=row, how="left")
        added += [c for c in part.columns if c != row]
    filled = [F.col(c) if c in keep_null else F.coalesce(F.col(c), F.lit(fill)).alias(c) for c in added]
    return out.select(*[F.col(c) for c in rows.columns], *filled)


def add_counts(
    target: DataFrame,
    log: DataFrame,
    keys: list[str],
    n: str | None = None,
    conv: str | None = None,
    mean: str | None = None,
    fill: object = 0,
    label: str = LABEL,
) -> DataFrame:
    """Aggregate ``log`` per key and attach the result to ``target``."""
    return attach(target, key_counts(log, keys, n=n, conv=conv, mean=mean, label=label), keys, fill)
