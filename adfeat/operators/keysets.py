"""P1-P4 over many key sets at once: grouping sets, and one melted probe instead of a join per set.

A feature section asks for counts by a dozen or two key sets.  Aggregating and attaching them
one by one shuffles the log and the target once per set.  Here every row is melted to one
narrow row per key set (the set's number, its keys in fixed slots), so that

1. one aggregate gives the sums of all sets (map-side combined; a hot key is one row per map
   task), together with the number of target rows that ask for each key;
2. one join answers all target rows.  Keys asked by more than one target row in ``HOT`` are
   at most ``HOT`` per set, whatever the data, so they are broadcast; the others meet in a
   shuffled join in which no key has more than that share of the rows;
3. one conditional aggregate brings the answers back to one row per target row.

A row lacking a key of a set takes no part in it, as pandas grouping and merging do.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfeat.operators.counts import keys_present

#: Measures of a melted row; sums of them are all that a set's features need.
N, CONVERSIONS, SUM, ASKED = "_n", "_c", "_s", "_asked"
MEASURES = (N, CONVERSIONS, SUM)

SET = "_set"

#: A key is hot if more than one target row in so many asks for it.
HOT = 1000

#: Melted rows that one task aggregates, so its memory does not grow with the input.
MELT_ROWS = 1_000_000

#: slot → column: the keys of a set in the slots they share with other sets.
KeySet = dict[str, str]


def slot(name: str) -> str:
    return f"_k_{name}"


def _absent(kind: T.DataType) -> Column:
    """The value of a slot that a set does not use (sets never meet, so any value will do)."""
    return F.lit("" if isinstance(kind, T.StringType) else 0).cast(kind)


def melted(rows: DataFrame, sets: list[KeySet], slots: dict[str, T.DataType], carry: list[str | Column], first: int = 0) -> DataFrame:
    """One row ``(carry…, set number, slots…)`` per row and key set whose keys it has.

    Sets are numbered from ``first`` in the order given.
    """

    numbers = [F.when(keys_present(list(k.values())), F.lit(i)).alias(f"_s{i}") for i, k in enumerate(sets, start=first)]
    values = {(s, c): F.col(c).cast(slots[s]).alias(f"_v_{s}_{c}") for k in sets for s, c in k.items()}
    absent = [_absent(t).alias(f"_d_{s}") for s, t in slots.items()]
    ready = rows.select(*carry, *numbers, *values.values(), *absent)
    # one projection per key set of each row (Expand), which is cheaper than an exploded array
    rows_of = [", ".join([f"_s{i}", *(f"`_v_{s}_{k[s]}`" if s in k else f"_d_{s}" for s in slots)]) for i, k in enumerate(sets, start=first)]
    to = ", ".join([SET, *(slot(s) for s in slots)])
    melt = ", ".join(f"({r}) AS `{i}`" for i, r in enumerate(rows_of))
    out = rows.sparkSession.sql(f"SELECT * FROM {{ready}} UNPIVOT INCLUDE NULLS (({to}) FOR _name IN ({melt}))", ready=ready)
    return out.where(F.col(SET).isNotNull()).drop("_name")


def slots_of(rows: DataFrame, sets: list[KeySet]) -> dict[str, T.DataType]:
    """The slots of the sets, with the type that their columns have in ``rows``."""
    return {s: rows.schema[c].dataType for keys in sets for s, c in keys.items()}


def rolled_up(source: DataFrame, asked: DataFrame, slots: dict[str, T.DataType]) -> DataFrame:
    """``(set, slots…, measures, asked)`` of the keys that melted ``asked`` rows name.

    ``source`` is melted with the measures; ``asked`` without.  Both go through one aggregate.
    """
    by = [SET, *[slot(s) for s in slots]]
    none = [F.lit(None).cast(dict(source.dtypes)[m]).alias(m) for m in MEASURES]
    both = source.select(*by, *MEASURES, F.lit(0).cast("long").alias(ASKED))
    both = both.unionByName(asked.select(*by, *none, F.lit(1).cast("long").alias(ASKED)))
    return both.groupBy(*by).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in (*MEASURES, ASKED)]).where(F.col(ASKED) > 0)


def rolled_up_own(source: DataFrame, slots: dict[str, T.DataType]) -> DataFrame:
    """``rolled_up`` of melted rows that are source and probe in one: they are melted and summed once."""
    by = [SET, *[slot(s) for s in slots]]
    sums = [F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in MEASURES]
    return source.groupBy(*by).agg(*sums, F.count(F.lit(1)).alias(ASKED))


def parts_of(spark: SparkSession, n_rows: int) -> int:
    """Partitions of at most ``MELT_ROWS`` melted rows, and no fewer than tasks run at once."""
    return max(spark.sparkContext.defaultParallelism, n_rows // MELT_ROWS + 1)


def one_row_each(answers: DataFrame, row: str, outputs: list[Column], parts: int) -> DataFrame:
    """``outputs`` (aggregates) of the melted answers of every row id, in ``parts`` partitions by the id.

    The narrow answers are shuffled first: ids do not repeat inside a task before that, so
    sums on the map side would hold a wide row per id of the task and save nothing.
    """
    return answers.repartition(parts, row).groupBy(row).agg(*outputs)


def answered(asked: DataFrame, table: DataFrame, slots: dict[str, T.DataType], n_rows: int, row: str, n_asked: int) -> DataFrame:
    """``(row, set, measures)`` of the melted ``asked`` rows from the staged ``table``.

    ``n_asked`` bounds the number of ``asked`` rows.  Cold keys meet in partitions sized by it,
    so that a task can hold its part of the table, at most a key for an asked row, as a hash
    table instead of sorting both sides.
    """
    by = [SET, *[slot(s) for s in slots]]
    parts = parts_of(asked.sparkSession, n_asked)
    is_hot = F.col(ASKED) * HOT > n_rows
    hot, cold = table.where(is_hot).drop(ASKED), table.where(~is_hot).drop(ASKED)
    direct = asked.join(F.broadcast(hot), by)  # at most HOT keys of a set
    rest = asked.join(F.broadcast(hot.select(*by)), by, "left_anti").repartition(parts, *by)
    rest = rest.join(cold.repartition(parts, *by).hint("shuffle_hash"), by)
    return direct.select(row, SET, *MEASURES).unionByName(rest.select(row, SET, *MEASURES))


def of_set(i: int, value: str | Column) -> Column:
    """Aggregate: the value that set ``i`` has for a row (null if it has none)."""
    return F.max(F.when(F.col(SET) == i, F.col(value) if isinstance(value, str) else value))


def union_melted(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
