"""Words of a text as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeat.llm.common import bounded_sample, let

#: The separators of words, and their regular expression class.
SEPARATORS, BETWEEN = " \t\n\x0b\x0c\r", "[ \\t-\\r]+"

#: At most so many labelled rows fit a model: a documented bound, which also bounds what is broadcast.
LABELLED_ROWS = 50_000


def words(text: Column) -> Column:
    """array<string> of the words, in order; empty without a word, also for null."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SEPARATORS))
    return let(inner, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, BETWEEN)))


def word_hashes(text: Column) -> Column:
    """array<bigint> of the words' 64-bit hashes."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def total(values: Column, kind: str = "double") -> Column:
    return F.aggregate(values, F.lit(0).cast(kind), lambda a, x: a + x)


def numbers(values: list[float]) -> Column:
    """A literal array<double> of a bounded list; the optimiser folds it into one literal."""
    return F.split(F.lit(",".join(repr(float(x)) for x in values)), ",").cast("array<double>")


def labelled(labels: DataFrame, id_col: str, rows: int = LABELLED_ROWS) -> DataFrame:
    """The rows with an id and the smallest hash of it, at most ``rows``; one row per id."""
    return bounded_sample(labels.where(F.col(id_col).isNotNull()).dropDuplicates([id_col]), rows, id_col)
