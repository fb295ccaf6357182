"""Scalar column expressions for the list and time columns.

Every function returns a native Catalyst expression (no Python UDF), so the
parsing stays inside whole-stage codegen.  Element access uses ``get``, which
yields null for a short list instead of raising under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: One or two digits in every field but the year, as the reference's parser takes them.
TS_FORMAT = "yyyy-M-d H:m:s"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_list(c: str | Column, sep: str = ";") -> Column:
    """``a;b;c`` → ``[a, b, c]`` (the separator is a literal, not a pattern)."""
    return F.split(_col(c), "\\" + sep if sep in ".$|()[]{}^?*+\\" else sep)


def category_key(c: str | Column) -> Column:
    """Element 1 of a ``;`` list of two or fewer, else element 2 (0-based)."""
    a = split_list(c)
    return F.when(F.size(a) <= 2, F.get(a, 1)).otherwise(F.get(a, 2))


def predicted_categories(c: str | Column) -> Column:
    """``cat:prop,prop;cat:prop`` → ``[cat, cat]``."""
    return F.transform(split_list(c), lambda x: F.get(F.split(x, ":"), 0))


def index_or_minus1(value: str | Column, arr: str | Column) -> Column:
    """0-based position of the first match, −1 when absent (null for a null value)."""
    return F.array_position(_col(arr), _col(value)) - F.lit(1)


def parse_time(c: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text, also ``yyyy-M-d H:m:s`` → timestamp (session time zone, UTC here)."""
    return F.to_timestamp(_col(c), TS_FORMAT)


def hour_of(c: str | Column) -> Column:
    """S3: hour 0-23 of a time as ``parse_time`` takes it."""
    return F.hour(parse_time(c))


def property_at(c: str | Column, i: int) -> Column:
    """Element ``i`` (0-based) of the ``;`` property list."""
    return F.get(split_list(c), i)


def list_length(c: str | Column) -> Column:
    """Number of ``;`` elements."""
    return F.size(split_list(c))


def indicator(cond: Column) -> Column:
    """1 when the condition holds, else 0 (null counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def min_max_scaled(x: str | Column, lo: Column, hi: Column) -> Column:
    """``(x − lo) / (hi − lo)``; null when the range is empty."""
    return F.try_divide((_col(x) - lo).cast("double"), hi - lo)
