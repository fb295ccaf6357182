"""History features from cells kept by day (an incremental form of H1-H23).

A day's cells (user, item, shop, category, hour → impressions, conversions, label sum) are
sums, so the cells of some days together are the cells of their log.  ``add_days`` reduces
only the new days' rows and writes each day as a partition of its own (a day added again
replaces itself); ``cells_of`` reads the days asked for; ``history_features`` and
``modular_features`` take them in place of a log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adfeat.operators.keysets import MEASURES
from adfeat.plans.history import CELL_KEYS, Cells, measured
from adfeat.sources.ingest import DAY, day_of


def day_cells(log: DataFrame) -> DataFrame:
    """``(day, keys…, measures)`` of a log: one aggregate."""
    rows = measured(log.withColumn(DAY, day_of()), [DAY])
    return rows.groupBy(DAY, *CELL_KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])


def add_days(log: DataFrame, path: str) -> None:
    """Write the cells of the days in ``log``; the rows of a day must all be there."""
    out = day_cells(log).hint("rebalance", F.col(DAY))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def cells_of(spark: SparkSession, path: str, since: str | None = None, until: str | None = None) -> Cells:
    """The cells of the days ``since`` <= day < ``until``; other days' files are not read."""
    cells = spark.read.parquet(path)
    if since is not None:
        cells = cells.where(F.col(DAY) >= F.lit(since).cast("date"))
    if until is not None:
        cells = cells.where(F.col(DAY) < F.lit(until).cast("date"))
    return Cells(cells=cells.select(*CELL_KEYS, *MEASURES))
