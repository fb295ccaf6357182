"""Loading a raw CSV log with damaged lines, and the day-partitioned log it is kept in.

``ingest_csv`` reads every line once, keeps what does not fit the schema in a quarantine
table with its reason and file, and appends the rest to a log partitioned by day, which
``read_log`` reads by day: a bound on the time prunes partitions before any file is opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfeat.functions.derive import TS_FORMAT
from adfeat.sources.schema import IMPRESSION_SCHEMA
from adfeat.sources.staging import stage

DAY = "day"
LINE, FILE, REASON = "line", "file", "reason"
TIME = "context_timestamp"


def day_of(ts: str = TIME) -> Column:
    """The day of a time text; null if it is none."""
    return F.try_to_timestamp(F.col(ts), F.lit(TS_FORMAT)).cast("date")


def read_csv_lines(spark: SparkSession, path: str, columns: list[str] | None = None, schema: T.StructType = IMPRESSION_SCHEMA, **options: str) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, quarantine) of a CSV log, staged from one pass over it.

    ``columns`` names the fields of files without a header; with None the header does.
    A line goes to quarantine (line, file, reason) if its number of fields or a value's type
    is wrong (``malformed``) or its time is no time (``time``); a null time is allowed.
    """
    header = columns is None
    opts = {"header": str(header).lower(), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE, **options}
    names = spark.read.options(**opts).csv(path).columns if header else columns
    declared = {f.name: f.dataType for f in schema.fields}
    fields = [T.StructField(n, declared.get(n, T.StringType()), True) for n in names if n != LINE]
    raw = spark.read.options(**opts).schema(T.StructType([*fields, T.StructField(LINE, T.StringType(), True)])).csv(path, enforceSchema=not header)
    reason = F.when(F.col(LINE).isNotNull(), "malformed")
    if TIME in names:
        reason = reason.when(F.col(TIME).isNotNull() & day_of().isNull(), "time")
    # staged whole: every column is parsed, so every damaged line is seen, and only once
    read = stage(raw.withColumn(REASON, reason).withColumn(FILE, F.input_file_name()), "csv-lines")
    kept = [f for f in schema.fields if f.name in names]
    good = read.where(F.col(REASON).isNull()).select(*[f.name for f in kept])
    line = F.coalesce(F.col(LINE), F.to_csv(F.struct(*[f.name for f in fields])))
    return good, read.where(F.col(REASON).isNotNull()).select(line.alias(LINE), FILE, REASON)


def write_log(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Write impressions partitioned by day, in files of the advisory partition size.

    The rebalance deals a day's rows to as many tasks as its size asks for (a day with a third
    of the rows is split, small days share nothing), so there are few files and no hot task.
    Rows without a time go to the null day.
    """
    out = rows.withColumn(DAY, day_of()).hint("rebalance", F.col(DAY))
    out.write.mode(mode).partitionBy(DAY).parquet(path)


def read_log(spark: SparkSession, path: str, since: str | None = None, until: str | None = None, schema: T.StructType = IMPRESSION_SCHEMA) -> DataFrame:
    """Rows of a day-partitioned log, ``since`` <= day < ``until``; other days' files are not listed for reading."""
    log = spark.read.option("basePath", path).parquet(path)
    if since is not None:
        log = log.where(F.col(DAY) >= F.lit(since).cast("date"))
    if until is not None:
        log = log.where(F.col(DAY) < F.lit(until).cast("date"))
    return log.select(*[f.name for f in schema.fields if f.name in log.columns])


def ingest_csv(spark: SparkSession, path: str, log_path: str, quarantine_path: str, columns: list[str] | None = None, **options: str) -> None:
    """Append a CSV log to the day-partitioned log, and its damaged lines to the quarantine table."""
    good, bad = read_csv_lines(spark, path, columns, **options)
    write_log(good, log_path)
    bad.write.mode("append").parquet(quarantine_path)
