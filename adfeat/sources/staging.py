"""Stage an intermediate DataFrame as a parquet table in the checkpoint folder.

A feature section reads its parsed input once per aggregate or rank table.
Writing the parsed, narrow frame once and reading it back gives every branch a
columnar scan with pruning and pushdown instead of re-reading and re-parsing
the raw strings, and cuts the lineage: a lost executor recomputes from the
staged files, not from the raw log.  The folder is the cluster's shared
``spark.checkpoint.dir`` (``ensure_checkpoint_dir``), never a machine-local
path on a cluster.

A returned DataFrame reads its staged tables until it has been written, so the
caller owns them: inside ``staging_scope(spark)`` every staged table is removed
when the scope ends; without a scope they stay in the checkpoint folder, as
Spark's own reliable checkpoints do.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from adfeat.session import ensure_checkpoint_dir

_scope: ContextVar[list[str] | None] = ContextVar("staging_scope", default=None)


#: Spark's own setting: shuffle files go when the execution that wrote them ends.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def unstage(df: DataFrame) -> None:
    """Remove the table of a DataFrame that ``stage`` returned, after its last reader was written."""
    _delete(df.sparkSession, df._staged_at)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once (eagerly) and return a DataFrame reading it back.

    The shuffle files of the write are removed when it ends, as the table takes their place,
    so a chain of staged steps holds the shuffles of one step at a time.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/adfeat-stage/{name}-{uuid.uuid4().hex}"
    owned = _scope.get()
    if owned is not None:
        owned.append(path)
    before = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEAN) if before is None else spark.conf.set(CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)  # known, so no job reads the footers for it
    out._staged_at = path
    return out


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Own the tables staged inside: they are removed when the scope ends, also on an error.

    Yields the list of their paths.  Write or collect results inside the scope.
    """
    owned: list[str] = []
    token = _scope.set(owned)
    try:
        yield owned
    finally:
        _scope.reset(token)
        for path in owned:
            _delete(spark, path)
