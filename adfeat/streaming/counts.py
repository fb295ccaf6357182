"""History count features maintained incrementally with Structured Streaming.

The reference recomputes its per-key impression / conversion counts from
the whole history on every call.  For a log that keeps arriving, the same
aggregate (``operators.counts.key_counts`` – it works unchanged on a
streaming DataFrame) runs as a stateful streaming aggregation: Spark keeps
one state row per key in the fault-tolerant state store, and each
micro-batch emits the keys whose totals changed (``update`` mode).

Those rows are appended, with their batch id, to a parquet changelog by
``foreachBatch`` (idempotent per batch id, so a retried batch after a
failure does not double-count).  ``latest_counts`` reads the changelog as a
batch DataFrame and keeps the newest total per key – a partial aggregate,
so a hot key costs one row per map task – ready for ``attach``.
``compact_changelog`` folds it into a snapshot partition; reads then take the
newest snapshot plus only the batches after it (both partition-pruned).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from adfeat.operators.counts import key_counts
from adfeat.operators.keysets import MEASURES
from adfeat.plans.history import CAT_KEY, CELL_KEYS, HOUR, Cells, measured
from adfeat.sources.views import imp_events_from

BATCH = "_batch_id"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def streaming_key_counts(stream: DataFrame, keys: list[str], n: str, conv: str) -> DataFrame:
    """Running impressions / conversions per key of an impression stream."""
    return key_counts(stream, keys, n=n, conv=conv)


def write_changelog(
    counts: DataFrame, path: str, checkpoint: str, available_now: bool = True, rocksdb: bool = True
) -> StreamingQuery:
    """Append each micro-batch's changed totals to a parquet changelog.

    The state is one row per key for the life of the query (all-time counts
    have no watermark to expire them), so by default it lives in the RocksDB
    state store – off-heap, spilled to local disk, snapshotted with the
    checkpoint – rather than in executor heap.  The provider is fixed when a
    checkpoint is created, so this applies to new queries only.
    """
    spark = counts.sparkSession

    def append(batch: DataFrame, batch_id: int) -> None:
        out = batch.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        # overwrite only this batch's partition: a replayed batch replaces itself
        (
            out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH)
            .parquet(path)
        )

    writer = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(append)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    # a query takes its settings when it starts; the caller's session gets its own back
    before = spark.conf.get(PROVIDER)
    try:
        if rocksdb:
            spark.conf.set(PROVIDER, ROCKSDB)
        return writer.start()
    finally:
        spark.conf.set(PROVIDER, before)


def streaming_cells(stream: DataFrame) -> DataFrame:
    """Running cells (user, item, shop, category, hour → measures) of an impression stream.

    All eleven key groups of the history section roll up from them, so one stateful query
    keeps every history feature current: ``history_features(latest_cells(...), target)``.
    A null key is a value of its own in a cell.
    """
    return measured(stream).groupBy(*CELL_KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])


def latest_cells(spark: SparkSession, path: str) -> Cells:
    """The newest cells of a changelog of ``streaming_cells``."""
    schema = T.StructType([T.StructField(k, T.StringType() if k == CAT_KEY else T.IntegerType() if k == HOUR else T.LongType()) for k in CELL_KEYS])
    return Cells(cells=latest_counts(spark, path, CELL_KEYS, list(MEASURES), schema))


SNAP = "_snapshot_of"


def _snapshots(path: str) -> str:
    return path.rstrip("/") + "__snapshots"


def _newest(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        *[F.max_by(F.col(m), F.col(BATCH)).alias(m) for m in measures], F.max(BATCH).alias(BATCH)
    )


def _files(spark: SparkSession, pattern: str) -> list:
    """What a path pattern matches, as Hadoop file statuses."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    return list(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or [])


def _snapshot_and_tail(spark: SparkSession, path: str) -> DataFrame:
    """Latest snapshot (if any) plus the changelog batches written after it."""
    if not _files(spark, f"{_snapshots(path)}/{SNAP}=*"):
        return spark.read.parquet(path)
    snaps = spark.read.parquet(_snapshots(path))
    last = snaps.agg(F.max(SNAP)).first()[0]
    snap = snaps.where(F.col(SNAP) == F.lit(last)).drop(SNAP)  # partition-pruned read
    if not _files(spark, f"{path}/{BATCH}=*"):  # all folded and removed
        return snap
    log = spark.read.parquet(path)
    tail = log.where(F.col(BATCH) > F.lit(last))  # partition-pruned read
    return snap.unionByName(tail)


def latest_counts(spark: SparkSession, path: str, keys: list[str], measures: list[str], key_types: T.StructType | None = None) -> DataFrame:
    """Newest total per key (totals only grow, batch ids order them).

    Without a changelog (no batch has changed a total yet) there are no rows; the keys are of
    ``key_types`` then, or bigint as the ids of the impression log are, the measures bigint.
    """
    if not _files(spark, f"{path}/{BATCH}=*") and not _files(spark, f"{_snapshots(path)}/{SNAP}=*"):
        types = key_types or T.StructType([T.StructField(c, T.LongType()) for c in keys])
        return spark.createDataFrame([], T.StructType([*types.fields, *(T.StructField(c, T.LongType()) for c in measures)]))
    return _newest(_snapshot_and_tail(spark, path), keys, measures).drop(BATCH)


def compact_changelog(spark: SparkSession, path: str, keys: list[str], measures: list[str]) -> int:
    """Fold the changelog into a snapshot of the newest totals; returns its batch id.

    The snapshot is written as a new partition beside the changelog, so nothing
    is rewritten in place; later reads scan it plus the batches after it.
    """
    newest = _newest(_snapshot_and_tail(spark, path), keys, measures)
    last = newest.agg(F.max(BATCH)).first()[0]
    if last is None:
        return -1
    (
        newest.withColumn(SNAP, F.lit(last).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SNAP)
        .parquet(_snapshots(path))
    )
    return int(last)


def remove_folded(spark: SparkSession, path: str) -> int:
    """Delete what the newest snapshot makes superfluous: its batches of the changelog, and older snapshots.

    Returns the number of partitions deleted.  Call it after ``compact_changelog`` when no
    reader of an older snapshot is left; the newest snapshot and later batches stay, so what
    is kept is one row per key and the batches since.
    """
    number = lambda status: int(status.getPath().getName().split("=")[1])
    snaps = {number(s): s.getPath() for s in _files(spark, f"{_snapshots(path)}/{SNAP}=*")}
    if not snaps:
        return 0
    last = max(snaps)
    gone = [p for n, p in snaps.items() if n < last]
    gone += [s.getPath() for s in _files(spark, f"{path}/{BATCH}=*") if number(s) <= last]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in gone:
        p.getFileSystem(conf).delete(p, True)
    return len(gone)


def impression_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The ``events`` table (a file or a folder of part files) as a stream shaped like ``imp_events``.

    ``max_files`` bounds the files of a micro-batch.
    """
    path = f"{sf_dir}/events.parquet"
    raw = spark.readStream.format("parquet").schema(spark.read.parquet(path).schema)
    if max_files:
        raw = raw.option("maxFilesPerTrigger", max_files)
    if all(f.isDirectory() for f in _files(spark, path)):
        return imp_events_from(raw.load(path))
    # a file source streams folders: take the one file from the folder it is in
    return imp_events_from(raw.option("pathGlobFilter", "events.parquet").load(sf_dir))


__all__ = [
    "compact_changelog",
    "impression_stream",
    "latest_cells",
    "latest_counts",
    "remove_folded",
    "streaming_cells",
    "streaming_key_counts",
    "write_changelog",
]
