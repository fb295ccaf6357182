"""Helpers shared by the operators: tables, session settings, connected components."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adfeat.sources.staging import stage

#: What one Arrow batch between the JVM and a Python worker may hold.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20

#: The separators of a word, as a Java regular expression class body.
SPACE = " \t-\r"


def use_session(spark: SparkSession) -> SparkSession:
    """Session settings the operators are written for; they bound the memory of an Arrow batch.

    Python workers also get this package's folder on their path, for sessions that were not
    started from it (a cluster ships the package with ``--py-files`` as usual).
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    workers = spark.sparkContext.environment
    if root not in workers.get("PYTHONPATH", "").split(os.pathsep):
        workers["PYTHONPATH"] = os.pathsep.join(filter(None, [root, workers.get("PYTHONPATH")]))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_sample(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """The ``rows`` rows with the smallest hash of ``key``, all if there are no more.

    A bound on the hash leaves little more than ``rows`` rows before they are ordered, so what
    the tasks send does not grow with their number.
    """
    n, h = df.count(), F.xxhash64(*key)
    if n > rows:
        share = min(1.0, (rows + 8 * rows**0.5 + 8) / n)
        df = df.where(h < F.lit(min(2**63 - 1, int(share * 2**64) - 2**63)))
    return df.orderBy(h, *key).limit(rows)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where body uses it in a lambda."""
    return F.transform(F.array(value), body)[0]


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array and its offsets (from 0); a null has no bytes."""
    kind = array.type
    wide = pa.types.is_large_string(kind) or pa.types.is_large_binary(kind)
    if array.null_count:
        array = array.fill_null(b"" if pa.types.is_binary(kind) or pa.types.is_large_binary(kind) else "")
    _, offsets, data = array.buffers()
    n = len(array)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + n + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes stay below ``most`` (a longer row is a range of its own)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def _changed(edges: DataFrame) -> tuple[int, int]:
    r = edges.select(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
    return int(r[0]), int(r[1])


#: Edges that one task joins in memory before the distributed rounds.
LOCAL_EDGES = 500_000


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over a task's edges (u, v): each vertex with the smallest one it reaches here."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            u, v = find(u), find(v)
            if u != v:
                root[max(u, v)] = min(u, v)
    pairs = np.array([(x, find(x)) for x in list(root)], np.int64).reshape(-1, 2)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])


def connected_components(edges: DataFrame, name: str = "cc", local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(id, component) of every vertex of ``edges`` (a, b: long); component is the smallest id reachable.

    First each task joins a bounded share of the edges, which leaves at most one edge for a
    vertex and task; if there is one share only, that is the result.  Otherwise large-star and
    small-star steps alternate until nothing changes.  Each is one aggregate and one join on
    the edges; no task holds the edges of a vertex (the minimum is pre-aggregated, the join
    may be split), and every round is written to the shared checkpoint folder.  A vertex
    without an edge to another is not returned; no edges give no rows.
    """
    e = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"), f"{name}-edges")
    shares = e.count() // local_edges + 1
    e = stage(e.coalesce(shares).mapInArrow(_joined, "u long, v long"), f"{name}-joined")
    state, before = _changed(e), (0, 0)
    while shares > 1 and state[0] and state != before:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("s"))
            .select("s.u", "s.v")
            .where("u <> v")
            .distinct()
        )
        e = stage(small, f"{name}-round")
        state, before = _changed(e), state
    star = e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component")
    hubs = star.select(F.col("component").alias("id"), "component").distinct()
    return star.unionByName(hubs)


def _bits_of(ids: np.ndarray, bits: int) -> np.ndarray:
    """Three places of each id in a bit set."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    out = []
    for _ in range(3):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out.append((x >> np.uint64(20)) % np.uint64(bits))
    return np.stack(out)


class IdFilter:
    """A Bloom filter of ids: a bit set of fixed size (4 MB), whatever the number of ids."""

    BITS = 1 << 25
    #: Ids up to which a filter lets through less than one other id in 30.
    MOST = 4_000_000

    def __init__(self, ids: DataFrame):
        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at = np.unique(_bits_of(b.column(0).to_numpy(zero_copy_only=False), IdFilter.BITS).ravel())
                word, first = np.unique(at >> np.uint64(6), return_index=True)
                mask = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
                yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(mask.view(np.int64))], names=["word", "mask"])

        words = ids.select(F.col(ids.columns[0]).cast("long")).mapInArrow(places, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
        self.words = np.zeros(IdFilter.BITS >> 6, np.int64)  # at most 524,288 words come to the driver
        self.words[words.column("word").to_numpy()] = words.column("mask").to_numpy()

    def may_have(self, ids: np.ndarray) -> np.ndarray:
        """False only for ids that are not in the set."""
        at = _bits_of(ids, IdFilter.BITS)
        words = self.words.view(np.uint64)[(at >> np.uint64(6)).astype(np.int64)]
        return ((words >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)
