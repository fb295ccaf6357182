"""Embedding near-dedup by spherical-cap filters (operator 8).

A filter is a direction on the sphere with a cap around it.  The directions form structured
random product codes: after a random rotation the coordinates are cut in two blocks, each
block has a small random code, and every combination of codewords is a direction.  A vector
lists all directions of a code whose cosine with it exceeds its bound, which is set so that
the list has a fixed length; the list is decoded from the blocks' sorted scores without
looking at the other directions.  Vectors that share a filter are compared in double
precision.  A linked pair is counted only in the first filter that both share, so a filter
gives counts and spanning links, never all its pairs; filters with many vectors are compared
block against block.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfeat.llm.common import connected_components, shuffle_partitions, use_session
from adfeat.sources.staging import stage

#: Independent codes, and directions of a code for each row of the table: so the vectors that a
#: direction draws by chance are as many in a table of any size.
CODES, DIRECTIONS = 4, 128

#: Codewords of a block, at least and at most (2 ** 34 directions a code, for 130 million rows).
LEAST_WORDS, MOST_WORDS = 256, 1 << 17


def codewords(rows: int) -> int:
    """Codewords of each of a code's two blocks for a table of so many rows."""
    return min(MOST_WORDS, max(LEAST_WORDS, math.isqrt(DIRECTIONS * rows) + 1))


def listed(dimension: int) -> int:
    """Filters of a vector in a code; few dimensions need more.

    Of 1,000 random pairs of cosine 0.9 and 256 to 8,192 codewords, all share a filter at 64 and
    at 384 dimensions, and 0.996 or more at 16.
    """
    return 16 if dimension >= 32 else 64

#: Vectors of a filter that are compared as one block, and rows that a task's group is sized for.
BLOCK_ROWS, LOT_ROWS = 512, 4096


@functools.cache
def product_codes(dimension: int, n_words: int) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """(rotation, codewords of every block) of each code; the same on every machine."""
    rng = np.random.Generator(np.random.PCG64([8, dimension]))
    out = []
    for _ in range(CODES):
        rotation = np.linalg.qr(rng.normal(size=(dimension, dimension)))[0]
        code = []
        for part in np.array_split(np.arange(dimension), min(2, dimension)):
            words = rng.normal(size=(n_words, len(part)))
            code.append(words / np.linalg.norm(words, axis=1, keepdims=True) * np.sqrt(len(part) / dimension))
        out.append((rotation, code))
    return out


def _best(scores: np.ndarray, n: int) -> np.ndarray:
    """Columns of the n largest scores of each row, largest first."""
    n = min(n, scores.shape[1])
    top = np.argpartition(-scores, n - 1, axis=1)[:, :n]
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(scores, top, 1), axis=1, kind="stable"), 1)


def filters_of(units: np.ndarray, n_words: int) -> np.ndarray:
    """The sorted filters (rows, CODES times the list's length or fewer) of unit vectors.

    The i-th best word of one block and the j-th best of the other can be among the n best
    directions only if i * j <= n, so few combinations are scored.
    """
    dimension = units.shape[1]
    most, out = listed(dimension), []
    for c, (rotation, code) in enumerate(product_codes(dimension, n_words)):
        rotated, total, number, at = units @ rotation, None, None, 0
        for words in code:
            scores = rotated[:, at : at + words.shape[1]] @ words.T
            at += words.shape[1]
            own = _best(scores, most)
            scores = np.take_along_axis(scores, own, 1)
            if total is None:
                total, number = scores, own
                continue
            i, j = (x.ravel() for x in np.mgrid[0 : total.shape[1], 0 : own.shape[1]])
            few = (i + 1) * (j + 1) <= most
            total, number = total[:, i[few]] + scores[:, j[few]], number[:, i[few]] * len(words) + own[:, j[few]]
            top = _best(total, most)
            total, number = np.take_along_axis(total, top, 1), np.take_along_axis(number, top, 1)
        out.append(number + (dimension * CODES + c) * n_words**2)
    return np.sort(np.concatenate(out, axis=1), axis=1)


def _vectors(batches: Iterator[pa.RecordBatch], n_words: int) -> Iterator[pa.RecordBatch]:
    """(vec_id, left, right, vector, filters): the last two are binary, null for a vector that links with nothing."""
    for b in batches:
        n = b.num_rows
        left, right = np.zeros(n, np.int64), np.zeros(n, np.int64)
        vectors: list[bytes | None] = [None] * n
        filters: list[bytes | None] = [None] * n
        by_size: dict[int, list[int]] = {}
        for i, v in enumerate(b.column(1).to_pylist()):
            if v and None not in v:
                x = np.array(v, np.float64)
                if np.isfinite(x).all() and x.any():
                    vectors[i] = x.tobytes()
                    by_size.setdefault(len(x), []).append(i)
                    left[i], right[i] = np.frombuffer(xxhash.xxh3_128_digest(vectors[i]), np.int64)
        for rows in by_size.values():
            for k in range(0, len(rows), BLOCK_ROWS):
                own = rows[k : k + BLOCK_ROWS]
                for i, f in zip(own, filters_of(_units(np.array([np.frombuffer(vectors[i]) for i in own])), n_words), strict=True):
                    filters[i] = f.tobytes()
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(left), pa.array(right), pa.array(vectors, pa.binary()), pa.array(filters, pa.binary())], names=["vec_id", "left", "right", "vector", "filters"])


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps the squares in range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _memberships(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = [np.frombuffer(x.as_buffer(), np.int64) for x in b.column(1)]
        sizes = [len(x) for x in lists]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64)), pa.array(np.repeat(b.column(0).to_numpy(zero_copy_only=False), sizes))], names=["filter", "id"])


def _share_earlier(lists: list[np.ndarray], a: np.ndarray, b: np.ndarray, here: int) -> np.ndarray:
    """Whether rows a[i] and b[i] share a filter before ``here``."""
    cut = [x[: np.searchsorted(x, here)] for x in lists]
    if not sum(map(len, cut)):
        return np.zeros(len(a), bool)
    names, at = np.unique(np.concatenate(cut), return_inverse=True)
    member = np.zeros((len(lists), len(names)), np.float32)
    member[np.repeat(np.arange(len(lists)), [len(x) for x in cut]), at] = 1
    member = member[:, member.sum(axis=0) > 1]
    return (member @ member.T)[a, b] > 0


def compare(ids: np.ndarray, weight: np.ndarray, block: np.ndarray, units: np.ndarray, lists: list[np.ndarray], here: int, across: bool, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(new links of each row, spanning pairs of rows) of a filter's block, or of two blocks if ``across``."""
    links = np.zeros(len(ids), np.int64)
    near = units @ units.T >= cosine
    i, j = np.nonzero(np.triu(near, 1) & (ids[:, None] != ids))
    if across:
        cross = block[i] != block[j]
        i, j = i[cross], j[cross]
    if not len(i):
        return links, np.zeros((0, 2), np.int64)
    new = ~_share_earlier(lists, i, j, here)
    np.add.at(links, i[new], weight[j[new]])
    np.add.at(links, j[new], weight[i[new]])
    root, spanning = list(range(len(ids))), []
    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[max(x, y)] = min(x, y)
            spanning.append((x, y))
    return links, np.array(spanning)


def compare_lot(t: pa.Table, cosine: float) -> pa.Table:
    """(id, n, a, b): links found per row, and spanning links a - b, of all filters in a group of rows."""
    t = t.combine_chunks()
    ids, weight, block, here, one, two = (t.column(c).to_numpy() for c in ("id", "rows", "block", "filter", "one", "two"))
    shared = pa.concat_arrays(t.column("shared").chunks) if t.num_rows else pa.array([], pa.list_(pa.int64()))
    values, at = shared.values.to_numpy(zero_copy_only=False), shared.offsets.to_numpy()
    lists = [values[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]
    sizes = np.array([len(x.as_buffer()) for x in t.column("vector")])
    counts = np.zeros(len(ids), np.int64)
    ends = [np.zeros((0, 2), np.int64)]
    order = np.lexsort((ids, two, one, here))
    key = np.column_stack([here, one, two])[order]
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)]) if len(order) else order
    units = np.zeros((len(ids), sizes.max(initial=0) // 8))
    for n in np.unique(sizes):  # vectors of one length share filters only among themselves
        own = np.flatnonzero(sizes == n)
        units[own, : n // 8] = _units(np.array([np.frombuffer(t.column("vector")[int(i)].as_buffer()) for i in own]))
    for lo, hi in zip(first, np.append(first[1:], len(order)), strict=True):
        if hi - lo > 1:
            r = order[lo:hi]
            n, pairs = compare(ids[r], weight[r], block[r], units[r], [lists[i] for i in r], here[r[0]], one[r[0]] != two[r[0]], cosine)
            counts[r] += n
            ends.append(ids[r][pairs])
    pairs, some = np.concatenate(ends), counts > 0
    none, pad = [None] * int(some.sum()), [None] * len(pairs)
    return pa.table(
        {
            "id": pa.array([*ids[some].tolist(), *pad], pa.int64()),
            "n": pa.array([*counts[some].tolist(), *pad], pa.int64()),
            "a": pa.array([*none, *pairs[:, 0].tolist()], pa.int64()),
            "b": pa.array([*none, *pairs[:, 1].tolist()], pa.int64()),
        }
    )


def near_vectors(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Rows are linked if the cosine of their vectors, in double precision, is ``cosine`` or more
    (found if they share a filter).  A vector that is null, empty, zero or holds a null or
    non-finite component links with nothing, and vectors of different lengths never link.
    Equal vectors are compared once and counted each.  component_id is the smallest id
    reachable.  Rows that repeat an id are one vertex; a row with a null id is counted by the
    others, gets no component and is kept.  An empty table gives no rows.
    """
    spark = use_session(vectors.sparkSession)
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    n_words = codewords(source.count())
    rows = stage(source.mapInArrow(lambda it: _vectors(it, n_words), "vec_id long, left long, right long, vector binary, filters binary"), "caps-vectors")
    valid = rows.where("vector is not null")
    classes = valid.groupBy("left", "right").agg(F.min("vec_id").alias("id"), F.count("*").alias("rows"), F.min("vector").alias("vector"), F.min("filters").alias("filters"))
    # a class of null ids only is still counted by others: it gets a number that is no id
    number = F.coalesce("id", F.least(F.col("left"), F.lit(-1)) - F.lit(2**40))
    classes = stage(classes.withColumn("id", number), "caps-classes")

    members = classes.select("id", "filters").mapInArrow(_memberships, "filter long, id long")
    sizes = members.groupBy("filter").agg(F.count("*").alias("n")).where("n > 1")
    shared = stage(members.join(sizes, "filter"), "caps-shared")
    lists = shared.groupBy("id").agg(F.array_sort(F.collect_list("filter")).alias("shared"))  # a filter of one vector compares nothing
    shared = shared.withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
    shared = shared.withColumn("block", F.pmod(F.xxhash64("filter", "id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = shared.select("filter", "id", "block", other)
    paired = paired.select("filter", "id", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    paired = stage(paired, "caps-paired")
    n_lots = paired.count() // LOT_ROWS + shuffle_partitions(spark)
    paired = paired.withColumn("lot", F.pmod(F.xxhash64("filter", "one", "two"), F.lit(n_lots))).join(classes.select("id", "rows", "vector").join(lists, "id"), "id")
    found = paired.groupBy("lot").applyInArrow(lambda t: compare_lot(t, cosine), "id long, n long, a long, b long")
    found = stage(found, "caps-links")
    counts = found.where("id is not null").groupBy("id").agg(F.sum("n").alias("others"))
    components = connected_components(found.where("a is not null").select("a", "b"), "caps-cc")
    known = classes.select("left", "right", "rows", "id").join(counts, "id", "left").join(components, "id", "left")
    known = known.select("left", "right", "rows", F.coalesce("others", F.lit(0)).alias("others"), F.coalesce("component", "id").alias("component"))
    out = rows.select("vec_id", "left", "right", F.col("vector").isNotNull().alias("valid")).join(known, ["left", "right"], "left")
    n_links = F.when(F.col("valid"), F.col("rows") - 1 + F.col("others")).otherwise(F.lit(0)).cast("long")
    component = F.when(F.col("vec_id").isNull(), F.lit(None).cast("long")).when(F.col("valid"), F.col("component")).otherwise(F.col("vec_id"))
    out = out.select("vec_id", n_links.alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)))
