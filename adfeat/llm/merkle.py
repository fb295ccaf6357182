"""Merkle manifest of a dataset by descent in a content-addressed DAG (operator 13).

Every row is a leaf.  The leaves of a source, by id, are the bottom of a tree in which every
``FAN`` consecutive nodes become one; the roots of the sources, by source, are the bottom of a
last tree.  A node is kept under its digest: a record maps it to its children.  The records of
``LEVELS`` levels below a node form one segment, stored under that node's digest, so a tree of
a billion leaves is four segments deep.

Proofs come out of the records alone.  A request is a leaf's place; its digits in base ``FAN``
lead from the root down, and at every node the children that are not selected are collected.
Requests below one node share a row, and a segment's requests (at most ``FAN ** LEVELS``) are
answered together.  What a request has collected, from the root down, is reversed into the
path from the leaf up.

Places are ranks of a distributed sort: no task holds a source, and nothing but one digest
(the root) reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adfeat.llm.common import shuffle_partitions, use_session
from adfeat.sources.staging import stage

#: Children of a node, and levels of a segment.
FAN, LEVELS = 3, 6

#: Rows that one task of the ranking sort is sized for.
SORT_ROWS = 200_000

#: The tree of the sources' roots; the sources' own trees are numbered from 0.
TOP = -1

STEP = "struct<siblings: array<string>, at: int>"


def H(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated texts."""
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value (integers in decimal)."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return H(*(encoded(v) for v in values))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf digest leads to with its proof (steps from the leaf up)."""

    def up(digest: Column, step: Column) -> Column:
        left = F.array_join(F.slice(step["siblings"], F.lit(1), step["at"]), "")
        right = F.array_join(F.slice(step["siblings"], step["at"] + 1, F.size(step["siblings"])), "")
        return H(left, digest, right)

    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """H of all siblings of a proof, from the leaf's level up, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(proof, lambda s: s["siblings"])), ""), 256)


def ranked(rows: DataFrame, tree: list[str], order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """(rows sorted over partitions, one head per tree and partition).

    A row's place in its tree is ``_at - first + before`` of its head; ``size`` is the tree's
    rows.  The rows are sorted by a range partitioning on everything in ``tree`` and ``order``,
    so a tree of any size lies in as many partitions as it needs, and only the heads (as many
    as trees and partitions) are summed up in order.
    """
    spark = rows.sparkSession
    parts = max(shuffle_partitions(spark), rows.count() // SORT_ROWS + 1)
    by = [*tree, *order]
    put = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    put = stage(put.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), name)
    heads = put.groupBy(*tree, "_part").agg(F.min("_at").alias("first"), F.count("*").alias("_n"))
    w = Window.partitionBy(*tree)
    so_far = F.sum("_n").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return put, heads.select(*tree, "_part", "first", (so_far - F.col("_n")).alias("before"), F.sum("_n").over(w).alias("size"))


def _joined(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Inner join in which null equals null; the columns of ``a``, then the others of ``b``."""
    b = b.withColumnsRenamed({c: f"_r_{c}" for c in on})
    cond = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return a.join(b, cond).drop(*(f"_r_{c}" for c in on))


def segment(digests: list[str], levels: int | None) -> tuple[str, int, list[str], list[list[str]]]:
    """(root, height, nodes, their children) over consecutive digests.

    ``levels`` levels are raised whatever the number (a part of a larger tree), or with None
    until one node is left.
    """
    nodes: list[str] = []
    children: list[list[str]] = []
    height = 0
    while len(digests) > 1 if levels is None else height < levels:
        runs = [digests[i : i + FAN] for i in range(0, len(digests), FAN)]
        digests = [hashlib.sha256("".join(r).encode()).hexdigest() for r in runs]
        nodes += digests
        children += runs
        height += 1
    return digests[0], height, nodes, children


def descend(digest: str, children: dict[str, list[str]], place: int, height: int) -> tuple[str, list[tuple[list[str], int]]]:
    """(node at ``place``, steps from the root down): every digit of the place selects a child."""
    steps = []
    for level in range(height - 1, -1, -1):
        below, at = children[digest], place // FAN**level % FAN
        steps.append((below[:at] + below[at + 1 :], at))
        digest = below[at]
    return digest, steps


_SEGMENT = "tree long, place long, size long, digest string, height int, nodes array<string>, children array<array<string>>"


def _build(t: pa.Table, levels: int) -> pa.Table:
    """One segment from its nodes (tree, place, size, digest)."""
    most = FAN**levels
    t = t.sort_by("place")
    place, size = t.column("place")[0].as_py(), t.column("size")[0].as_py()
    root, height, nodes, children = segment(t.column("digest").to_pylist(), levels if size > most else None)
    row = {"tree": t.column("tree")[0].as_py(), "place": place // most, "size": -(-size // most), "digest": root, "height": height, "nodes": nodes, "children": children}
    kind = pa.schema([("tree", pa.int64()), ("place", pa.int64()), ("size", pa.int64()), ("digest", pa.string()), ("height", pa.int32()), ("nodes", pa.list_(pa.string())), ("children", pa.list_(pa.list_(pa.string())))])
    return pa.Table.from_pylist([row], kind)


def _over(levels: int) -> Column:
    """The segment that a place is in."""
    return F.call_function("div", F.col("place"), F.lit(FAN**levels))


def raised(nodes: DataFrame, name: str, levels: int) -> tuple[DataFrame, list[DataFrame]]:
    """((tree, digest) of all roots, segments from the bottom up) of trees given as (tree, place, size, digest)."""
    most = nodes.agg(F.max("size")).first()[0] or 0
    done, layers = nodes.where("size = 1").select("tree", "digest"), []
    while most > 1:
        part = nodes.where("size > 1").groupBy("tree", _over(levels).alias("_segment"))
        layers.append(stage(part.applyInArrow(lambda _, t: _build(t, levels), _SEGMENT), f"{name}-{len(layers)}"))
        nodes = layers[-1].select("tree", "place", "size", "digest")
        done = done.unionByName(nodes.where("size = 1").select("tree", "digest"))
        most = -(-most // FAN**levels)
    return done, layers


_ANSWER = f"tree long, top string, places array<long>, digests array<string>, paths array<array<{STEP}>>"
_STEPS = pa.list_(pa.struct([("siblings", pa.list_(pa.string())), ("at", pa.int32())]))


def _answer(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    """Requests of a segment (tree, top, places, path, digest, height, nodes, children): node and path of every place."""
    for b in batches:
        trees, places, digests, paths = [], [], [], []
        for r in b.to_pylist():
            children = dict(zip(r["nodes"], r["children"], strict=True))
            found = [descend(r["digest"], children, p % FAN**levels, r["height"]) for p in r["places"]]
            trees.append(r["tree"])
            places.append(r["places"])
            digests.append([d for d, _ in found])
            paths.append([r["path"] + [{"siblings": s, "at": at} for s, at in steps] for _, steps in found])
        cols = [pa.array(trees, pa.int64()), b.column("top"), pa.array(places, pa.list_(pa.int64())), pa.array(digests, pa.list_(pa.string())), pa.array(paths, pa.list_(_STEPS))]
        yield pa.RecordBatch.from_arrays(cols, names=["tree", "top", "places", "digests", "paths"])


@dataclass(frozen=True)
class Manifest:
    """Trees of a table: ``leaves`` (tree, place, digest, other columns), ``trees`` (tree, source,
    digest = the source's root), the segments of the sources' trees and of the last one, from
    the bottom up, and the root (None for an empty table)."""

    root: str | None
    leaves: DataFrame
    trees: DataFrame
    layers: list[DataFrame]
    top: list[DataFrame]
    levels: int


def build_manifest(docs: DataFrame, columns: list[str], id_col: str = "doc_id", source_col: str = "source", carry: dict[str, Column] | None = None, levels: int = LEVELS) -> Manifest:
    """Manifest of ``docs`` over ``columns`` (texts or integers), one tree per value of ``source_col``.

    A null source is a source of its own, the first; null ids come first; rows with the same
    source and id are ordered by their digest, so repeated rows are leaves of their own and
    their order does not matter.  Null, empty and very long values are leaves as any (``-``,
    ``0:``, hashed whole).  An empty table has no root and no leaves.  Columns not named here
    are not read; ``carry`` adds columns computed from the row to its leaf, under any names
    but tree, place, digest, size and those that start with ``_``.
    """
    use_session(docs.sparkSession)
    own = [leaf_digest(*(F.col(c) for c in columns)).alias("digest"), F.col(id_col).alias("_id"), F.col(source_col).alias("_source")]
    rows = stage(docs.select(*own, *[v.alias(c) for c, v in (carry or {}).items()], F.monotonically_increasing_id().alias("_row")), "manifest-rows")
    # the row number only spreads rows that are all alike over the partitions
    put, heads = ranked(rows, ["_source"], ["_id", "digest", "_row"], "manifest-leaves")
    heads = stage(heads, "manifest-heads")
    sources, source_heads = ranked(heads.select("_source").distinct(), [], ["_source"], "manifest-sources")
    numbered = _joined(sources, source_heads, ["_part"]).select("_source", (F.col("_at") - F.col("first") + F.col("before")).alias("tree"), F.col("size").alias("_sources"))
    heads = _joined(heads, numbered.select("_source", "tree"), ["_source"])
    leaves = _joined(put, heads, ["_source", "_part"]).withColumn("place", F.col("_at") - F.col("first") + F.col("before"))
    leaves = stage(leaves.select("tree", "place", "size", "digest", *(carry or {})), "manifest-places")
    roots, layers = raised(leaves.select("tree", "place", "size", "digest"), "manifest-records", levels)
    trees = stage(_joined(numbered, roots, ["tree"]), "manifest-trees")
    top_nodes = trees.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("_sources").alias("size"), "digest")
    top_roots, top = raised(top_nodes, "manifest-top", levels)
    root = top_roots.first()
    return Manifest(root["digest"] if root else None, leaves, trees.select("tree", F.col("_source").alias("source"), "digest"), layers, top, levels)


def _descent(start: DataFrame, layers: list[DataFrame], wanted: DataFrame, levels: int) -> DataFrame:
    """(tree, place, top, digest, path) of the wanted (tree, place), from (tree, place = 0, top, digest, path) of the roots.

    One layer of segments at a time, from the top: the places asked below a node are gathered
    (no more than a segment has), and meet the records by the node's digest.
    """
    asked, over = [wanted], _over(levels)
    for _ in layers:
        asked.append(asked[-1].select("tree", over.alias("place")).distinct())
    at = start
    for k in range(len(layers) - 1, -1, -1):
        low = asked[k].groupBy("tree", over.alias("_segment")).agg(F.collect_set("place").alias("places"))
        # a tree that is lower than this layer has its one node at place 0 here already, and waits
        records = layers[k].select(F.col("digest").alias("_digest"), "height", "nodes", "children").dropDuplicates(["_digest"])
        here = _joined(low, at.withColumnRenamed("place", "_segment"), ["tree", "_segment"])
        rows = here.join(records, F.col("digest") == F.col("_digest"), "left")
        met = rows.where("height is not null").select("tree", "top", "places", "path", "digest", "height", "nodes", "children").mapInArrow(lambda b: _answer(b, levels), _ANSWER)
        down = met.select("tree", "top", F.explode(F.arrays_zip("places", "digests", "paths")).alias("x"))
        at = down.select("tree", F.col("x.places").alias("place"), "top", F.col("x.digests").alias("digest"), F.col("x.paths").alias("path"))
        rest = rows.where("height is null").select("tree", F.col("_segment").alias("place"), "top", "digest", "path")
        at = at.unionByName(rest)
    return at


def prove(manifest: Manifest, leaves: DataFrame | None = None) -> DataFrame:
    """``leaves`` (rows of ``manifest.leaves``, all by default) with ``subroot`` and ``proof``.

    ``proof`` is an array of (siblings, at) from the leaf up to the root: the other children
    of the node above, and the leaf's place among them.  It is read off the records by descent
    and does not use the leaf's own digest.
    """
    leaves = manifest.leaves if leaves is None else leaves
    path = F.array().cast(f"array<{STEP}>").alias("path")
    asked = leaves.select("tree").distinct()
    if manifest.top:
        start = asked.sparkSession.createDataFrame([(TOP, 0, manifest.root, manifest.root)], "tree long, place long, top string, digest string")
        asked = asked.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"))
        start = _descent(start.select("*", path), manifest.top, asked, manifest.levels).select(F.col("place").alias("tree"), "digest", "path")
    else:
        start = _joined(manifest.trees.select("tree", "digest"), asked, ["tree"]).select("*", path)
    start = stage(start.select("tree", F.lit(0).cast("long").alias("place"), F.col("digest").alias("top"), "digest", "path"), "manifest-paths")
    found = _descent(start, manifest.layers, leaves.select("tree", "place"), manifest.levels)
    return _joined(leaves, found.select("tree", "place", F.col("top").alias("subroot"), F.reverse("path").alias("proof")), ["tree", "place"])
