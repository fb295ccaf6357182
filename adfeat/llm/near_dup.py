"""MinHash near-dedup by an LSH forest (operator 6).

Every text becomes its set of word shingles and a MinHash signature; texts with equal sets
are one class, and only one text of a class goes on.  The forest is a number of orders, each
sorting the classes by its own run of signature values.  Classes whose first values agree
form a region; in it the longest-common-prefix neighbours, the rows around a class in the
order, are its candidates, and a region larger than a block is read at the depth where its
parts fit one.  Among the neighbours of a block the signatures pick the candidates to
confirm: all similar pairs of a small region, else each class's most similar neighbours, so
the number of pairs grows with the classes and not with the square of a group.  Candidates
are confirmed on the full sets, first the best one of each class, then every other one whose
ends are not connected yet.  Last, the orders are read once more for the classes that are
still apart: every similar pair of a block whose ends lie in different components is
confirmed, so a class whose one link hides among many almost-links of a large group is found.

A region that is larger than a block's overlap may have pairs that meet in no block.  Its
classes are joined once more by an exact route: two sets that are linked share one of their
rarest shingles (a prefix filter), whatever their places in the orders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfeat.llm.common import IdFilter, chunks, connected_components, shuffle_partitions, use_session, utf8
from adfeat.llm.words import shingle_hashes, word_hashes
from adfeat.sources.staging import stage

#: Orders of the forest, signature values of an order, values that two classes must share to meet.
#: At similarity 0.75, a pair shares no region with probability (1 - 0.75 ** 3) ** 20 = 2e-5.
TREES, DEPTH, LEAST_DEPTH = 20, 6, 3
N_VALUES, TREE_BITS = TREES * DEPTH, 31

#: Rows of an order that are compared with each other, and of a region whose similar pairs are all kept.
BLOCK, SMALL_REGION = 512, 16

#: Rows of a region up to which some block holds it whole: blocks begin at each multiple of it.
WHOLE_REGION = BLOCK // 2

#: Sets of a shingle's short prefixes that one task compares with the long ones.
POSTINGS = 1000

#: Share of equal signature values below which a pair is not confirmed: 5 deviations under 0.75;
#: 1.8 in the last reading, which has every pair of a block.
LEAST_ESTIMATE, LAST_ESTIMATE = 0.55, 0.68

_RNG = np.random.Generator(np.random.PCG64(6))
_FACTORS = _RNG.integers(0, 2**63, N_VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TEXT = 1 << 18


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    return shingle_hashes(*word_hashes(data, offsets), width)


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash values (rows, N_VALUES) of rows with one hash at least."""
    out = np.empty((len(bounds) - 1, N_VALUES), np.uint32)
    x = np.empty_like(hashes)
    for i, f in enumerate(_FACTORS):
        np.multiply(hashes, f, out=x)
        out[:, i] = np.minimum.reduceat(x, bounds[:-1]) >> np.uint64(32)
    return out


def _sketch(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = utf8(b.column(1))
        for i, j in chunks(offsets, _TEXT):
            own = data[offsets[i] : offsets[j]]
            h, at = shingle_sets(own, offsets[i : j + 1] - offsets[i], width)
            sizes, left, right = np.zeros(j - i, np.int64), np.zeros(j - i, np.int64), np.zeros(j - i, np.int64)
            filled = np.flatnonzero(np.diff(at))
            signs = np.zeros((j - i, N_VALUES), np.uint32)
            if len(filled):
                signs[filled] = signatures(h, np.append(at[filled], at[-1]))
            for r in filled:
                distinct = np.unique(h[at[r] : at[r + 1]])
                sizes[r] = len(distinct)
                left[r], right[r] = np.frombuffer(xxhash.xxh3_128_digest(distinct.tobytes()), np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(i, j - i), pa.array(sizes), pa.array(left), pa.array(right), pa.array([s.tobytes() if n else None for s, n in zip(signs, sizes, strict=True)], pa.binary())],
                names=["doc_id", "n_shingles", "left", "right", "sign"],
            )


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(region, id): a hash of the first LEAST_DEPTH values of a tree's order, with the tree in its last bits."""
    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        signs = _matrix(b.column(1))
        n = len(ids)
        heads = np.ascontiguousarray(signs.reshape(n, TREES, DEPTH)[:, :, :LEAST_DEPTH]).reshape(n * TREES, LEAST_DEPTH)
        h = np.zeros(len(heads), np.uint64)
        for k in range(LEAST_DEPTH):
            h = (h ^ heads[:, k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        h = (h & ~np.uint64(TREE_BITS)) | np.tile(np.arange(TREES, dtype=np.uint64), n)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.repeat(ids, TREES))], names=["region", "id"])


def _matrix(signs: pa.Array) -> np.ndarray:
    return np.frombuffer(utf8(signs)[0].tobytes(), np.uint32).reshape(-1, N_VALUES)


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the orders: (tree, key, id, small, n): key sorts as the tree's values do, small has a byte of every value, n are the region's rows."""
    for b in batches:
        tree = b.column(0).to_numpy(zero_copy_only=False) & TREE_BITS
        signs = _matrix(b.column(2)).reshape(-1, TREES, DEPTH)
        keys = signs[np.arange(len(tree)), tree].astype(">u4")
        small = signs.reshape(-1, N_VALUES).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array(tree.astype(np.int32)), pa.array([k.tobytes() for k in keys], pa.binary()), b.column(1), pa.array([s.tobytes() for s in small], pa.binary()), b.column(3)], names=["tree", "key", "id", "small", "n"])


def neighbours(tree: np.ndarray, keys: np.ndarray, ids: np.ndarray, small: np.ndarray, component: np.ndarray | None = None, seen: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidate pairs (a < b) and their equal values among the sorted rows of a block.

    With ``component``, all similar pairs of a region whose ends lie in different components;
    the first ``seen`` rows have been compared with each other before.
    """
    n = len(ids)
    same = np.r_[False, (tree[1:] == tree[:-1]) & (keys[1:, :LEAST_DEPTH] == keys[:-1, :LEAST_DEPTH]).all(axis=1)]
    first = np.flatnonzero(~same)
    out: list[np.ndarray] = []
    for lo, hi in zip(first, np.append(first[1:], n), strict=True):
        m = hi - lo
        if m < 2:
            continue
        own, s = ids[lo:hi], small[lo:hi]
        if component is not None and (component[lo:hi] == component[lo]).all():
            continue
        equal = np.empty((m, m), np.int16)
        for k in range(m):
            equal[k] = (s == s[k]).sum(axis=1)
        np.fill_diagonal(equal, -1)
        equal[own[:, None] == own] = -1
        if component is not None:
            equal[component[lo:hi, None] == component[lo:hi]] = -1
            equal[: max(0, seen - lo), : max(0, seen - lo)] = -1
            i, j = np.nonzero(np.triu(equal >= LAST_ESTIMATE * N_VALUES))
        elif m <= SMALL_REGION:
            i, j = np.nonzero(equal >= LEAST_ESTIMATE * N_VALUES)
        else:
            i = np.repeat(np.arange(m), 3)
            j = np.column_stack([np.argpartition(-equal, 1, axis=1)[:, :2], np.full(m, own.argmin())]).ravel()
            near = equal[i, j] >= LEAST_ESTIMATE * N_VALUES
            i, j = i[near], j[near]
        out.append(np.column_stack([np.minimum(own[i], own[j]), np.maximum(own[i], own[j]), equal[i, j]]))
    pairs = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 3), np.int64)
    return pairs[:, 0], pairs[:, 1], pairs[:, 2]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a sorted partition; the second half of a block is the first half of the next.

    With a column ``component``, a row per class with the list of its partners.
    """
    held: pa.Table | None = None
    seen = 0
    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t]).combine_chunks()
        while len(held) >= BLOCK:
            yield _pairs(held.slice(0, BLOCK), seen)
            held, seen = held.slice(BLOCK // 2), BLOCK // 2
    if held is not None:
        yield _pairs(held, seen)


def _pairs(t: pa.Table, seen: int) -> pa.RecordBatch:
    t = t.combine_chunks()
    cols = {n: t.column(n).chunk(0) if t.column(n).num_chunks else pa.array([], t.schema.field(n).type) for n in t.column_names}
    keys = np.frombuffer(utf8(cols["key"])[0].tobytes(), ">u4").reshape(-1, DEPTH)
    small = np.frombuffer(utf8(cols["small"])[0].tobytes(), np.uint8).reshape(-1, N_VALUES)
    component = cols["component"].to_numpy(zero_copy_only=False) if "component" in cols else None
    a, b, n = neighbours(cols["tree"].to_numpy(zero_copy_only=False), keys, cols["id"].to_numpy(zero_copy_only=False), small, component, seen)
    if component is not None:
        first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else a  # the pairs are sorted
        others = pa.ListArray.from_arrays(pa.array(np.append(first, len(a)), pa.int32()), pa.array(b, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(a[first], pa.int64()), others], names=["a", "others"])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "equal"])


def _sets(batches: Iterator[pa.RecordBatch], width: int, wanted: IdFilter | None) -> Iterator[pa.RecordBatch]:
    """(id, set) of the rows that ``wanted`` may have; a few others come along and meet no pair."""
    for b in batches:
        if wanted is not None:
            b = b.filter(pa.array(wanted.may_have(b.column(0).to_numpy(zero_copy_only=False))))
        data, offsets = utf8(b.column(1))
        for i, j in chunks(offsets, _TEXT):
            h, at = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
            sets = [np.unique(h[at[r] : at[r + 1]]).tobytes() for r in range(j - i)]
            yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(sets, pa.binary())], names=["id", "set"])


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: int = 75) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= threshold * union."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if 100 * min(len(x), len(y)) < threshold * max(len(x), len(y)):
                    keep.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = pairs.select("a", "b").join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
    both = left.join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(check, "a long, b long")


def _sorted_orders(rows: DataFrame) -> DataFrame:
    """The orders' rows, sorted over all partitions.

    A region that a block can hold is in one partition; a larger one is spread over several by
    its whole key and id.
    """
    head, large = F.substring("key", 1, 4 * LEAST_DEPTH), F.col("n") > WHOLE_REGION
    spread = [F.when(large, F.col("key")), F.when(large, F.col("id"))]
    return rows.repartitionByRange(shuffle_partitions(rows.sparkSession), "tree", head, *spread).sortWithinPartitions("tree", "key", "id")


class RareFirst:
    """An order of all shingles, rare ones first: by the count of a hash bucket, then by the hash.

    The counts have a fixed size (4 MB) whatever the number of shingles.  Buckets shared by
    chance cost time only, as any order of the shingles gives the same links.
    """

    BITS = 20

    def __init__(self, sets: DataFrame):
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = np.zeros(1 << RareFirst.BITS, np.int64)
            for b in batches:
                n += np.bincount(RareFirst.bucket(np.frombuffer(utf8(b.column(0))[0].tobytes(), np.uint64)), minlength=len(n))
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["bucket", "n"])

        rows = sets.select("set").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
        self.counts = np.zeros(1 << RareFirst.BITS, np.int32)  # at most 1,048,576 buckets come to the driver
        self.counts[rows.column("bucket").to_numpy()] = np.minimum(rows.column("n").to_numpy(), 2**31 - 1)

    @staticmethod
    def bucket(hashes: np.ndarray) -> np.ndarray:
        return ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - RareFirst.BITS)).astype(np.int64)

    def rarest(self, hashes: np.ndarray, most: int) -> np.ndarray:
        return hashes[np.lexsort((hashes, self.counts[self.bucket(hashes)]))[:most]]


def _postings(batches: Iterator[pa.RecordBatch], order: RareFirst, threshold: int) -> Iterator[pa.RecordBatch]:
    """(shingle, id, component, n, at) of the rarest shingles of each set (id, component, set).

    The first shingle in the order that linked sets share has so many after it in both of
    them as they must share, so it is among the first n - ceil(threshold * n / 100) + 1.
    """
    for b in batches:
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in b.column(2)]
        n = np.array([len(s) for s in sets], np.int64)
        most = n + (-threshold * n) // 100 + 1
        found = [order.rarest(s, k) for s, k in zip(sets, most, strict=True)]
        row = np.repeat(np.arange(len(n)), [len(f) for f in found])
        own = b.select(["id", "component"]).take(pa.array(row))
        at = np.concatenate([np.arange(len(f)) for f in found]) if found else row
        shingle = np.concatenate(found).view(np.int64) if found else row
        yield pa.RecordBatch.from_arrays([pa.array(shingle, pa.int64()), *own.columns, pa.array(n[row], pa.int64()), pa.array(at, pa.int64())], names=["shingle", "id", "component", "n", "at"])


def sharing_rare(sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a < b) of the sets (id, component, set), among them all that are linked and lie in different components.

    A shingle that only one component has makes no pair.  A set is paired with those not
    smaller that share a shingle of its shorter prefix, if enough is left after it in both.
    """
    order = RareFirst(sets)
    posts = stage(sets.select("id", "component", "set").mapInArrow(lambda it: _postings(it, order, threshold), "shingle long, id long, component long, n long, at long"), "near-postings")
    short = (100 + threshold) * (F.col("n") - F.col("at")) >= 2 * threshold * F.col("n")
    met = posts.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count_if(short).alias("short"))
    met = met.where("lo <> hi and short > 0").select("shingle", F.ceil(F.col("short") / POSTINGS).cast("int").alias("parts"))
    posts = posts.join(met, "shingle")
    side = lambda df, c: df.select("shingle", "part", *[F.col(x).alias(f"{x}_{c}") for x in ("id", "component", "n", "at")])
    x = side(posts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))), "x")
    y = side(posts.where(short).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")), "y")
    left = F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y"))
    pairs = x.join(y, ["shingle", "part"]).where("component_x <> component_y and (n_y < n_x or n_y = n_x and id_y < id_x)")
    pairs = pairs.where((100 + threshold) * left >= threshold * (F.col("n_x") + F.col("n_y")))
    return pairs.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, threshold: int = 75, id_col: str = "doc_id", text_col: str = "text", filter_ids: int = IdFilter.MOST) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    A row's set has the distinct ``width``-word shingles of its whole text, A-Z in lower case;
    a text with fewer words has its whole sequence as the one element, a text without words
    (or null) the empty set, which is linked with nothing.  Rows are linked if 100 *
    intersection >= threshold * union.  component_id is the smallest id reachable, kept tells
    whether it is the row's own.  Rows that repeat an id are one vertex, linked by any of their
    texts; a row with a null id gets no component and is kept.  An empty table gives no rows.
    """
    spark = use_session(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = stage(source.mapInArrow(lambda it: _sketch(it, width), "doc_id long, n_shingles long, left long, right long, sign binary"), "near-sketch")
    sets_of = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = stage(sets_of.groupBy("left", "right").agg(F.min("doc_id").alias("id"), F.count("*").alias("rows"), F.min("sign").alias("sign")), "near-classes")

    regions = classes.select("id", "sign").mapInArrow(_regions, "region long, id long")
    shared = regions.groupBy("region").agg(F.count("*").alias("n")).where("n > 1")
    active = regions.join(shared, "region")
    rows = stage(active.join(classes.select("id", "sign"), "id").select("region", "id", "sign", "n").mapInArrow(_orders, "tree int, key binary, id long, small binary, n long"), "near-orders")
    pairs = _sorted_orders(rows).mapInArrow(_candidates, "a long, b long, equal long")
    pairs = stage(pairs.groupBy("a", "b").agg(F.max("equal").alias("equal")), "near-pairs")

    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    crowded = stage(rows.where(F.col("n") > WHOLE_REGION).select("id").distinct(), "near-crowded")
    ids = stage(ends.unionByName(crowded).distinct(), "near-ids")
    texts = source.where("doc_id is not null").select(F.col("doc_id").alias("id"), "text")
    if ids.count() <= filter_ids:  # spares a shuffle of all texts for the few that are in a pair
        wanted = IdFilter(ids)
    else:  # the filter would be full, and let every text through
        wanted, texts = None, texts.join(ids, "id", "left_semi")
    sets = stage(texts.mapInArrow(lambda it: _sets(it, width, wanted), "id long, set binary"), "near-sets")
    either = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "equal"))
    best = either.groupBy(F.col("a").alias("x")).agg(F.max_by("b", F.struct("equal", -F.col("b"))).alias("y"))
    best = best.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    links = stage(confirmed(best, sets, threshold), "near-links")
    found = connected_components(links, "near-cc1")
    component = lambda c: F.coalesce(F.col(f"component_{c}"), F.col(c))
    named = lambda c: found.select(F.col("id").alias(c), F.col("component").alias(f"component_{c}"))
    rest = pairs.join(best.withColumn("done", F.lit(True)), ["a", "b"], "left_anti")
    rest = rest.join(named("a"), "a", "left").join(named("b"), "b", "left").where(component("a") != component("b"))
    rest = stage(confirmed(rest, sets, threshold), "near-rest")
    stars = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
    found = connected_components(stars.unionByName(rest), "near-cc2")

    apart = rows.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    lists = _sorted_orders(apart).mapInArrow(_candidates, "a long, others array<long>")
    lists = lists.groupBy("a").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))
    last = lists.select("a", F.explode("others").alias("b")).join(pairs.select("a", "b"), ["a", "b"], "left_anti")
    last = stage(last, "near-last")
    stars = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
    found = connected_components(stars.unionByName(stage(confirmed(last, sets, threshold), "near-late")), "near-cc3")

    among = sets.join(crowded, "id").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    exact = sharing_rare(among, threshold).join(pairs.select("a", "b").unionByName(last.select("a", "b")), ["a", "b"], "left_anti")
    exact = stage(exact, "near-exact")
    stars = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
    found = connected_components(stars.unionByName(stage(confirmed(exact, sets, threshold), "near-exact-links")), "near-cc4")

    member = classes.where("rows > 1").select("left", "right", F.col("id").alias("class"))
    out = sketch.drop("sign").join(member, ["left", "right"], "left")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("class", "doc_id")).otherwise(F.col("doc_id"))
    out = out.withColumn("class", own).join(found.withColumnRenamed("id", "class"), "class", "left")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))
