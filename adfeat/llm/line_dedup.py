"""Line dedup by a sharded minimal perfect hash (operator 2).

The distinct line keys are hashed to 128 bits and dealt over shards.  Each shard builds a
minimal perfect hash over its keys (levels of bit arrays, ranked by running popcounts) that
indexes three compact arrays: a 32-bit fingerprint, the number of documents and the largest
document id.  Documents are dealt over buckets; a bucket asks each shard about its distinct
keys, the shard's arrays answer, and only answers that drop lines come back.  Lines are
never joined with lines, a key in a third of the documents costs one question per bucket,
and the text is shuffled once.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfeat.llm.common import shuffle_partitions, use_session
from adfeat.sources.staging import stage

#: Distinct keys that a shard is sized for, and text bytes that a bucket is sized for.
SHARD_KEYS, BUCKET_BYTES = 1 << 15, 8 << 20

#: Questions that one group asks a shard; a shard that is asked more answers in several groups.
QUESTIONS = 4 * SHARD_KEYS

_STRIP = b" \t\n\x0b\x0c\r"
_U = np.uint64
_NO_ID = -(2**63)


def line_key(line: bytes, least: int = 20) -> bytes | None:
    """The key of a line, or None if it is shorter than ``least`` code points."""
    key = line.strip(_STRIP).lower()  # bytes.lower() changes A-Z alone
    if len(key) < least or (len(key) < 4 * least and len(key.decode()) < least):
        return None
    return key


def _hashes(key: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(key)
    a, b = h >> 64, h & (2**64 - 1)
    return a - (a >> 63 << 64), b - (b >> 63 << 64)


def _mix(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    x = a + b * _U(0x9E3779B97F4A7C15) + _U((level * 0xD1B54A32D192ED03 + 1) & (2**64 - 1))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class PerfectHash:
    """Minimal perfect hash of distinct (a, b) pairs of 64-bit numbers onto 0 .. n - 1.

    A key sits in the first level whose slot it shares with no other remaining key; its place
    is the number of set bits before that slot.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, gamma: float = 1.5):
        a, b = a.view(_U), b.view(_U)
        levels, sizes = [], []
        while len(a):
            m = max(64, int(gamma * len(a)))
            at = (_mix(a, b, len(levels)) % _U(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            levels.append(np.packbits(alone))
            sizes.append(m)
            left = ~alone[at]
            a, b = a[left], b[left]
        self.__setstate__((levels, sizes))

    def __getstate__(self):
        return self.levels, self.sizes

    def __setstate__(self, state):
        self.levels, self.sizes = state
        self.bits = [np.unpackbits(x, count=m).astype(bool) for x, m in zip(self.levels, self.sizes, strict=True)]
        self.ranks, base = [], 0
        for x in self.bits:
            self.ranks.append(np.cumsum(x, dtype=np.int64) - 1 + base)
            base += int(x.sum())
        self.n = base

    def index(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The place of each pair; for a pair that is not in the set, -1 or any place."""
        a, b = a.view(_U), b.view(_U)
        out, left = np.full(len(a), -1, np.int64), np.arange(len(a))
        for i, x in enumerate(self.bits):
            at = (_mix(a[left], b[left], i) % _U(self.sizes[i])).astype(np.int64)
            hit = x[at]
            out[left[hit]] = self.ranks[i][at[hit]]
            left = left[~hit]
        return out


def _fingerprint(b: np.ndarray) -> np.ndarray:
    return (b.view(_U) >> _U(32)).astype(np.uint32)


def build_shard(a: np.ndarray, b: np.ndarray, docs: np.ndarray, largest: np.ndarray) -> bytes:
    """Index of one shard from (key, documents, largest id) rows; a key may come in several rows."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, np.int64)
    a, b = a[first], b[first]
    docs, largest = np.add.reduceat(docs[order], first), np.maximum.reduceat(largest[order], first)
    table = PerfectHash(a, b)
    place = table.index(a, b)
    prints, counts, ids = np.zeros(table.n, np.uint32), np.zeros(table.n, np.int64), np.zeros(table.n, np.int64)
    prints[place], counts[place], ids[place] = _fingerprint(b), docs, largest
    return pickle.dumps((table, prints, np.minimum(counts, 2**32 - 1).astype(np.uint32), ids), protocol=5)


def probe_shard(blob: bytes, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents, largest id) of each key; 0 documents for a key whose fingerprint is not there."""
    table, prints, counts, ids = pickle.loads(blob)
    place = table.index(a, b)
    known = place >= 0
    known[known] = prints[place[known]] == _fingerprint(b[known])
    n, largest = np.zeros(len(a), np.int64), np.full(len(a), _NO_ID)
    n[known], largest[known] = counts[place[known]], ids[place[known]]
    return n, largest


def _i64(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode().split(b"\n")


def dedup_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, id_col: str = "doc_id", text_col: str = "text", questions: int = QUESTIONS) -> DataFrame:
    """``docs`` without the repeated lines, plus n_lines (before) and n_dropped.

    A line's key is the line stripped of space and tab to carriage return, A-Z in lower case.
    Keys of ``min_chars`` code points or more in ``min_docs`` rows or more lose all their
    lines except in the rows of the largest id holding them.  A null text stays null and
    counts as one empty line; a null id is below all ids; rows that repeat an id count as
    documents of their own; an empty table gives no rows.  All other columns pass through,
    except that one called n_lines or n_dropped is replaced.
    """
    spark = use_session(docs.sparkSession)
    names = docs.columns
    key, text = names.index(id_col), names.index(text_col)
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    size = plain.agg(F.sum(F.octet_length(f"c{text}"))).first()[0] or 0
    n_buckets = max(4 * shuffle_partitions(spark), size // BUCKET_BYTES + 1)
    doc_id = F.coalesce(F.col(f"c{key}").cast("long"), F.lit(_NO_ID))
    bucket = F.pmod(F.xxhash64(doc_id, f"c{text}"), F.lit(n_buckets)).cast("long")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple[int, int, int, int]] = []
            for in_bucket, d, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for k in {k for x in _lines(t) if (k := line_key(x, min_chars)) is not None}:
                    out.append((in_bucket, d, *_hashes(k)))
            cols = np.array(out, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(cols[:, i]) for i in range(4)], names=["bucket", "largest", "a", "b"])

    found = plain.select(bucket.alias("bucket"), doc_id.alias("d"), F.col(f"c{text}").alias("t")).mapInArrow(keys, "bucket long, largest long, a long, b long")
    cells = stage(found.groupBy("bucket", "a", "b").agg(F.count("*").alias("docs"), F.max("largest").alias("largest")), "line-cells")
    n_shards = cells.count() // SHARD_KEYS + 4 * shuffle_partitions(spark)
    shard = F.pmod("a", F.lit(n_shards)).cast("long").alias("shard")

    def build(t: pa.Table) -> pa.Table:
        blob = build_shard(_i64(t, "a"), _i64(t, "b"), _i64(t, "docs"), _i64(t, "largest"))
        parts = int(_i64(t, "asked").sum()) // questions + 1
        return pa.table({"shard": t.column("shard").slice(0, 1), "blob": pa.array([blob], pa.binary()), "parts": pa.array([parts], pa.int64())})

    # one row per key, however many buckets hold it
    once = cells.groupBy("a", "b").agg(F.sum("docs").alias("docs"), F.max("largest").alias("largest"), F.count("*").alias("asked"))
    index = stage(once.withColumn("shard", shard).groupBy("shard").applyInArrow(build, "shard long, blob binary, parts long"), "line-index")

    def probe(questions: pa.Table, shard: pa.Table) -> pa.Table:
        a, b = _i64(questions, "a"), _i64(questions, "b")
        n, largest = probe_shard(shard.column("blob")[0].as_py(), a, b)
        hit = n >= min_docs
        return pa.table({"bucket": _i64(questions, "bucket")[hit], "a": a[hit], "b": b[hit], "largest": largest[hit]})

    # a line in a third of the corpus is a question of every bucket: its shard answers in several groups
    several = index.where("parts > 1").select("shard", "parts")
    asked = cells.select(shard, "bucket", "a", "b").join(several, "shard", "left")
    asked = asked.withColumn("part", F.pmod(F.xxhash64("bucket"), F.coalesce("parts", F.lit(1)))).drop("parts")
    arrays = index.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "blob")
    answers = asked.groupBy("shard", "part").cogroup(arrays.groupBy("shard", "part")).applyInArrow(probe, "bucket long, a long, b long, largest long")

    extra = ["n_lines", "n_dropped"]
    kept = [i for i, n in enumerate(names) if n not in extra]
    schema = T.StructType([T.StructField(f"c{i}", plain.schema[i].dataType) for i in kept] + [T.StructField(n, T.LongType()) for n in extra])

    def drop(group: pa.Table, answer: pa.Table) -> pa.Table:
        stays = {(x, y): z for x, y, z in zip(*(_i64(answer, n).tolist() for n in ("a", "b", "largest")), strict=True)}
        ids, texts = group.column("id").to_pylist(), group.column(f"c{text}").to_pylist()
        n_lines, n_dropped = [], []
        for i, (d, t) in enumerate(zip(ids, texts, strict=True)):
            lines = _lines(t)
            left = []
            for x in lines:
                k = line_key(x, min_chars)
                if k is None or stays.get(_hashes(k), d) == d:
                    left.append(x)
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(left))
            if n_dropped[-1]:
                texts[i] = b"\n".join(left).decode()
        cols = {f"c{i}": pa.array(texts, group.schema.field(f"c{i}").type) if i == text else group.column(f"c{i}") for i in kept}
        return pa.table(cols | {"n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64())})

    dealt = plain.withColumn("bucket", bucket).withColumn("id", doc_id)
    out = dealt.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(drop, schema)
    return out.toDF(*(names[i] for i in kept), *extra)
