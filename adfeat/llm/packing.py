"""Best-fit packing by minimum bin slack (operator 4).

Documents are tokenised in one pass and cut into pieces.  Which lengths share a sequence is
decided on the histogram of piece lengths, which has as many rows as a sequence has places
whatever the size of the corpus: per bin, the longest remaining length is placed and a
subset-sum dynamic programme over the remaining lengths (a bitset in one integer) finds the
combination that fills the rest best; the combination is taken as often as the counts last.
Pieces then take the places of their length by rank, so no task sees a whole length.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adfeat.llm.common import shuffle_partitions, use_session
from adfeat.sources.staging import stage

#: The split pattern of byte-level pre-tokenisation (fixed value).
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Texts of these characters alone are split alike by every regular expression engine.
_PLAIN = re.compile("[^\t\n\r -~\xa1-\xff]")

PIECES = "doc_id long, piece int, start long, length long, ids binary"


#: A run of one kind of character on which the quick route's backtracking could end the worker
#: (it does at some 500,000 blanks); the library takes runs of any length.
LONG_RUN = 50_000
_LONG_RUN = re.compile(rf"\s{{{LONG_RUN}}}|\S{{{LONG_RUN}}}")


class Encoder:
    """Ids as the ``tokenizers`` library gives them without special tokens added.

    Plain texts go through the same vocabulary as merge ranks, which is several times faster;
    texts with other characters, with a special token's string or with a run of ``LONG_RUN``
    characters with or without white space go through the library.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        from adfeat.llm.token_counts import _byte_of

        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.library = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        byte = _byte_of()
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in self.specials}
        self.quick = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __call__(self, text: str) -> list[int]:
        if (text.isascii() or not _PLAIN.search(text)) and not any(s in text for s in self.specials):
            if len(text) < LONG_RUN or not _LONG_RUN.search(text):
                return self.quick(text)
        return self.library.encode(text, add_special_tokens=False).ids


@functools.cache
def _encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids) of every row: its ids and ``end_id``, cut only if longer than ``size``.

    A cut row's first piece is the shorter one.  ids are unsigned little-endian 32-bit numbers.
    A null text is empty (one piece of length 1).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_path)
        for b in batches:
            rows: list[list] = [[], [], [], [], []]
            held = 0
            for d, v in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = np.array(encode(v.as_py() or "") + [end_id], "<u4")
                cuts = [0, *range(len(ids) % size or size, len(ids) + 1, size)]
                for i, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    for col, x in zip(rows, (d, i, s, e - s, ids[s:e].tobytes()), strict=True):
                        col.append(x)
                held += len(ids)
                if held > 1 << 20:
                    yield _pieces(rows)
                    rows, held = [[], [], [], [], []], 0
            yield _pieces(rows)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


def _pieces(rows: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids"])


def fill_bin(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum of at most ``room``, longer lengths first.

    ``lengths`` is ascending.  Bit i of ``reach`` is set if i places can be filled exactly.
    """
    reach, before = 1, []
    mask = (1 << (room + 1)) - 1
    for n in lengths:
        if n > room:
            break
        before.append((n, reach))
        left, step = min(counts[n], room // n), 1
        while left:
            take = min(step, left)
            reach |= (reach << (take * n)) & mask
            left -= take
            step *= 2
    total, out = reach.bit_length() - 1, {}
    for n, was in reversed(before):
        k = min(counts[n], total // n)
        while not was >> (total - k * n) & 1:
            k -= 1
        if k:
            out[n] = k
            total -= k * n
    return out


def minimum_bin_slack(histogram: dict[int, int], size: int = 1024) -> list[tuple[dict[int, int], int]]:
    """(lengths of a bin with their numbers, how many such bins) until the histogram is used up."""
    counts = {n: c for n, c in histogram.items() if c}
    lengths = sorted(counts)
    out = []
    while lengths:
        seed = lengths[-1]
        counts[seed] -= 1
        bin_ = fill_bin(counts, lengths, size - seed)
        counts[seed] += 1
        bin_[seed] = bin_.get(seed, 0) + 1
        times = min(counts[n] // k for n, k in bin_.items())
        for n, k in bin_.items():
            counts[n] -= k * times
        lengths = [n for n in lengths if counts[n]]
        out.append((bin_, times))
    return out


def places(bins: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, numbers per sequence, offset) in order of rank."""
    used: dict[int, int] = {}
    out: dict[int, list] = {}
    sequence = 0
    for bin_, times in bins:
        offset = 0
        for n in sorted(bin_, reverse=True):
            out.setdefault(n, []).append((used.get(n, 0), sequence, bin_[n], offset))
            used[n] = used.get(n, 0) + bin_[n] * times
            offset += n * bin_[n]
        sequence += times
    return {n: np.array(x, np.int64) for n, x in out.items()}


def pack(pieces: DataFrame, size: int = 1024) -> DataFrame:
    """``pieces`` (any columns, with a long ``length`` from 1 to ``size``) plus sequence_id and offset.

    As few sequences as minimum bin slack finds; offsets have no gap.  The rank of a piece
    among those of its length is a running count over buckets of rows plus its place in the
    bucket.  Repeated rows are packed each; no rows give no sequences.  ``pieces`` is read
    three times, so it should be a written table.
    """
    spark = use_session(pieces.sparkSession)
    spread = F.xxhash64(*(c for c in pieces.columns if c != "length"))
    n_buckets = max(shuffle_partitions(spark), 64)
    rows = pieces.withColumn("_at", spread).withColumn("_bucket", F.pmod("_at", F.lit(n_buckets)))
    cells = stage(rows.groupBy("length", "_bucket").count(), "pack-cells")
    histogram = {int(r[0]): int(r[1]) for r in cells.groupBy("length").agg(F.sum("count")).collect()}  # at most size rows
    if any(not 0 < n <= size for n in histogram):
        raise ValueError(f"a piece must have 1 to {size} tokens")
    plan = places(minimum_bin_slack(histogram, size))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("length", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    # A row per bucket with a start for each length (at most size of them) keeps the join small.
    starts = starts.groupBy("_bucket").agg(F.map_from_entries(F.collect_list(F.struct("length", "_start"))).alias("_starts"))
    inside = Window.partitionBy("_bucket", "length").orderBy("_at", *(c for c in pieces.columns if c != "length"))
    ranked = rows.withColumn("_rank", F.row_number().over(inside)).join(starts, "_bucket")
    ranked = ranked.select(*pieces.columns, (F.col("_rank") - 1 + F.col("_starts")[F.col("length")]).alias("_rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            sequence, offset = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            for x in np.unique(n):
                own = n == x
                first, base, many, off = plan[int(x)].T
                i = np.searchsorted(first, rank[own], "right") - 1
                q = rank[own] - first[i]
                sequence[own], offset[own] = base[i] + q // many[i], off[i] + q % many[i] * x
            keep = [i for i, c in enumerate(b.schema.names) if c != "_rank"]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), pa.array(sequence), pa.array(offset)], names=[*(b.schema.names[i] for i in keep), "sequence_id", "offset"])

    from pyspark.sql import types as T

    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece of every row's whole text.

    ids_crc32 is the CRC-32 of the piece's ids as unsigned little-endian 32-bit numbers.
    """
    pieces = token_pieces(docs, tokenizer_path, size, end_id, id_col, text_col)
    narrow = stage(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pack-pieces")
    return pack(narrow, size)


def sequences(docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sequence_id, ids) of the packed sequences themselves; ids are array<int>."""
    pieces = stage(token_pieces(docs, tokenizer_path, size, end_id, id_col, text_col), "pack-tokens")
    packed = pack(pieces, size)

    def join(t: pa.Table) -> pa.Table:
        parts = sorted(zip(t.column("offset").to_pylist(), t.column("ids").to_pylist(), strict=True))
        ids = np.frombuffer(b"".join(p for _, p in parts), "<u4").astype(np.int32)
        return pa.table({"sequence_id": t.column("sequence_id").slice(0, 1), "ids": pa.array([ids], pa.list_(pa.int32()))})

    return packed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(join, "sequence_id long, ids array<int>")
