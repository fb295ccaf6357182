"""Removal of repeated byte strings by suffix arrays of linear grouping construction (operator 7).

Every string of ``size`` bytes holds an anchor: its leftmost K-byte gram of least hash, which
is the same wherever the string occurs.  Anchors whose gram occurs once in the corpus are
dropped; of the others, each with the bytes around it that a string holding it can reach,
equal surroundings are reduced to their first occurrence natively.  What is left, the
different surroundings of one gram, is compared by a suffix array: each surrounding is spelt
as the classes of its extensions to the left and to the right (one symbol per length at which
surroundings part), the spellings of a bounded lot of grams are sorted by the grouping
construction (``suffix_array.py``), and the longest match with an earlier occurrence gives
the strings to remove.  A gram with more surroundings than a lot may hold is settled string
by string in a native aggregate instead, so no task holds a whole gram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfeat.llm.common import chunks, shuffle_partitions, use_session, utf8
from adfeat.llm.suffix_array import common_prefixes, longest_earlier, suffix_array
from adfeat.llm.words import mix
from adfeat.sources.staging import stage, unstage

#: Bytes of an anchor's gram, surroundings in a lot, and surroundings that one gram may bring to a lot.
K, LOT_ROWS, GRAM_ROWS = 20, 2048, 20_000

_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(7))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = _U(0x9E6C63D0876A9A35)
_INVERSE = _U(pow(0x9E6C63D0876A9A35, -1, 2**64))
_TEXT = 1 << 18
_NO_ID = -(2**63)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    x = np.full(n, base, _U)
    x[:1] = 1
    return np.multiply.accumulate(x)


def anchors(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, row, gram hash) of the anchors of all strings of ``size`` bytes inside rows, in order."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < size:
        return none, none, none
    h, width, power = _BYTE[data], 1, _BASE
    out, have = None, 0
    rest = K
    while rest:  # rolling hash of K bytes by doubling
        if rest & 1:
            out, have = (h, width) if out is None else (out[: len(h) - have] * power + h[have:], have + width)
        rest >>= 1
        if rest:
            h, power, width = h[:-width] * power + h[width:], _U(int(power) ** 2 % 2**64), 2 * width
    gram = mix(out)
    low = max(24, n.bit_length())
    best = (gram >> _U(low) << _U(low)) | np.arange(len(gram), dtype=_U)  # least hash, then leftmost
    window, have, width, out = size - K + 1, 0, 1, None
    while window:  # sliding minimum by doubling
        if window & 1:
            out, have = (best, width) if out is None else (np.minimum(out[: len(best) - have], best[have:]), have + width)
        window >>= 1
        if window:
            best, width = np.minimum(best[:-width], best[width:]), 2 * width
    at = (out & _U((1 << low) - 1)).astype(np.int64)
    inside = np.zeros(n + 1, np.int64)
    sizes = np.diff(offsets)
    full = sizes >= size
    np.add.at(inside, offsets[:-1][full], 1)
    np.add.at(inside, offsets[1:][full] - size + 1, -1)
    at = at[np.cumsum(inside)[: len(at)] > 0]
    at = at[np.r_[True, at[1:] != at[:-1]]] if len(at) else at
    row = np.searchsorted(offsets, at, "right") - 1
    return at, row, gram[at].view(np.int64)


def _surroundings(data: np.ndarray, offsets: np.ndarray, at: np.ndarray, row: np.ndarray, size: int) -> np.ndarray:
    """Hash of the bytes around each anchor that a string holding it can reach."""
    lo, hi = np.maximum(at - (size - K), offsets[row]), np.minimum(at + size, offsets[row + 1])
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=sums[1:])
    back = _powers(_INVERSE, len(data) + 1)
    left = (sums[at] - sums[lo]) * back[lo] + (at - lo).astype(_U) * _U(0xD1B54A32D192ED03)
    right = (sums[hi] - sums[at]) * back[at] + (hi - at).astype(_U) * _U(0x632BE59BD9B4E019)
    return (mix(left) * _U(0x2545F4914F6CDD1D) + mix(right)).view(np.int64)


ANCHORS = ("gram", "around", "doc", "key", "at", "end")


def _find_anchors(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Anchors (gram, around, doc, key, at), and ranges (doc, key, at, end) that repeat one of their own row.

    An anchor whose surroundings an earlier anchor of its row has too is settled here: what it
    reaches goes, and it can be the first occurrence of nothing.
    """
    for b in batches:
        data, offsets = utf8(b.column(2))
        doc, key = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for i, j in chunks(offsets, _TEXT):
            own, at0 = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            at, row, gram = anchors(own, at0, size)
            if not len(at):
                continue
            around = _surroundings(own, at0, at, row, size)
            _, first = np.unique(around.view(_U) + row.astype(_U) * _U(0x9E3779B97F4A7C15), return_index=True)
            if len(first) < len(at):
                again = np.ones(len(at), bool)
                again[first] = False
                r, a = row[again], at[again]
                s, e = np.maximum(a - (size - K), at0[r]), np.minimum(a + size, at0[r + 1])
                run = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (s[1:] > e[:-1])])
                r, s, e = r[run], s[run], np.maximum.reduceat(e, run)
                none = pa.nulls(len(r), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, *(pa.array(x) for x in (doc[i + r], key[i + r], s - at0[r], e - at0[r]))], names=ANCHORS)
                first = np.sort(first)
                at, row, gram, around = at[first], row[first], gram[first], around[first]
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (gram, around, doc[i + row], key[i + row], at - at0[row])), pa.nulls(len(at), pa.int64())], names=ANCHORS)


def _cut(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(gram, doc, key, at, left, right): the bytes before an anchor and from it on."""
    for b in batches:
        rows: list[list] = [[] for _ in range(6)]
        for text, doc, key, wanted in zip(*(c.to_pylist() for c in b.columns), strict=True):
            text = text.encode()
            for x in wanted:
                a = x["at"]
                for col, value in zip(rows, (x["gram"], doc, key, a, text[max(0, a - (size - K)) : a], text[a : a + size]), strict=True):
                    col.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=["gram", "doc", "key", "at", "left", "right"])


def _partings(grams: list[int], texts: list[bytes]) -> tuple[list[int], list[int]]:
    """(order of the rows by gram and text, bytes that each shares with the row before it; -1 at a gram's first)."""
    order = sorted(range(len(texts)), key=lambda i: (grams[i], texts[i]))
    if not order:
        return order, []
    width = max(map(len, texts))
    m = np.frombuffer(b"".join(texts[i].ljust(width, b"\xff") for i in order), np.uint8).reshape(len(order), width)
    size = np.array([len(texts[i]) for i in order])
    gram = np.array([grams[i] for i in order])
    differ = m[1:] != m[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width) if width else np.zeros(len(order) - 1, np.int64)
    shared = np.minimum(shared, np.minimum(size[1:], size[:-1]))
    return order, [-1, *np.where(gram[1:] == gram[:-1], shared, -1).tolist()]


def _spell(grams: list[int], texts: list[bytes], first_symbol: int) -> tuple[list[list[int]], list[list[int]], int]:
    """Per row, the lengths at which rows of its gram part that it shares with another, and a symbol for each.

    The symbol of a length is that of the class of rows that agree so far; symbols are new
    for every gram and length.
    """
    order, shared = _partings(grams, texts)
    n = len(order)
    lengths, symbols = [[] for _ in range(n)], [[] for _ in range(n)]
    symbol, lo = first_symbol, 0
    for hi in range(1, n + 1):
        if hi < n and shared[hi] >= 0:
            continue
        part = shared[lo + 1 : hi]
        for d in sorted({x for x in part if x > 0}):
            if hi - lo <= 32:
                together = [x >= d for x in part] + [False]
                was = False
                for i, now in enumerate(together):
                    if was or now:
                        lengths[order[lo + i]].append(d)
                        symbols[order[lo + i]].append(symbol)
                    if not now:
                        symbol += 1
                    was = now
                continue
            now = np.zeros(hi - lo, bool)
            now[:-1] = np.array(part) >= d
            number = np.full(hi - lo, symbol)
            number[1:] += np.cumsum(~now[:-1])
            own = now.copy()
            own[1:] |= now[:-1]
            for i, x in zip(np.flatnonzero(own).tolist(), number[own].tolist(), strict=True):
                lengths[order[lo + i]].append(d)
                symbols[order[lo + i]].append(x)
            symbol = int(number[-1]) + 1
        lo = hi
    return lengths, symbols, symbol


def _reach(grams: list[int], texts: list[bytes]) -> np.ndarray:
    """Bytes that each row shares at most with another row of its gram."""
    order, shared = _partings(grams, texts)
    s = np.array([*shared, -1])
    out = np.zeros(len(order), np.int64)
    out[order] = np.maximum(0, np.maximum(s[:-1], s[1:]))
    return out


def repeated_in(grams: list[int], ages: list[int], lefts: list[bytes], rights: list[bytes], size: int) -> Iterator[tuple[int, int, int]]:
    """(row, bytes before, bytes from the anchor on) of what earlier rows of the gram have too.

    The strings of ``size`` bytes that a row repeats all hold its anchor, so their union is one
    range.  Rows of one age are the same place.
    """
    lefts = [x[::-1] for x in lefts]
    near = np.flatnonzero(_reach(grams, lefts) + _reach(grams, rights) >= size).tolist()
    grams, ages, lefts, rights = ([x[i] for i in near] for x in (grams, ages, lefts, rights))
    n = len(near)
    if n < 2:
        return
    centre = {g: n + 1 + i for i, g in enumerate(dict.fromkeys(grams))}  # 0 ends the text, 1 .. n end its rows
    left_length, left_symbol, symbol = _spell(grams, lefts, n + 1 + len(centre))
    right_length, right_symbol, symbol = _spell(grams, rights, symbol)
    text: list[int] = []
    age: list[int] = []
    starts = []  # place in the text of each row's deepest left symbol
    for i in range(n):
        at = len(text)
        text += left_symbol[i][::-1]
        text.append(centre[grams[i]])
        text += right_symbol[i]
        text.append(1 + i)
        age += [ages[i]] * (len(text) - at)
        starts.append(at)
    text.append(0)
    age.append(-1)
    order = suffix_array(text)
    # symbols ascend from row ends over centres and left symbols to right symbols, and only
    # suffixes from a left symbol or a centre on are asked for
    first = n + 1
    last = first + sum(len(x) for x in left_symbol) + n
    ages_in_order = [age[s] for s in order[first:last]]
    shared = longest_earlier(ages_in_order, common_prefixes(text, order, first, last))
    match = [0] * len(text)
    for s, k in zip(order[first:last], shared, strict=True):
        match[s] = k
    for i, at in enumerate(starts):
        left, right = [*left_length[i][::-1], 0], [0, *right_length[i]]
        most_x = most_y = 0
        for k, x in enumerate(left):
            rest = match[at + k] - (len(left) - k)  # symbols to the right of the centre
            if rest >= 0 and x + right[rest] >= size:
                most_x, most_y = max(most_x, x), max(most_y, right[rest])
        if most_y:
            yield near[i], most_x, most_y


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            if e > out[-1][1]:
                out[-1] = out[-1][0], e
        else:
            out.append((s, e))
    return out


RANGES = "doc long, key long, start long, end long"


def _compare_lot(t: pa.Table, size: int) -> pa.Table:
    grams, docs, keys, places, lefts, rights = (t.column(c).to_pylist() for c in ("gram", "doc", "key", "at", "left", "right"))
    rank = {x: i for i, x in enumerate(sorted(set(zip(docs, keys, places, strict=True))))}
    ages = [rank[x] for x in zip(docs, keys, places, strict=True)]
    found: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for i, x, y in repeated_in(grams, ages, lefts, rights, size):
        found.setdefault((docs[i], keys[i]), []).append((places[i] - x, places[i] + y))
    rows = [(d, k, s, e) for (d, k), ranges in found.items() for s, e in _merged(ranges)]
    cols = np.array(rows, np.int64).reshape(-1, 4)
    return pa.table({n: cols[:, i] for i, n in enumerate(("doc", "key", "start", "end"))})


def _strings(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Every string around an anchor as (a, b, doc, key, start): a 128-bit hash and its place."""
    for b in batches:
        rows = []
        for _, doc, key, at, left, right in zip(*(c.to_pylist() for c in b.columns), strict=True):
            text = left + right
            for i in range(len(text) - size + 1):
                rows.append((*np.frombuffer(xxhash.xxh3_128_digest(text[i : i + size]), np.int64).tolist(), doc, key, at - len(left) + i))
        cols = np.array(rows, np.int64).reshape(-1, 5)
        yield pa.RecordBatch.from_arrays([pa.array(cols[:, i]) for i in range(5)], names=["a", "b", "doc", "key", "start"])


def remove_repeats(docs: DataFrame, size: int = 100, id_col: str = "doc_id", text_col: str = "text", gram_rows: int = GRAM_ROWS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) of every row's whole text as UTF-8 bytes.

    ``spans`` (array of start, end) are the maximal runs of bytes that lie in a string of
    ``size`` bytes found earlier too: in a row of smaller id, or in the same row at a smaller
    start; ``kept`` (binary) are the other bytes.  A null text is empty; a null id is before
    all ids.  Rows that repeat an id are ordered by a hash of their text; rows equal in id and
    text are the same place, so they are treated alike and none is earlier than the other.  An
    empty table gives no rows.
    """
    spark = use_session(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("doc"), F.xxhash64(text).alias("key"), text.alias("text"))
    found_in = stage(rows.mapInArrow(lambda it: _find_anchors(it, size), ", ".join(f"{c} long" for c in ANCHORS)), "repeat-anchors")
    every = found_in.where("end is null").drop("end")
    inner = stage(found_in.where("end is not null").select("doc", "key", F.col("at").alias("start"), "end"), "repeat-inner")
    often = every.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    # a hash join, as it spares sorting every anchor of the corpus; its built side is the smaller by far
    shared = stage(every.join(often.hint("shuffle_hash"), "gram", "left_semi"), "repeat-shared")
    unstage(found_in)

    place = F.struct("doc", "key", "at")
    first = stage(shared.groupBy("gram", "around").agg(F.min(place).alias("first"), F.count("*").alias("n")), "repeat-first")
    again = shared.join(first.where("n > 1").select("gram", "around", "first"), ["gram", "around"]).where(place != F.col("first"))
    reach = [F.greatest(F.col("at") - (size - K), F.lit(0)).alias("start"), (F.col("at") + size).alias("end")]
    whole = stage(again.select("doc", "key", *reach), "repeat-whole")
    unstage(shared)

    grams = first.groupBy("gram").agg(F.count("*").alias("rows")).where("rows > 1")
    wanted = first.join(grams, "gram").select("first.doc", "first.key", "first.at", "gram")
    wanted = wanted.groupBy("doc", "key").agg(F.collect_set(F.struct("gram", "at")).alias("wanted"))
    cut = rows.join(wanted, ["doc", "key"]).select("text", "doc", "key", "wanted")
    around = stage(cut.mapInArrow(lambda it: _cut(it, size), "gram long, doc long, key long, at long, left binary, right binary"), "repeat-around")

    n_lots = around.count() // LOT_ROWS + shuffle_partitions(spark)
    few, many = grams.where(F.col("rows") <= gram_rows).select("gram"), grams.where(F.col("rows") > gram_rows).select("gram")
    lots = around.join(few, "gram", "left_semi").withColumn("lot", F.pmod(F.xxhash64("gram"), F.lit(n_lots)))
    ranges = stage(lots.groupBy("lot").applyInArrow(lambda t: _compare_lot(t, size), RANGES), "repeat-ranges")
    strings = around.join(many, "gram", "left_semi").select("gram", "doc", "key", "at", "left", "right").mapInArrow(lambda it: _strings(it, size), "a long, b long, doc long, key long, start long")
    strings = stage(strings, "repeat-strings")
    unstage(around)
    earliest = strings.groupBy("a", "b").agg(F.min(F.struct("doc", "key", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
    single = strings.join(earliest, ["a", "b"]).where(F.struct("doc", "key", "start") != F.col("first")).select("doc", "key", "start", (F.col("start") + size).alias("end"))

    found = ranges.unionByName(whole).unionByName(inner).unionByName(single)
    found = found.groupBy("doc", "key").agg(F.collect_set(F.struct("start", "end")).alias("found"))
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("spans", span), T.StructField("kept", T.BinaryType())])

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            for doc, body, ranges in zip(*(c.to_pylist() for c in b.columns), strict=True):
                body = body.encode()
                spans = _merged([(x["start"], min(x["end"], len(body))) for x in ranges or ()])
                left, at = [], 0
                for s, e in spans:
                    left.append(body[at:s])
                    at = e
                left.append(body[at:])
                kept = b"".join(left)
                for col, value in zip(out, (None if doc == _NO_ID else doc, len(body), len(body) - len(kept), [{"start": s, "end": e} for s, e in spans], kept), strict=True):
                    col.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=schema.names)

    return rows.join(found, ["doc", "key"], "left").select("doc", "text", "found").mapInArrow(drop, schema)
