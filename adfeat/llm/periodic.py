"""Periodic run detection by seeds and extension along diagonals (operator 12).

A run is a stretch of words with smallest period q, of at least ``min_length`` words and
``min_exponent`` periods, that no neighbouring word extends.  Two words q apart are equal all
along it, so it is a stretch of max(min_length - q, (min_exponent - 1) q) or more equal pairs
on diagonal q of the text against itself: the minimum overlap that every run of that period
guarantees.  Periods are taken in classes, each with the largest gram length K (a power of
two) that its overlaps guarantee, and K >= q:

* index: the K-grams that a document holds more than once, named by doubling (the name of
  2K words is the pair of names of its halves; a gram that does not repeat is not doubled);
* pairs: each occurrence with the next one of its gram.  More pairs are not needed: in a run
  of smallest period q <= K the next occurrence of a gram is q words on, as an earlier one
  would give the run a smaller period.  So there are never more pairs than words, however
  often a gram occurs;
* extension: a pair is extended to both sides along its diagonal, unless the table of the
  furthest word covered on this diagonal (lag) shows that an earlier pair has done so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfeat.llm.common import chunks, let, use_session, utf8
from adfeat.llm.native import words
from adfeat.llm.words import word_hashes

#: Bytes of text whose words are compared at a time; a longer text is taken alone.
AT_ONCE = 4 << 20


def first_gram(min_length: int, min_exponent: int) -> int:
    """The largest power of two that the overlap of a run of any period reaches."""
    least = min(max(min_length - q, (min_exponent - 1) * q) for q in range(1, min_length + 1))
    return 1 << (max(least, 1).bit_length() - 1)


def _ahead(x: np.ndarray, i: int, j: int) -> int:
    """How many words from i on equal those from j > i on."""
    n, size = 0, 64
    while j + n < len(x):
        m = min(size, len(x) - j - n)
        other = np.flatnonzero(x[i + n : i + n + m] != x[j + n : j + n + m])
        if len(other):
            return n + int(other[0])
        n, size = n + m, min(2 * size, 1 << 16)
    return n


def _back(x: np.ndarray, i: int, j: int) -> int:
    """How many words before i equal those before j > i."""
    n, size = 0, 64
    while n < i:
        m = min(size, i - n)
        other = np.flatnonzero(x[i - n - m : i - n] != x[j - n - m : j - n])
        if len(other):
            return n + m - 1 - int(other[-1])
        n, size = n + m, min(2 * size, 1 << 16)
    return n


def _repeated(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, name) of the keys that occur more than once, by name and then position."""
    if not len(keys):
        return at, keys
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = k[1:] == k[:-1]
    more = np.r_[same, False] | np.r_[False, same]
    return at[order][more], (np.cumsum(np.r_[True, ~same]) - 1)[more]


def runs_of(x: np.ndarray, doc: np.ndarray, min_length: int = 24, min_exponent: int = 3) -> np.ndarray:
    """(start, length, period) of all runs of word ids ``x`` whose documents ``doc`` (ascending) are concatenated."""
    if min_exponent < 3 or min_length < 1:
        raise ValueError("a run has three periods or more, and a word")
    n = len(x)
    _, x = np.unique(x, return_inverse=True)
    x = x.astype(np.int64) + doc * (int(x.max(initial=0)) + 1)  # a word of another document is another word
    size, least, low, found = 1, first_gram(min_length, min_exponent), 0, []
    at, name = _repeated(x, np.arange(n))
    while len(at):
        if size >= least:
            near = name[1:] == name[:-1]
            i, lag = at[:-1][near], (at[1:] - at[:-1])[near]
            fits = (lag > low) & (lag <= size)
            i, lag = i[fits], lag[fits]
            order = np.lexsort((i, lag))
            i, lag = i[order], lag[order]
            # the pair one word on is on the same stretch of the diagonal
            fresh = np.r_[True, (lag[1:] != lag[:-1]) | (i[1:] != i[:-1] + 1)] if len(i) else np.zeros(0, bool)
            covered: dict[int, int] = {}
            for a, q in zip(i[fresh].tolist(), lag[fresh].tolist(), strict=True):
                if a < covered.get(q, 0):
                    continue
                start = a - _back(x, a, a + q)
                covered[q] = end = a + _ahead(x, a, a + q)
                if end - start + q >= max(min_length, min_exponent * q):
                    found.append((start, end - start + q, q))
            low = size
        names = np.full(n, -1, np.int64)
        names[at] = name
        halves = at[at + size < n]
        halves = np.sort(halves[names[halves + size] >= 0])
        at, name = _repeated(names[halves] * (n + 1) + names[halves + size], halves)
        size *= 2
    out = np.array(found, np.int64).reshape(-1, 3)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def periodic_runs(docs: DataFrame, min_length: int = 24, min_exponent: int = 3, text_col: str = "text") -> DataFrame:
    """``docs`` with ``runs`` (start, length, period, in words; by start, then period) and ``collapsed``.

    ``collapsed`` is the text's words joined by one space without those that some run holds
    after its first period.  Words are separated by space and tab to carriage return.  A null
    text has no runs and stays null; an empty or blank one has none and collapses to nothing;
    a text is read whole whatever its length, in memory of a few times its size; rows that
    repeat are rows of their own; an empty table gives no rows.  All other columns pass
    through, except that one called runs or collapsed is replaced.  No row is shuffled.
    """
    use_session(docs.sparkSession)
    extra = ["runs", "collapsed"]
    kept = [c for c in docs.columns if c not in extra]
    text = kept.index(text_col)
    plain = docs.select(*kept).toDF(*(f"c{i}" for i in range(len(kept))))
    run = T.ArrayType(T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")]), False)
    schema = T.StructType([*plain.schema.fields, T.StructField("runs", run), T.StructField("collapsed", T.StringType())])
    arrow = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(text)
            data, offsets = utf8(texts)
            runs, collapsed = [[] for _ in range(len(texts))], [None] * len(texts)
            for lo, hi in chunks(offsets, AT_ONCE):
                part = data[offsets[lo] : offsets[hi]]
                hashes, before = word_hashes(part, offsets[lo : hi + 1] - offsets[lo], fold=False)
                doc = np.repeat(np.arange(hi - lo), np.diff(before))
                for s, n, q in runs_of(hashes, doc, min_length, min_exponent).tolist():
                    runs[lo + doc[s]].append({"start": s - int(before[doc[s]]), "length": n, "period": q})
            for i, found in enumerate(runs):
                if not texts[i].is_valid:
                    continue
                ws = data[offsets[i] : offsets[i + 1]].tobytes().split()  # the same separators
                if found:
                    stays = np.ones(len(ws), bool)
                    for r in found:
                        stays[r["start"] + r["period"] : r["start"] + r["length"]] = False
                    ws = [ws[j] for j in np.flatnonzero(stays)]
                collapsed[i] = b" ".join(ws).decode()
            cols = [*b.columns, pa.array(runs, arrow), pa.array(collapsed, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return plain.mapInArrow(scan, schema).toDF(*kept, *extra)


def div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def planted(doc_id: Column, text: Column) -> Column:
    """The text, made periodic from one of its words on in about a tenth of the documents (by hash of the id)."""
    h = F.crc32(doc_id.cast("string"))
    g = div(h, F.lit(10))

    def periodic(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % F.nullif(n, F.lit(0))
        place = F.struct(a.alias("a"), (1 + div(n - a, 3 + g % 8)).alias("p"))

        def word(s: Column, i: Column) -> Column:
            return F.get(w, F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"]).cast("int"))

        made = let(place, lambda s: F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: word(s, i)), " "))
        return F.when(n > 0, made).otherwise(F.lit(""))

    return F.when((h % 10 == 0) & text.isNotNull(), let(words(text), periodic)).otherwise(text)


def run_digests(found: DataFrame) -> DataFrame:
    """Columns of op12's contract from (doc_id, runs, collapsed)."""
    longer = lambda a, b: a["length"] * b["period"] - b["length"] * a["period"]
    first = lambda a, b: F.when(longer(a, b) != 0, -longer(a, b)).when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["period"] - b["period"])
    best = F.get(F.array_sort("runs", lambda a, b: F.signum(first(a, b)).cast("int")), 0)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("doc_id", "runs", "collapsed", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        div(F.col("best.length") * 1000, F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"),
    )
