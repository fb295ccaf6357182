"""Quality rules by a hashed n-gram log-likelihood ratio (operator 1); native expressions only.

Word unigrams and bigrams are hashed to buckets.  Two multinomials over the buckets, one of
the trusted rows and one of the whole raw corpus, give each bucket a log-likelihood ratio; a
document's score is the sum over its n-grams divided by their number, and a document is kept
if the score reaches a threshold, set where labelled good and low rows are best separated.  The
corpus counts cover every row; scoring is a second pass without a shuffle in which every rule
is an expression on the row's own text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeat.llm.common import let, use_session
from adfeat.llm.native import SEPARATORS, labelled, numbers, total, word_hashes

#: Buckets of the multinomials (this many rows come to the driver, whatever the corpus) and added counts.
BUCKETS, SMOOTHING = 8192, 1.0

#: Score per n-gram, in nats, that a document must reach where no labelled rows set the threshold.
THRESHOLD = -0.08

#: Thresholds that labelled rows set are multiples of 1 / STEPS.
STEPS = 1000


def _ngrams(h: Column, buckets: int, weight=lambda bucket: bucket) -> Column:
    """Of the hashed words: ``weight`` of every unigram's and bigram's bucket."""
    one = F.transform(h, lambda w: weight(F.pmod(w, F.lit(buckets)).cast("int")))
    two = F.transform(
        F.slice(h, 2, F.greatest(F.size(h) - 1, F.lit(0))),
        lambda w, i: weight(F.pmod(F.xxhash64(h[i], w), F.lit(buckets)).cast("int")),
    )
    return F.concat(one, two)


def half_of(doc_id: Column) -> Column:
    """0 or 1, by a hash of the id."""
    return F.pmod(F.xxhash64(doc_id.cast("long"), F.lit("half")), F.lit(2)).cast("int")


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[float], list[float]]:
    """Log-likelihood ratios of every bucket, with all trusted rows and with those of half 0; one pass.

    A bounded sample of ``trusted`` (id) is used, and broadcast.
    """
    ids = labelled(trusted, id_col).select(F.col(id_col).cast("long").alias("d"))
    ids = F.broadcast(ids.withColumn("trusted", half_of(F.col("d"))))
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t")).join(ids, "d", "left")
    grams = rows.select("trusted", F.explode(let(word_hashes(F.col("t")), lambda h: _ngrams(h, buckets))).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("trusted").alias("target"), F.count_if(F.col("trusted") == 0).alias("half")).collect()
    raw, target, half = ([SMOOTHING] * buckets for _ in range(3))
    for r in counts:
        raw[r.bucket] += r.raw
        target[r.bucket] += r.target
        half[r.bucket] += r.half
    whole = sum(raw)
    ratios = lambda x, n: [math.log(t / n) - math.log(r / whole) for t, r in zip(x, raw, strict=True)]
    return ratios(target, sum(target)), ratios(half, sum(half))


def _repeated(h: Column) -> Column:
    """Words that lie in 5-word windows found twice or more."""
    at = F.sequence(F.lit(0), F.size(h) - 5)
    window = lambda i: F.xxhash64(h[i], h[i + 1], h[i + 2], h[i + 3], h[i + 4])

    def covered(placed: Column) -> Column:
        again = F.filter(placed, lambda x, k: (F.coalesce(F.get(placed, k - 1)["g"] == x["g"], F.lit(False))) | F.coalesce(F.get(placed, k + 1)["g"] == x["g"], F.lit(False)))
        places = F.transform(again, lambda x: x["i"])
        return let(F.sort_array(places), lambda p: total(F.transform(p, lambda i, k: F.when(k == 0, F.lit(5)).otherwise(F.least(F.lit(5), i - F.get(p, k - 1)))), "bigint"))

    def of_windows(g: Column) -> Column:
        placed = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("bigint")).otherwise(let(placed, covered))

    return F.when(F.size(h) < 6, F.lit(0).cast("bigint")).otherwise(let(F.transform(at, window), of_windows))


def _scored(docs: DataFrame, weights: Column, buckets: int, id_col: str, text_col: str, *also: str) -> DataFrame:
    """The rows' figures without ``kept``, and the columns ``also``."""
    t = F.col("t")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    dup_lines = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))

    def rules(h: Column) -> Column:
        ngrams = _ngrams(h, buckets, lambda b: F.get(weights, b))
        return F.struct(
            F.size(h).cast("bigint").alias("n_words"),
            _repeated(h).alias("n_repeat_words"),
            (total(ngrams) / F.nullif(2 * F.size(h) - 1, F.lit(-1))).alias("score"),
        )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"), *also)
    out = rows.select(
        "doc_id",
        F.length(F.translate(t, SEPARATORS, "")).cast("bigint").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        dup_lines.alias("n_dup_lines"),
        let(word_hashes(t), rules).alias("r"),
        *also,
    )
    failed = (F.col("r.n_words") < 10) | (100 * F.col("r.n_repeat_words") > 20 * F.col("r.n_words"))
    return out.select("doc_id", "r.n_words", "word_chars", "n_symbols", "n_dup_lines", "r.n_repeat_words", failed.alias("base_failed"), "r.score", *also)


def separating_threshold(docs: DataFrame, labels: DataFrame, weights: Column, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> float:
    """The threshold with the least sum of two rates: good rows rejected, of all good ones, and low rows kept, of all low ones.

    ``labels`` has 1 for good and 0 for low; a bounded sample of them is used, the smaller label
    of an id that has two.  Of equally good thresholds the middle one counts; without good or
    low rows it is THRESHOLD.
    """
    one = labels.where(F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.min(label_col).alias("label"))
    ids = F.broadcast(labelled(one, id_col).select(F.col(id_col).cast("long").alias("doc_id"), "label"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(ids, "doc_id")
    scored = _scored(rows, weights, buckets, "doc_id", "text", "label")
    step = F.when(~F.col("base_failed"), F.floor(F.col("score") * STEPS))  # null if rejected anyway
    rows = scored.groupBy("label", step.alias("step")).count().collect()  # at most a row per label and step
    n = [sum(r["count"] for r in rows if r.label == k) for k in (0, 1)]
    steps = sorted({r.step for r in rows if r.step is not None})
    if not (all(n) and steps):
        return THRESHOLD
    first, last = int(steps[0]), int(steps[-1]) + 1
    at = [[0] * (last - first + 1) for _ in n]
    for r in rows:
        if r.step is not None:
            at[r.label][int(r.step) - first] += r["count"]
    kept = [sum(x) for x in at]
    cost = []
    for k in range(last - first + 1):  # the cost of threshold first + k, times both numbers of rows
        cost.append((n[1] - kept[1]) * n[0] + kept[0] * n[1])
        kept = [kept[0] - at[0][k], kept[1] - at[1][k]]
    best = [k for k, c in enumerate(cost) if c == min(cost)]
    return (first + best[len(best) // 2]) / STEPS


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text", labels: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept) of every row.

    With ``labels`` (id, quality 0 or 1) the threshold is ``separating_threshold`` of those in
    half 1, scored with the trusted rows of half 0 alone, so no row sets it that its score was
    learned from.  A
    null or empty text has no words and fails the base rules; its score is null.  Without
    trusted rows all ratios are equal, so every score is about 0 and the base rules decide.  A
    null id is kept and never trusted; repeated rows each give a row and count each.
    """
    use_session(docs.sparkSession)
    weights, of_half = map(numbers, log_ratios(docs, trusted, buckets, id_col, text_col))
    if labels is not None:
        threshold = separating_threshold(docs, labels.where(half_of(F.col(id_col)) == 1), of_half, buckets, id_col, text_col)
    out = _scored(docs, weights, buckets, id_col, text_col)
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("score", F.lit(-1e9)) >= threshold))


def trusted_rows(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """The bounded sample of rows labelled as good."""
    return labelled(labels.where(F.col(label_col) == 1).select(id_col), id_col)
