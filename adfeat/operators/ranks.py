"""Average-method rank of each row's time within its key, both directions.

Semantics (pandas ``rank(method='average')``): rows tied on time share the
mean of the ranks they span, so with ``before`` rows earlier in the key and
``peers`` rows at the same time

    first_rank = before + (peers + 1) / 2
    last_rank  = N + 1 − first_rank        (N = rows of the key with a time)

and ``if_first`` / ``if_last`` is 1 only for a *unique* extreme (rank 1.0).
Rows with a null key or time get null ranks and flag 0.

Skew-safe plan.  A plain window ``partitionBy(key).orderBy(ts)`` sends every
row of a key to one task; with a key holding a third of the log that task
holds a third of the data.  Instead:

1. aggregate the rows to distinct ``(key, ts) → peers`` (partial aggregation,
   so a hot key shrinks to its distinct timestamps before the shuffle);
2. cut time into blocks of ``block_seconds`` and take the running sum of peers
   inside each ``(key, block)`` – a window group holds at most one block's
   distinct timestamps;
3. total each block and take the running sum over blocks of a key – a window
   group holds one row per block, not per event;
4. add the two offsets and join the ranks back on ``(key, ts)``, which spreads
   a hot key over partitions by time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adfeat.functions import indicator
from adfeat.operators.counts import keys_present

DEFAULT_BLOCK_SECONDS = 86400
NO_BLOCK = -(2**62)  # block id of rows without a time (sorts before every real block)


def rank_names(prefix: str) -> dict[str, str]:
    return {
        "first": f"{prefix}_first_rank",
        "if_first": f"{prefix}_if_first",
        "last": f"{prefix}_last_rank",
        "if_last": f"{prefix}_if_last",
    }


def rank_table(
    df: DataFrame,
    keys: list[str],
    ts: str,
    block_seconds: int = DEFAULT_BLOCK_SECONDS,
    counts: dict[str, str] | None = None,
) -> DataFrame:
    """``(keys…, ts, _first, _last, count…)`` for every distinct non-null key and time.

    ``counts`` (name → column) adds per-key non-null counts of a column, taken
    from the same aggregate; rows whose time is null then appear once with a
    null ``ts`` so they are counted but not ranked.
    """
    counts = counts or {}
    cond = keys_present(keys) if counts else keys_present(keys) & F.col(ts).isNotNull()
    aggs = [F.count(F.lit(1)).alias("_peers")] + [F.count(F.col(c)).alias(f"_c_{n}") for n, c in counts.items()]
    kt = df.where(cond).groupBy(*keys, ts).agg(*aggs)
    timed = F.col(ts).isNotNull()
    peers = F.when(timed, F.col("_peers")).otherwise(F.lit(0))
    half = (F.col("_peers") + F.lit(1)) / F.lit(2.0)

    blk = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / F.lit(float(block_seconds)))
    kt = kt.withColumn("_blk", F.coalesce(blk, F.lit(NO_BLOCK)))
    w_in = Window.partitionBy(*keys, "_blk").orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)
    kt = kt.withColumn("_before_in", F.coalesce(F.sum(peers).over(w_in), F.lit(0)))

    blocks = kt.groupBy(*keys, "_blk").agg(
        F.sum(peers).alias("_blk_rows"), *[F.sum(f"_c_{c}").alias(f"_c_{c}") for c in counts]
    )
    w_blk = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    blocks = blocks.select(
        *keys,
        "_blk",
        F.coalesce(F.sum("_blk_rows").over(w_blk), F.lit(0)).alias("_before_blk"),
        F.sum("_blk_rows").over(whole).alias("_n"),
        *[F.sum(f"_c_{c}").over(whole).alias(c) for c in counts],
    )
    r = kt.join(blocks, on=[*keys, "_blk"], how="inner")
    first = F.col("_before_blk") + F.col("_before_in") + half
    return r.select(
        *keys,
        ts,
        F.when(timed, first).alias("_first"),
        F.when(timed, F.col("_n") + F.lit(1) - first).alias("_last"),
        *[F.col(c) for c in counts],
    )


def flag_one(rank: Column) -> Column:
    """1 iff the average rank is exactly 1 (a unique extreme)."""
    return indicator(rank == F.lit(1.0))


def add_time_ranks(
    df: DataFrame,
    keys: list[str],
    ts: str,
    prefix: str,
    order: tuple[str, ...] = ("last", "first"),
    block_seconds: int = DEFAULT_BLOCK_SECONDS,
    source: DataFrame | None = None,
    counts: dict[str, str] | None = None,
) -> DataFrame:
    """Append ``{prefix}_{last,first}_rank`` and ``{prefix}_if_{last,first}``.

    ``order`` fixes the column order (the reference writes some keys
    last-first and others first-last).  ``source`` is the frame the ranks are
    computed over when ``df`` is a widened or narrowed copy of it (same rows).
    ``counts`` (name → column) also attaches per-key non-null counts of a
    column from the same aggregate and join, placed before the ranks
    (0 for a null key).
    """
    names = rank_names(prefix)
    counts = counts or {}
    src = source if source is not None else df
    r = rank_table(src, keys, ts, block_seconds=block_seconds, counts=counts)
    # rename the table's columns so the join condition is unambiguous
    rr = r.select(
        *[F.col(k).alias(f"_rk{i}") for i, k in enumerate(keys)],
        F.col(ts).alias("_rts"),
        "_first",
        "_last",
        *[F.col(c).alias(f"_rc_{c}") for c in counts],
    )
    cond = [F.col(k) == F.col(f"_rk{i}") for i, k in enumerate(keys)]
    cond.append(F.col(ts).eqNullSafe(F.col("_rts")) if counts else F.col(ts) == F.col("_rts"))
    joined = df.join(rr, cond, how="left")
    out: list[Column] = [F.coalesce(F.col(f"_rc_{c}"), F.lit(0)).alias(c) for c in counts]
    for direction in order:
        rank = F.col("_first" if direction == "first" else "_last")
        out += [rank.alias(names[direction]), flag_one(rank).alias(names[f"if_{direction}"])]
    return joined.select(*[F.col(c) for c in df.columns], *out)
