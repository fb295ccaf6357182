"""P5/P6 by one distributed sort and a scan of it: average time ranks without a join back.

The rows are sorted once over partitions by (key, time); the range partitioning also cuts on
a row number, so a hot key, or a hot second of it, lies in as many partitions as it needs.
Each task scans its sorted partition and gives every row the number of rows of its key
before its time, of rows at its time and of rows of its key, as far as the partition knows.
Only the first and the last key of a partition can go on in another one.  A table with at
most two rows per partition (as small as the bounds of the range partitioning itself) is
summed up in partition order and added: offsets of earlier partitions, and ties that cross a
border, on either side of it.

    first_rank = before + (peers + 1) / 2
    last_rank  = N + 1 - first_rank
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfeat.operators.counts import keys_present
from adfeat.operators.ranks import flag_one, rank_names
from adfeat.session import workers_import
from adfeat.sources.staging import stage

#: Rows that one partition of the sort is sized for.
PART_ROWS = 500_000

FIRST, LAST = "_first", "_last"
_FOUND = {"_part": T.IntegerType(), "_run": T.IntegerType(), "_before": T.LongType(), "_peers": T.LongType(), "_n": T.LongType(), "_lo": T.BooleanType(), "_hi": T.BooleanType(), "_end": T.BooleanType()}

_BORDER = pa.schema([("_part", pa.int32()), ("_run", pa.int32()), *((c, pa.int64()) for c in ("_add", "_all", "_same", "_lo_all", "_hi_all"))])


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """Integers that are equal exactly where the column's values are."""
    values = column.combine_chunks()
    if isinstance(values, pa.ChunkedArray):  # no chunk at all
        return np.zeros(0, np.int64)
    if pa.types.is_integer(values.type):
        return values.to_numpy(zero_copy_only=False)
    if pa.types.is_timestamp(values.type):
        return values.cast(pa.int64()).to_numpy(zero_copy_only=False)
    return values.dictionary_encode().indices.to_numpy(zero_copy_only=False)


def scanned(key_codes: list[np.ndarray], ts: np.ndarray) -> dict[str, np.ndarray]:
    """Per row of a sorted partition: run (0 the first key, 1 the last, -1 between), rows of its
    key before its time, at its time and in all, and whether it is at the first time of the
    first key or the last time of the last."""
    n = len(ts)
    new_key = np.zeros(n, bool)
    new_key[0] = True
    for c in key_codes:
        new_key[1:] |= c[1:] != c[:-1]
    new_tie = new_key.copy()
    new_tie[1:] |= ts[1:] != ts[:-1]
    keys, ties = np.flatnonzero(new_key), np.flatnonzero(new_tie)
    key, tie = np.cumsum(new_key) - 1, np.cumsum(new_tie) - 1
    last = len(keys) - 1
    run = np.where(key == 0, 0, np.where(key == last, 1, -1))
    return {
        "_run": run,
        "_before": ties[tie] - keys[key],
        "_peers": np.diff(np.r_[ties, n])[tie],
        "_n": np.diff(np.r_[keys, n])[key],
        "_lo": (run >= 0) & (ties[tie] == keys[key]),
        "_hi": (run >= 0) & (np.r_[ties[1:], n][tie] == np.r_[keys[1:], n][key]),
    }


def borders(runs: list[dict]) -> list[tuple]:
    """(part, run, rows before, N, rows before at the first time, at the first time, at the last) of runs that go on.

    ``runs``: part, run, key, n, lo and hi (first and last time), at_lo and at_hi (rows there).
    """
    runs = sorted(runs, key=lambda r: (r["part"], r["run"]))
    out, at = [], 0
    while at < len(runs):
        end = at + 1
        while end < len(runs) and runs[end]["key"] == runs[at]["key"]:
            end += 1
        chain, total = runs[at:end], {}
        for r in chain:
            total[r["lo"]] = total.get(r["lo"], 0) + r["at_lo"]
            if r["hi"] != r["lo"]:
                total[r["hi"]] = total.get(r["hi"], 0) + r["at_hi"]
        n, before, seen = sum(r["n"] for r in chain), 0, {}
        for r in chain if len(chain) > 1 else ():
            out.append((r["part"], r["run"], before, n, seen.get(r["lo"], 0), total[r["lo"]], total[r["hi"]]))
            before += r["n"]
            seen[r["lo"]] = seen.get(r["lo"], 0) + r["at_lo"]
            if r["hi"] != r["lo"]:
                seen[r["hi"]] = seen.get(r["hi"], 0) + r["at_hi"]
        at = end
    return out


def _ends(run: np.ndarray) -> np.ndarray:
    """Which rows are the first or the last of the partition's first or last key."""
    out = np.zeros(len(run), bool)
    for r in (0, 1):
        at = np.flatnonzero(run == r)
        out[at[:1]] = out[at[-1:]] = True
    return out


def scan_ranks(
    rows: DataFrame, keys: list[str], ts: str, name: str = "ranks", part_rows: int = PART_ROWS, n_rows: int | None = None, wanted: list[str] | None = None
) -> DataFrame:
    """The rows that have all keys and a time, with ``_first`` and ``_last`` (average ranks); one exchange.

    ``n_rows``, if the caller knows it, spares counting ``rows``; ``wanted`` are the columns to
    return (all if None), others are staged only in the rows at a partition's ends.
    """
    spark = workers_import(rows.sparkSession)
    rows = rows.where(keys_present([*keys, ts]))
    n_rows = rows.count() if n_rows is None else n_rows
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_rows // part_rows + 1)
    put = rows.withColumn("_spread", F.monotonically_increasing_id()).repartitionByRange(parts, *keys, ts, "_spread")
    put = put.sortWithinPartitions(*keys, ts).drop("_spread").withColumn("_part", F.spark_partition_id())
    names = rows.columns
    wanted = names if wanted is None else wanted
    spared = [i for i, c in enumerate(names) if c not in wanted]
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in rows.schema.fields), *(T.StructField(c, t) for c, t in _FOUND.items())])
    key_at, ts_at = [names.index(k) for k in keys], names.index(ts)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        t = pa.Table.from_batches(found)
        new = scanned([_codes(t.column(i)) for i in key_at], _codes(t.column(ts_at)))
        new["_end"] = _ends(new["_run"])
        inner = pa.array(~new["_end"])
        for i in spared:
            t = t.set_column(i, t.schema.field(i).with_nullable(True), pc.if_else(inner, pa.scalar(None, t.schema.types[i]), t.column(i)))
        for c, v in new.items():
            t = t.append_column(c, pa.array(v.astype(np.int32) if c == "_run" else v))
        yield from t.combine_chunks().to_batches(max_chunksize=20_000)

    done = stage(put.mapInArrow(scan, schema), name)
    at = lambda c: F.max(F.when(F.col(c), F.col("_peers")))
    ends = done.where("_end").groupBy("_part", "_run").agg(
        *[F.first(k).alias(f"k{i}") for i, k in enumerate(keys)], F.max("_n").alias("n"), F.min(ts).alias("lo"), F.max(ts).alias("hi"), at("_lo").alias("at_lo"), at("_hi").alias("at_hi")
    )
    runs = [{"part": r["_part"], "run": r["_run"], "key": tuple(r[f"k{i}"] for i in range(len(keys))), **{c: r[c] for c in ("n", "lo", "hi", "at_lo", "at_hi")}} for r in ends.collect()]
    # as an Arrow table it is a local relation, which no Python worker has to read
    border = spark.createDataFrame(pa.Table.from_pylist([dict(zip(_BORDER.names, b, strict=True)) for b in borders(runs)], _BORDER))
    out = done.join(F.broadcast(border), ["_part", "_run"], "left")  # at most two rows per partition
    goes_on = F.col("_add").isNotNull()
    before = F.when(goes_on, F.col("_before") + F.col("_add") - F.when(F.col("_lo"), F.col("_same")).otherwise(F.lit(0))).otherwise(F.col("_before"))
    peers = F.when(goes_on & F.col("_lo"), F.col("_lo_all")).when(goes_on & F.col("_hi"), F.col("_hi_all")).otherwise(F.col("_peers"))
    first = before + (peers + 1) / F.lit(2.0)
    return out.select(*wanted, first.alias(FIRST), (F.coalesce("_all", "_n") + 1 - first).alias(LAST))


def add_scanned_ranks(df: DataFrame, keys: list[str], ts: str, prefix: str, order: tuple[str, ...] = ("last", "first"), part_rows: int = PART_ROWS) -> DataFrame:
    """``df`` with ``{prefix}_{last,first}_rank`` and ``{prefix}_if_{last,first}``, as ``add_time_ranks`` gives them.

    The rows go through the scan with all their columns, so nothing is joined back; rows
    without a key or a time get null ranks and flag 0.
    """
    names, out = rank_names(prefix), []
    for direction in order:
        rank = F.col(FIRST if direction == "first" else LAST)
        out += [rank.alias(names[direction]), flag_one(rank).alias(names[f"if_{direction}"])]
    none = F.lit(None).cast("double")
    without = df.where(~keys_present([*keys, ts])).withColumns({FIRST: none, LAST: none})
    return scan_ranks(df, keys, ts, f"{prefix}-ranks", part_rows).unionByName(without).select(*df.columns, *out)
