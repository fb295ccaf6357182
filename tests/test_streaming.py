import os
import tempfile

from adfeat.operators.counts import key_counts
from adfeat.sources.views import imp_events, imp_events_from
from adfeat.streaming import impression_stream, latest_counts, streaming_key_counts, write_changelog

from conftest import SF_SMALL


def test_streaming_counts_equal_batch_counts(spark):
    root = tempfile.mkdtemp(prefix="adfeat-stream-")
    keys = ["user_id", "shop_id"]
    stream = impression_stream(spark, SF_SMALL)
    q = write_changelog(
        streaming_key_counts(stream, keys, "user_shop_sum", "user_shop_trade"),
        os.path.join(root, "log"),
        os.path.join(root, "ckpt"),
    )
    q.awaitTermination(300)
    assert q.exception() is None
    got = latest_counts(spark, os.path.join(root, "log"), keys, ["user_shop_sum", "user_shop_trade"])
    want = key_counts(imp_events(spark, SF_SMALL), keys, n="user_shop_sum", conv="user_shop_trade")
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_compaction_keeps_the_newest_totals(spark):
    from pyspark.sql import functions as F

    from adfeat.streaming import compact_changelog

    root = tempfile.mkdtemp(prefix="adfeat-compact-")
    log = os.path.join(root, "log")
    rows = [("a", 1, 0), ("b", 2, 0), ("a", 3, 1), ("c", 1, 2), ("b", 5, 2)]
    df = spark.createDataFrame(rows, "k string, n long, _batch_id long")
    df.where("_batch_id <= 1").write.partitionBy("_batch_id").parquet(log)
    assert compact_changelog(spark, log, ["k"], ["n"]) == 1
    df.where("_batch_id = 2").write.mode("append").partitionBy("_batch_id").parquet(log)
    got = {r.k: r.n for r in latest_counts(spark, log, ["k"], ["n"]).collect()}
    assert got == {"a": 3, "b": 5, "c": 1}
    assert compact_changelog(spark, log, ["k"], ["n"]) == 2
    got = {r.k: r.n for r in latest_counts(spark, log, ["k"], ["n"]).collect()}
    assert got == {"a": 3, "b": 5, "c": 1}


KEYS, MEASURES = ["user_id", "shop_id"], ["user_shop_sum", "user_shop_trade"]


def _run(spark, sf_dir, root):
    stream = impression_stream(spark, sf_dir, max_files=1)
    q = write_changelog(streaming_key_counts(stream, KEYS, *MEASURES), os.path.join(root, "log"), os.path.join(root, "ckpt"))
    q.awaitTermination(300)
    assert q.exception() is None
    return latest_counts(spark, os.path.join(root, "log"), KEYS, MEASURES)


def test_folder_table_over_several_batches_with_a_restart(spark):
    """Part files, keys that recur in every batch, and a second run from the checkpoint."""
    from pyspark.sql import functions as F

    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    root = tempfile.mkdtemp(prefix="adfeat-parts-")
    table = os.path.join(root, "events.parquet")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    first, rest = events.where("event_id % 5 <> 0"), events.where("event_id % 5 = 0")
    first.repartition(4, F.col("event_id") % 4).write.parquet(table)
    got = _run(spark, root, root)
    batches = spark.read.parquet(os.path.join(root, "log"))
    assert batches.select("_batch_id").distinct().count() >= 3
    assert batches.groupBy(*KEYS).count().where("count > 1").count() > 0  # keys updated across batches
    want = key_counts(imp_events_from(spark.read.parquet(table)), KEYS, n=MEASURES[0], conv=MEASURES[1])
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()
    rest.coalesce(1).write.mode("append").parquet(table)
    got = _run(spark, root, root)  # restart from the checkpoint: only the new file is read
    want = key_counts(imp_events(spark, SF_SMALL), KEYS, n=MEASURES[0], conv=MEASURES[1])
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider


def test_empty_table_gives_no_totals(spark):
    root = tempfile.mkdtemp(prefix="adfeat-empty-")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(0).write.parquet(os.path.join(root, "events.parquet"))
    got = _run(spark, root, root)
    assert got.columns == [*KEYS, *MEASURES] and got.count() == 0
