import os
import tempfile

from adfeat.sources.schema import IMPRESSION_SCHEMA, read_impressions
from adfeat.sources.views import imp_events, imp_lineitem, split_by_time

from conftest import SF_SMALL


def test_csv_round_trip(spark):
    df = imp_lineitem(spark, SF_SMALL)
    cols = [f.name for f in IMPRESSION_SCHEMA.fields if f.name in df.columns]
    out = os.path.join(tempfile.mkdtemp(prefix="adfeat-csv-"), "imp")
    df.select(*cols).write.option("header", "true").csv(out)
    back = read_impressions(spark, out, fmt="csv")
    assert back.columns == cols
    assert [f.dataType for f in back.schema.fields] == [IMPRESSION_SCHEMA[c].dataType for c in cols]
    assert back.select(*cols).exceptAll(df.select(*cols)).count() == 0
    assert back.count() == df.count()


def test_split_is_a_partition(spark):
    ev = imp_events(spark, SF_SMALL)
    h, t = split_by_time(ev, "2024-01-21")
    assert h.count() + t.count() == ev.count()


def test_view_cut_is_pushed_to_scan(spark):
    plan = imp_events(spark, SF_SMALL, since="2024-01-21")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "ts" in plan


def test_staging_scope_removes_its_tables(spark):
    from adfeat.plans.history import history_features
    from adfeat.session import ensure_checkpoint_dir
    from adfeat.sources.staging import staging_scope
    from adfeat.sources.views import history_and_target

    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    folder = os.path.join(root, "adfeat-stage")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    hist, tgt = history_and_target(spark, SF_SMALL, "imp_events")
    with staging_scope(spark) as paths:
        out = history_features(hist, tgt)
        assert paths and out.count() == tgt.count()  # readable inside
    assert set(os.listdir(folder)) == before


def test_staging_scope_cleans_up_after_an_error(spark):
    import pytest

    from adfeat.sources.staging import stage, staging_scope

    with pytest.raises(ValueError), staging_scope(spark) as paths:
        stage(spark.range(3), "x")
        raise ValueError
    assert not os.path.exists(paths[0].removeprefix("file:"))


def test_csv_columns_in_another_order_and_unknown_ones(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="adfeat-csv-"), "imp")
    spark.createDataFrame([(7, "z", 1)], "shop_id long, other string, instance_id long").write.option("header", "true").csv(out)
    back = read_impressions(spark, out, fmt="csv")
    assert back.columns == ["instance_id", "shop_id"] and back.first() == (1, 7)
