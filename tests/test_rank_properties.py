import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adfeat.operators.ranks import add_time_ranks

ROWS = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", None]),
        st.one_of(st.none(), st.integers(min_value=0, max_value=40)),
    ),
    min_size=1,
    max_size=60,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, block=st.sampled_from([5, 60, 86400]))
def test_ranks_equal_pandas(spark, rows, block):
    data = [(i, k, None if s is None else f"2024-01-01 00:00:{s:02d}") for i, (k, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "rid long, k string, t string").withColumn("ts", F.to_timestamp("t"))
    out = add_time_ranks(df, ["k"], "ts", "k", block_seconds=block, counts={"n": "rid"}).toPandas()
    pdf = pd.DataFrame(data, columns=["rid", "k", "t"])
    g = pdf.groupby("k", dropna=True)["t"]
    pdf["first"] = g.rank(method="average", ascending=True)
    pdf["last"] = g.rank(method="average", ascending=False)
    pdf["n"] = pdf.groupby("k", dropna=True)["rid"].transform("count").fillna(0)
    m = out.merge(pdf, on="rid", suffixes=("", "_p"))
    for ours, theirs in (("k_first_rank", "first"), ("k_last_rank", "last")):
        both_null = m[ours].isna() & m[theirs].isna()
        assert (both_null | (m[ours] == m[theirs])).all()
    assert (m["n"].astype(int) == m["n_p"].fillna(0).astype(int)).all()
    assert ((m["k_if_first"] == 1) == (m["first"] == 1.0)).all()
