"""Property test: insert-if-absent against a plain Python model of keyed first-wins."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snaplake.operators import load
from snaplake.session import scratch_path

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]
row = st.tuples(st.integers(0, 5), st.sampled_from(DAYS), st.sampled_from(["api", "discover"]),
                st.integers(0, 1000))
batches = st.lists(st.lists(row, max_size=12), min_size=1, max_size=3)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches)
def test_insert_if_absent_model(spark, batches):
    path = scratch_path(spark, "prop-insert")
    model: dict = {}
    for b in batches:
        first: dict = {}
        for i, d, s, v in sorted(b, key=lambda r: r[3]):  # order: v ascending
            first.setdefault((i, d, s), v)
        for k, v in first.items():
            model.setdefault(k, v)
        if b:
            df = spark.createDataFrame(b, "id long, snapshot_date date, data_source string, v long")
            load.insert_if_absent(df, path, order=[F.col("v").asc()])
    if not model:
        return
    got = {(r.id, r.snapshot_date, r.data_source): r.v
           for r in spark.read.parquet(path).collect()}
    assert got == model
