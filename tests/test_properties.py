"""Property tests: the Spark-first rewrites equal their direct forms on random inputs."""

import datetime as dt

from hypothesis import given, settings, HealthCheck, strategies as st
from pyspark.sql import Window, functions as F

from repsmith.operators import cdc, windows as W

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "hot", None]), st.integers(0, 5), st.integers(0, 3),
                             st.integers(0, 9)), min_size=0, max_size=40)


@SETTINGS
@given(rows=rows_st)
def test_latest_by_key_equals_row_number(spark, rows):
    df = spark.createDataFrame(rows, "k string, ts int, pos int, v int")
    got = cdc.latest_by_key(df, "k", [F.col("ts"), F.col("pos"), F.col("v")])
    w = Window.partitionBy("k").orderBy(F.col("ts").desc(), F.col("pos").desc(), F.col("v").desc())
    ref = df.where(F.col("k").isNotNull()).withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))


days_st = st.lists(st.tuples(st.sampled_from(["x", "y", "hot"]), st.integers(0, 200), st.integers(0, 10_000)),
                   min_size=1, max_size=40, unique_by=lambda r: r[2])


@SETTINGS
@given(rows=days_st)
def test_day_level_rewrites_equal_direct(spark, rows):
    base = dt.date(2024, 1, 1)
    data = [(f"w{i:05d}", e, base + dt.timedelta(days=d), float(i % 17)) for e, d, i in rows]
    df = spark.createDataFrame(data, "workout_id string, ex string, d date, v double")
    a = W.day_level_features(df, ["ex"], "d", "workout_id", "g", {"v": "t"}).select("workout_id", "g", "t")
    g = W.gap_since_previous_direct(df, ["ex"], "d", "workout_id", "g")
    b = W.trailing_range_max_direct(g, ["ex"], "d", {"v": "t"}).select("workout_id", "g", "t")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
