import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from repsmith.operators import analysis as A
from repsmith.operators import order_statistics as O
from repsmith.operators import windows as W

VALUES = [0.0, -0.0, 1.0, -1.0, 1.0000000000000002, 5e-324, -5e-324, 1e-300, 1.7976931348623157e308, -1.7976931348623157e308, 3.0, 2.9999999999999996,
          0.1, -0.1, 1 / 3, float("inf"), float("-inf")]


def test_order_key_never_falls(spark):
    rnd = random.Random(1)
    vs = VALUES + [rnd.uniform(-1, 1) * 10 ** rnd.randint(-300, 300) for _ in range(2000)] + [2.0 ** k for k in range(-1074, 1024)]
    rows = spark.createDataFrame([(v,) for v in vs], "v double").select("v", O.order_key("v").alias("k")).collect()
    keys = [r.k for r in sorted(rows, key=lambda r: r.v)]
    assert keys == sorted(keys)
    assert spark.sql("SELECT double('NaN') AS v").select(O.order_key("v")).first()[0] > max(keys)


def grouped(spark, n=3000):
    rnd = random.Random(2)
    rows = [(rnd.choice(["hot"] * 6 + ["a", None]), rnd.choice([None, round(rnd.gauss(100, 30), 1), rnd.gauss(0, 1e-6), float(rnd.randint(-3, 3))])) for _ in range(n)]
    rows += [("one", 7.25), ("two", -1.0), ("two", 4.0), ("nothing", None)]
    return spark.createDataFrame(rows, "g string, v double").repartition(7)


@pytest.mark.parametrize("by", [["g"], []])
def test_distribution_equals_percentile(spark, by):
    df = grouped(spark)
    qs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = O.distribution(df, by, "v", qs)
    want = df.where("v is not null").groupBy(*by).agg(F.count("*").alias("n"), F.avg("v").alias("m"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.percentile("v", F.array(*[F.lit(q) for q in qs])).alias("q"))
    a = {r.g if by else 0: r for r in got.collect()}
    b = {r.g if by else 0: r for r in want.collect()}
    assert a.keys() == b.keys()
    for g in a:
        assert (a[g].n, a[g].min_value, a[g].max_value, a[g].quantiles) == (b[g].n, b[g].lo, b[g].hi, b[g].q)
        assert a[g].mean_value == pytest.approx(b[g].m, abs=1e-9)
    assert O.distribution(df.where("false"), by, "v", qs).count() == 0


def test_plan_has_no_group_buffer(spark):
    df = grouped(spark)
    for out in (A.box_stats(df, ["g"], "v"), A.recovery_curve(df.selectExpr("int(v) AS days_since_last_exposure", "v AS relative_performance"))):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "percentile" not in plan.lower()
        assert "Window" in plan and "__c" in plan


def test_a_hot_group_is_spread(spark):
    """Counted by (group, value), a group with every row is dealt to many partitions."""
    df = spark.range(20000).select(F.lit("hot").alias("g"), (F.col("id") * 1.5).alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = O.value_counts(df, ["g"], "v").groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 1 and max(r["count"] for r in sizes) < 20000 * 0.6
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def sessions(spark, seed, n=600):
    rnd = random.Random(seed)
    base = dt.date(2024, 1, 1)
    rows = [(f"w{i}", rnd.choice(["hot"] * 5 + ["a", "b", None]), None if rnd.random() < 0.02 else base + dt.timedelta(days=rnd.randint(-40, 500)),
             None if rnd.random() < 0.2 else rnd.choice([rnd.gauss(0, 50), float(rnd.randint(95, 105)), 100 + rnd.random() * 1e-9])) for i in range(n)]
    return spark.createDataFrame(rows, "id string, ex string, d date, v double").repartition(5)


@pytest.mark.parametrize("keys,q,lo,hi", [(["ex"], 0.5, 90, 1), (["ex"], 0.9, 7, 0), ([], 0.25, 30, 10)])
def test_trailing_equals_the_row_window(spark, keys, q, lo, hi):
    df = sessions(spark, 11)
    got = {r.id: r.t for r in W.trailing_range_percentile(df, keys, "d", "v", "t", q, lo, hi).collect()}
    w = Window.partitionBy(*keys).orderBy(W.day_number("d")).rangeBetween(-lo, -hi)
    want = {r.id: r.t for r in df.where("d is not null").withColumn("t", F.percentile("v", F.lit(q)).over(w)).collect()}
    assert {i for i in got if i not in want} == {r.id for r in df.where("d is null").collect()}
    assert all(got[i] is None for i in got if i not in want)
    for i in want:
        assert (got[i] is None) == (want[i] is None) and (want[i] is None or got[i] == pytest.approx(want[i], abs=1e-12)), i


def test_trailing_has_no_window_over_rows(spark):
    plan = W.trailing_range_percentile(sessions(spark, 3), ["ex"], "d", "v", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("id#" not in line for line in windows)
    assert W.trailing_range_percentile(sessions(spark, 3).where("false"), ["ex"], "d", "v", "t").count() == 0


def test_trailing_walks_run_once(spark):
    """What a walk finds is read twice by the next; only the last walk is left in the plan."""
    plan = W.trailing_range_percentile(sessions(spark, 3), ["ex"], "d", "v", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Window [" in line for line in plan.splitlines()) == 1
