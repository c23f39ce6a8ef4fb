import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from repsmith.operators import interval_sweep as I
from repsmith.operators import quality as Q
from repsmith.operators.joins import range_join
from plan_rows import most_rows


def frames(spark, n_points, n_ranges, seed=1):
    """Half of the points in one month, ranges of hours to years, some on a point, some turned around."""
    rnd = random.Random(seed)
    t0 = dt.datetime(2020, 1, 1)
    at = lambda: t0 + (dt.timedelta(days=700, hours=rnd.randint(0, 700)) if rnd.random() < 0.5 else dt.timedelta(hours=rnd.randint(0, 40000)))
    points = [(i, None if i % 50 == 0 else at()) for i in range(n_points)]
    ranges = []
    for j in range(n_ranges):
        s = at()
        ranges.append((j, s, s + dt.timedelta(hours=rnd.choice([0, 1, 5, 100, 3000, -2]))))
    ranges += [(-1, None, t0), (-2, t0, None), (-3, dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31))]
    return (spark.createDataFrame(points, "i int, t timestamp").repartition(5), spark.createDataFrame(ranges, "j int, s timestamp, e timestamp"), points, ranges)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_sweep_equals_brute_force(spark, monkeypatch, how):
    monkeypatch.setattr(I, "PER_SLICE", 8)
    df, r, points, ranges = frames(spark, 400, 200)
    got = sorted(tuple(x) for x in range_join(df, r, "t", "s", "e", how).select("i", *(["j"] if how in ("inner", "left") else [])).fillna(-9).collect())
    pairs = [(i, j) for i, t in points for j, s, e in ranges if t and s and e and s <= t <= e]
    hit = {i for i, _ in pairs}
    want = {"inner": pairs, "left": pairs + [(i, -9) for i, _ in points if i not in hit], "left_semi": [(i,) for i in hit], "left_anti": [(i,) for i, _ in points if i not in hit]}[how]
    assert got == sorted(want)


def test_many_overlapping_ranges_and_a_hot_month(spark):
    """100,000 ranges: the sweep equals the bucketed form, without a nested loop, and the hot month has many slices."""
    pts = spark.range(20000).select(F.col("id"), F.timestamp_seconds(F.when(F.col("id") % 2 == 0, 1_600_000_000 + F.col("id") * 100).otherwise(F.col("id") * 60_000)).alias("t"))
    ranges = spark.range(100_000).select(F.col("id").alias("r"), F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(1_650_000_000))).alias("s")).withColumn("e", F.col("s") + F.expr("INTERVAL '9' HOUR"))
    def digest(df):
        return df.agg(F.count("*"), F.sum("id"), F.sum("r"), F.bit_xor(F.xxhash64("id", "r"))).first()
    sweep = range_join(pts, ranges, "t", "s", "e", "inner")
    assert "NestedLoop" not in sweep._jdf.queryExecution().executedPlan().toString()
    assert digest(sweep) == digest(range_join(pts, ranges, "t", "s", "e", "inner", max_broadcast_rows=0, bucket="month"))
    points, spans = [r.t for r in pts.orderBy("t").collect()], ranges.select("s", "e").collect()
    assert digest(sweep)[0] == sum(bisect.bisect_right(points, r.e) - bisect.bisect_left(points, r.s) for r in spans)
    borders, axis = I.borders_of(pts, F.col("t"), ranges, "s", "e")
    month = [b for b in borders if 1.6e15 <= b < 1.6e15 + 2e12]
    assert len(borders) > 700 and len(month) > 30


def test_aggregates_per_range_equal_those_of_the_pairs(spark, monkeypatch):
    monkeypatch.setattr(I, "PER_SLICE", 8)
    df, r, points, ranges = frames(spark, 400, 200)
    got = range_join(df, r, "t", "s", "e", "inner", per_range={"n": ("count", None), "lo": ("min", "i"), "hi": ("max", "i")})
    want = []
    for j, s, e in ranges:
        near = [i for i, t in points if t and s and e and s <= t <= e]
        want += [(j, len(near), min(near), max(near))] if near else []
    assert sorted(tuple(x) for x in got.select("j", "n", "lo", "hi").collect()) == sorted(want)


def test_overlapping_ranges_make_no_pairs(spark):
    """3,000 instants and as many ranges that each hold about a third of them: 3 million pairs."""
    pts = spark.range(3000).select(F.col("id"), F.timestamp_seconds(F.col("id") * 60).alias("t"))
    ranges = pts.select(F.col("id").alias("r"), F.col("t").alias("s"), (F.col("t") + F.expr("INTERVAL '1000' MINUTE")).alias("e"))
    out = range_join(pts, ranges, "t", "s", "e", "inner", per_range={"n": ("count", None), "lo": ("min", "id"), "hi": ("max", "id")})
    assert {tuple(x) for x in out.select("r", "n", "lo", "hi").collect()} == {(i, min(i + 1000, 2999) - i + 1, i, min(i + 1000, 2999)) for i in range(3000)}
    assert most_rows(out) <= 100_000


@pytest.mark.parametrize("kind", ["date", "int", "mixed"])
def test_other_axes(spark, monkeypatch, kind):
    monkeypatch.setattr(I, "PER_SLICE", 2)
    base = spark.range(60).selectExpr("CAST(id AS INT) AS i", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS d")
    if kind == "int":
        r = spark.range(0, 60, 3).selectExpr("id AS s", "id + 4 AS e")
        assert range_join(base, r, "i", "s", "e", "inner", max_broadcast_rows=0).count() == sum(1 for i in range(60) for s in range(0, 60, 3) if s <= i <= s + 4)
        return
    cast = "timestamp" if kind == "mixed" else "date"
    r = spark.range(0, 60, 3).selectExpr(f"CAST(date_add(DATE'2024-01-01', CAST(id AS INT)) AS {cast}) AS s", f"CAST(date_add(DATE'2024-01-01', CAST(id + 4 AS INT)) AS {cast}) AS e")
    assert range_join(base, r, "d", "s", "e", "inner", max_broadcast_rows=0).count() == sum(1 for i in range(60) for s in range(0, 60, 3) if s <= i <= s + 4)
    assert range_join(base, r.where("false"), "d", "s", "e", "left", max_broadcast_rows=0).count() == 60
    assert range_join(base.where("false"), r, "d", "s", "e", "inner", max_broadcast_rows=0).count() == 0


def sides(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, *range(3000)]), i % 3, rnd.choice([None, 1.5, float(i)])) for i in range(4000)]
    e = spark.createDataFrame(rows, "k int, j int, v double").groupBy("k", "j").agg(F.max("v").alias("v"))
    return e


def test_checksums_find_what_the_full_join_finds(spark):
    e = sides(spark, 1)
    a = e.where("k IS NULL OR k % 101 <> 0").withColumn("v", F.expr("CASE WHEN k % 77 = 1 THEN 0.25 WHEN k IS NULL THEN v + 1 ELSE v END")).unionByName(spark.createDataFrame([(9999, 1, None)], "k int, j int, v double"))
    for actual in (a, e, e.where("false"), a.withColumn("k", F.col("k").cast("long"))):
        want, got = Q.reconcile(e, actual, ["k", "j"], ["v"]), Q.reconcile_by_checksum(e, actual, ["k", "j"], ["v"])
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert Q.reconcile_by_checksum(e, e, ["k", "j"], ["v"]).count() == 0 and Q.reconcile_by_checksum(e, a, ["k", "j"], ["v"]).count() > 50


def test_repeated_rows_do_not_cancel(spark):
    """An even number of equal rows leaves the xor as it was; the count and the sums do not."""
    e = spark.createDataFrame([(1, 2.0)] * 2 + [(2, 3.0)], "k int, v double")
    assert Q._differing(*[d.select("*", F.xxhash64("k", "v").alias("__h"), F.lit(0).alias("b")) for d in (e, e.where("k = 2"))], ["b"]).count() == 1


def test_agreeing_sides_exchange_no_keys(spark):
    """The rows that reach the full outer join of the keys are none when both sides agree."""
    e = sides(spark, 2)
    out = Q.reconcile_by_checksum(e, e, ["k", "j"], ["v"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert "LocalTableScan <empty>" in final or "EmptyRelation" in final or "FullOuter" not in final
