from pyspark.sql import functions as F

from repsmith.functions import scalars as X
from repsmith.operators import analysis as A, cdc, joins, rollups


def test_split_feed_and_duplicate_count(spark):
    feed = spark.createDataFrame([("a", "updated"), ("a", "deleted"), ("b", "updated"), (None, "updated")],
                                 "k string, type string")
    upd, dele = cdc.split_feed(feed)
    assert upd.count() == 3 and dele.count() == 1
    assert cdc.duplicates_dropped(feed, "k").first().dropped == 1


def test_bounded_broadcast_and_null_safe_key(spark):
    small = spark.range(5)
    assert joins.has_at_most(small, 5) and not joins.has_at_most(small, 4)
    plan = joins.dimension_join(spark.range(100).withColumnRenamed("id", "k"),
                                small.withColumnRenamed("id", "k"), "k", "inner", max_broadcast_rows=10)
    assert plan.count() == 5
    df = spark.createDataFrame([(None,), ("x",)], "c string")
    assert [r[0] for r in df.select(joins.null_safe_key("c")).collect()] == ["", "x"]


def test_designed_rest_buckets_and_epley(spark):
    df = spark.createDataFrame([(0,), (1,), (3,), (4,), (6,), (7,), (None,)], "d int")
    assert [r[0] for r in df.select(X.rest_bucket_designed("d")).collect()] == ["0", "1", "3", "4-6", "4-6", "7+", None]
    e = spark.createDataFrame([(100.0, 10), (100.0, 13)], "w double, r int").select(X.epley("w", "r")).collect()
    assert abs(e[0][0] - 100.0 * (1 + 10 / 30)) < 1e-9 and e[1][0] is None


def test_display_limit_exists_distinct_argmax(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, None), (3, "b")], "n int, s string")
    assert A.display_limit(df, 2).count() == 2 and A.display_limit(df, 0).count() == 4
    assert A.exists(df) and not A.exists(df.where("n > 10"))
    assert [r.s for r in rollups.distinct_sorted(df, "s").collect()] == ["a", "b", "c"]
    best = rollups.argmax_row(df, [F.col("n"), F.col("s")]).collect()
    assert [tuple(r) for r in best] == [(3, "c")]
    assert rollups.argmax_row(df.where("n > 10"), [F.col("n")]).count() == 0


def test_null_keys_form_groups_in_joins(spark):
    from repsmith.operators import quality as Q
    s = spark.createDataFrame([(None, "e1", 1.0)] * 12 + [("a", "e1", 2.0)], "era string, ex string, v double")
    p = A.pooled_groups(s, "ex", "ex", min_n=10, metric="v", by=["era"])
    got = {(r.era, r.group_level): r.n_sessions for r in p.collect()}
    assert got[(None, "ex")] == 12                       # null era counted as its own group
    e = spark.createDataFrame([(None, 1), ("x", 2)], "k string, n long")
    a = spark.createDataFrame([(None, 1), ("x", 3)], "k string, n long")
    assert [tuple(r) for r in Q.reconcile(e, a, "k", ["n"]).collect()] == [("x", 2, 3)]
    assert sorted((tuple(r) for r in Q.compare_counts(e, a, "k").collect()), key=str) == sorted([(None, 1, 1, True), ("x", 2, 3, False)], key=str)
