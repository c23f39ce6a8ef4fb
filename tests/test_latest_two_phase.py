import random

import pytest
from pyspark.sql import functions as F

from repsmith.operators import cdc
from repsmith.operators import membership as M


def versions(spark, n=2000):
    rnd = random.Random(9)
    rows = [(rnd.choice(["hot"] * 20 + [f"k{i}" for i in range(300)] + [None]), rnd.choice([None, *range(12)]), rnd.randint(0, 3), f"doc {rnd.randint(0, 400)} " * 20) for _ in range(n)]
    return spark.createDataFrame(rows + rows[:200], "k string, ts int, pos int, doc string").repartition(6)


def winners(rows):
    best = {}
    for r in rows:
        o = (r.ts is not None, r.ts or 0, r.pos)
        if r.k is not None and (r.k not in best or o > best[r.k]):
            best[r.k] = o
    return best


@pytest.mark.parametrize("keep", [False, True])
def test_documents_of_the_latest_rows(spark, keep):
    df = versions(spark)
    rows = df.collect()
    got = cdc.latest_by_key(df, "k", [F.col("ts"), F.col("pos")], keep_null_keys=keep).collect()
    keyed = [r for r in got if r.k is not None]
    best = winners(rows)
    assert sorted(r.k for r in keyed) == sorted(best)
    every = set(map(tuple, rows))
    assert all(tuple(r) in every and (r.ts is not None, r.ts or 0, r.pos) == best[r.k] for r in keyed)
    assert sorted(tuple(r) for r in got if r.k is None) == (sorted(tuple(r) for r in rows if r.k is None) if keep else [])
    assert cdc.latest_by_key(df.where("false"), "k", ["ts"], keep).count() == 0


def test_several_keys_and_full_ties(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 1, 5, "x"), ("a", 1, 5, "y"), ("a", 2, 1, "z"), ("a", None, 1, "n"), ("a", None, 1, "n")], "k string, j int, ts int, doc string")
    got = sorted((r.j, r.doc) for r in cdc.latest_by_key(df, ["k", "j"], ["ts"]).collect())
    assert [j for j, _ in got] == [1, 2] and got[0][1] in "xy" and got[1] == (2, "z")
    kept = [r.doc for r in cdc.latest_by_key(df, ["k", "j"], ["ts"], keep_null_keys=True).collect()]
    assert kept.count("n") == 2 and len(kept) == 4


def sorted_outputs(df):
    """Columns that the children of the plan's sorts (and sort aggregates) put out."""
    found = []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.initialPlan())
        if node.nodeName() in ("Sort", "SortAggregate"):
            found.append([node.children().apply(0).output().apply(i).name() for i in range(node.children().apply(0).output().size())])
        for i in range(node.children().size()):
            walk(node.children().apply(i))
    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_no_document_is_sorted(spark):
    df = versions(spark)
    for keep in (False, True):
        out = cdc.latest_by_key(df, "k", [F.col("ts"), F.col("pos")], keep_null_keys=keep)
        below = sorted_outputs(out)
        assert below and all("doc" not in cols for cols in below)
    assert any("doc" in cols for cols in sorted_outputs(df.groupBy("k").agg(F.max(F.struct("ts", "doc")))))


def test_membership_is_never_falsely_negative(spark, monkeypatch):
    wanted = spark.range(0, 5000, 7).select(F.xxhash64("id").alias("w"))
    df = spark.range(5000).select("id", F.xxhash64("id").alias("k"))
    got = {r.id: r.m for r in M.with_membership(df, "k", wanted, "w", "m").collect()}
    assert len(got) == 5000 and all(got[i] for i in range(0, 5000, 7)) and sum(got.values()) < 800
    assert not any(r.m for r in M.with_membership(df, "k", wanted.where("false"), "w", "m").collect())
    monkeypatch.setattr(M, "MAP_BITS", 1 << 16)
    assert all(r.m for r in M.with_membership(df.where("id % 7 = 0"), "k", wanted, "w", "m").collect())


def test_live_documents_make_the_versions_once(spark):
    """Workouts and sets start from the same latest versions; what is left of the events in the plan is the feed."""
    import __spark_entry__ as E
    plan = E.queries()["fct_set_live_documents"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation [event_id" in line for line in plan.splitlines()) <= 3
