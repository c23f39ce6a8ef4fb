import os

import pytest
from pyspark.sql import functions as F

from repsmith.operators.incremental import KeyedTable
from repsmith.plans import driver_tables as D
from repsmith.plans import marts as M
from repsmith.plans.mart_refresh import StoredMarts

SF = "/root/testdata/sf0.001"
TABLES = ("fct_set", "fct_workout", "fct_exercise_session", "obt_sets")


def rows(df, columns):
    return sorted(map(str, map(tuple, df.select(*columns).collect())))


def equal_to_rebuild(stored, workouts, sets, st, entity):
    full = M.build_marts(workouts, sets, st["templates"], st["crosswalk"], entity)
    for name in TABLES:
        assert rows(getattr(stored, name).read(), full[name].columns) == rows(full[name], full[name].columns), name


def bucket_stamps(table):
    return {p: os.stat(p).st_mtime_ns for d, _, fs in os.walk(table.path) for f in fs if "__bucket=" in d for p in [os.path.join(d, f)]}


def rewritten(before, after):
    return {p.split("__bucket=")[1].split("/")[0] for p in before.keys() | after.keys() if before.get(p) != after.get(p)}


def states(spark):
    st = D.staging(spark, SF)
    st = {k: spark.createDataFrame(v.collect(), v.schema) if k != "sets" else spark.createDataFrame(v.collect(), v.schema) for k, v in st.items()}
    ids = sorted(r.workout_id for r in st["workouts"].select("workout_id").collect())
    return st, ids, M.dim_exercise(st["templates"], st["crosswalk"])


@pytest.mark.parametrize("entity", [(), ("athlete_id",)])
def test_two_increments_equal_the_rebuild(spark, scratch, monkeypatch, entity):
    st, ids, dim = states(spark)
    late, gone, edited, emptied = ids[3], ids[40], ids[70], ids[90]
    w0, s0 = st["workouts"].where(F.col("workout_id") != late), st["sets"].where(F.col("workout_id") != late)
    stored = StoredMarts(spark, f"{scratch}/m", entity, n_buckets=16)
    stored.build(w0, s0, dim)
    changed = lambda *x: spark.createDataFrame([(i,) for i in x], "workout_id long")

    # A workout arrives late, one is edited, one loses all its sets.
    w1 = st["workouts"]
    s1 = st["sets"].where(F.col("workout_id") != emptied).where(~((F.col("workout_id") == edited) & F.col("is_working_set"))).unionByName(
        st["sets"].where(F.col("workout_id") == edited).where("is_working_set").withColumn("weight_lb", F.col("weight_lb") * 3))
    before = {t: bucket_stamps(getattr(stored, t)) for t in ("fct_set", "fct_workout", "obt_sets")}
    assert stored.refresh(w1, s1, dim, changed(late, edited, emptied), 1)
    own = set(map(str, stored.fct_set.buckets(changed(late, edited, emptied))))
    assert rewritten(before["fct_set"], bucket_stamps(stored.fct_set)) == own == rewritten(before["fct_workout"], bucket_stamps(stored.fct_workout))
    if not entity:
        equal_to_rebuild(stored, w1, s1, st, list(entity))

    # One is deleted; the refresh stops before the session fact and is run again under its number.
    w2 = w1.withColumn("is_deleted", F.col("workout_id") == gone)
    real = KeyedTable.replace_keys

    def stops(self, *a):
        if self.path.endswith("fct_exercise_session"):
            raise RuntimeError("lost")
        return real(self, *a)

    monkeypatch.setattr(KeyedTable, "replace_keys", stops)
    with pytest.raises(RuntimeError):
        stored.refresh(w2, s1, dim, changed(gone), 2)
    monkeypatch.setattr(KeyedTable, "replace_keys", real)
    assert stored.refresh(w2, s1, dim, changed(gone), 2)
    equal_to_rebuild(stored, w2, s1, st, list(entity))
    before = bucket_stamps(stored.obt_sets)
    assert not stored.refresh(w2, s1, dim, changed(gone), 2) and bucket_stamps(stored.obt_sets) == before
    assert not os.listdir(f"{scratch}/m/pending")
