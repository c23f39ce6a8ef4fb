import os

from pyspark.sql import functions as F

from repsmith.operators import incremental
from repsmith.operators.incremental import KeyedTable
from repsmith.plans import driver_tables as D
from repsmith.plans import marts as M
from repsmith.plans.mart_refresh import StoredMarts

SF = "/root/testdata/sf0.001"


def files(path):
    return {p: os.path.getsize(p) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet") for p in [os.path.join(d, f)]}


def test_increments_are_appended_and_rewritten_now_and_then(spark, scratch, monkeypatch):
    monkeypatch.setattr(incremental, "REWRITE_EVERY", 3)
    t = KeyedTable(spark, f"{scratch}/t", "k", 4, deltas=True)
    state = {k: [k or -1] for k in [None, *range(40)]}
    frame = lambda rows: spark.createDataFrame(rows, "k long, v long")
    t.overwrite(frame([(k, v) for k, vs in state.items() for v in vs]))
    for i in range(1, 5):
        before = files(scratch)
        state |= {None: [i], i: [i * 100, i * 100], 20 + i: [], 50: [i]}
        delta = [(k, v) for k in (None, i, 50) for v in state[k]]
        for _ in range(2 if i == 1 else 1):  # again: the same result
            t.replace_keys(frame(delta), spark.createDataFrame([(20 + i,)], "k long"))
        want = sorted((str(k), v) for k, vs in state.items() for v in vs)
        assert sorted((str(r.k), r.v) for r in t.read().collect()) == want, i
        assert t.read().columns == ["k", "v"]
        assert (before.keys() <= files(scratch).keys()) == (i != 2)  # the third increment rewrites


def test_a_refresh_of_all_buckets_keeps_the_files_of_what_did_not_change(spark, scratch):
    st = D.staging(spark, SF)
    dim = M.dim_exercise(st["templates"], st["crosswalk"])
    stored = StoredMarts(spark, f"{scratch}/m", n_buckets=2)
    gone = F.col("workout_id") % 50 == 3
    stored.build(st["workouts"].withColumn("is_deleted", gone), D.set_rows(spark, SF), dim, D.set_columns)
    before = files(f"{scratch}/m")
    ids = st["workouts"].where(gone).select("workout_id")
    assert len(stored.fct_set.buckets(ids)) == 2
    assert stored.refresh(st["workouts"], st["sets"], dim, ids, 1)
    after = files(f"{scratch}/m")
    assert before.keys() <= after.keys()
    full = M.obt_sets(stored.fct_set.read(), stored.fct_workout.read(), M.fct_exercise_session(stored.sessions.read(), stored.fct_workout.read()))
    assert stored.obt_sets.read().select(*full.columns).exceptAll(full).count() == 0 == full.exceptAll(stored.obt_sets.read().select(*full.columns)).count()
    assert full.count() == spark.read.parquet(f"{SF}/lineitem.parquet").join(st["workouts"], F.col("l_orderkey") == F.col("workout_id"), "left_semi").count()
