import json

from pyspark.sql import functions as F

from repsmith.operators import nested
from repsmith.operators.incremental import KeyedTable, key_replace, delta_since


def test_flatten_inner_semantics_and_offsets(spark):
    docs = [{"id": "a", "start": "2024-01-01T10:00:00-05:00",
             "exercises": [{"index": 0, "sets": [{"index": 0, "reps": 5}, {"index": 1, "reps": "6"}]},
                           {"index": 1, "sets": []}, {"index": 2, "sets": None}]},
            {"id": "b", "exercises": None}, {"id": "c", "exercises": []}]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "record string")
    flat = nested.flatten_two_levels(df, "record", {"wid": ("$.id", "string"), "start": ("$.start", "string")},
                                     "$.exercises", {"ei": ("$.index", "int")},
                                     "$.sets", {"si": ("$.index", "int"), "reps": ("$.reps", "int")})
    got = sorted(tuple(r) for r in flat.collect())
    assert got == [("a", "2024-01-01T10:00:00-05:00", 0, 0, 5), ("a", "2024-01-01T10:00:00-05:00", 0, 1, 6)]
    total = df.select(F.sum(nested.nested_length_sum("record", "$.exercises", "$.sets"))).collect()[0][0]
    assert total == 2


def test_nest_children_bounds_group_size(spark):
    rows = [(1, i) for i in range(1000)] + [(2, 0)]
    df = spark.createDataFrame(rows, "p long, c long")
    out = nested.nest_children(df, ["p"], ["c"], "kids", max_children=100)
    sizes = [r[0] for r in out.select(F.size("kids")).collect()]
    assert sum(sizes) == 1001 and max(sizes) < 200 and out.where("p = 1").count() == 10


def test_key_replace_removes_deleted_and_emptied(spark):
    target = spark.createDataFrame([("w1", 1), ("w1", 2), ("w2", 1), ("w3", 1)], "k string, v int")
    delta = spark.createDataFrame([("w1", 9)], "k string, v int")
    changed = spark.createDataFrame([("w1",), ("w2",)], "k string")  # w2 deleted / emptied
    got = sorted(tuple(r) for r in key_replace(target, delta, "k", changed).collect())
    assert got == [("w1", 9), ("w3", 1)]


def test_delta_since_inclusive(spark):
    src = spark.sql("SELECT * FROM VALUES ('a', TIMESTAMP'2024-01-01'), ('b', TIMESTAMP'2024-01-02'), "
                    "('c', TIMESTAMP'2024-01-03') AS t(k, ts)")
    tgt = spark.sql("SELECT TIMESTAMP'2024-01-02' AS ts")
    assert sorted(r.k for r in delta_since(src, tgt, "ts").collect()) == ["b", "c"]
    empty = spark.createDataFrame([], "ts timestamp")
    assert delta_since(src, empty, "ts").count() == 3


def test_keyed_table_replace_equals_rebuild(spark, scratch):
    t = KeyedTable(spark, f"{scratch}/fact", "k", n_buckets=4)
    t.overwrite(spark.createDataFrame([(f"w{i}", i) for i in range(20)], "k string, v int"))
    delta = spark.createDataFrame([("w1", 100), ("w1", 101), ("w25", 7)], "k string, v int")
    changed = spark.createDataFrame([("w1",), ("w2",), ("w3",)], "k string")
    t.replace_keys(delta, changed)
    got = sorted(tuple(r) for r in t.read().collect())
    expect = sorted([(f"w{i}", i) for i in range(20) if i not in (1, 2, 3)] + [("w1", 100), ("w1", 101), ("w25", 7)])
    assert got == expect
    t.replace_keys(delta, changed)  # replay: idempotent
    assert sorted(tuple(r) for r in t.read().collect()) == expect


def test_exercise_level_refresh_equals_full_rebuild(spark, scratch):
    from repsmith.plans import driver_tables as D
    from repsmith.plans import marts as M
    sf = "/root/testdata/sf0.001"
    st = D.staging(spark, sf)
    live = st["workouts"]
    dim = M.dim_exercise(st["templates"], st["crosswalk"])
    before_sets = st["sets"]
    # the increment: one workout loses its warm-ups and another is deleted entirely
    w_edit, w_del = [r.workout_id for r in before_sets.select("workout_id").distinct().orderBy("workout_id").limit(2).collect()]
    after_sets = before_sets.where(~((F.col("workout_id") == w_edit) & F.col("is_warmup")) & (F.col("workout_id") != w_del))
    after_live = live.withColumn("is_deleted", F.col("workout_id") == w_del)
    fs_before, fs_after = M.fct_set(before_sets, live, dim), M.fct_set(after_sets, after_live, dim)
    live_after = after_live.where(~F.col("is_deleted"))
    target = KeyedTable(spark, f"{scratch}/fes", "canonical_exercise", n_buckets=8)
    target.overwrite(M.fct_exercise_session(M.exercise_sessions(fs_before), live.where(~F.col("is_deleted"))))
    changed = spark.createDataFrame([(w_edit,), (w_del,)], "workout_id long")
    ex = M.affected_exercises(fs_before, fs_after, changed, live.where(~F.col("is_deleted")), live_after)
    target.replace_keys(M.exercise_session_refresh(fs_after, live_after, ex), ex)
    full = M.fct_exercise_session(M.exercise_sessions(fs_after), live_after)
    got = sorted(map(tuple, target.read().select(*full.columns).collect()), key=str)
    want = sorted(map(tuple, full.collect()), key=str)
    assert got == want
