import json

from pyspark.sql import functions as F

import fixtures as FX
from repsmith.operators.incremental import KeyedTable
from repsmith.plans import staging as S
from repsmith.plans.driver_tables import seed_frame
from repsmith.sources import landing as L
from repsmith.streaming import changefeed as CF


def _land_all(spark, base, workouts, events, run):
    ts = F.lit("2024-07-01T00:00:00+00:00").cast("timestamp")
    L.land(spark.createDataFrame(FX.dumps(workouts), "record string"), base, "workouts", run, ts)
    L.land(spark.createDataFrame(FX.dumps(FX.TEMPLATES), "record string"), base, "exercise_templates", run, ts)
    if events:
        L.land(spark.createDataFrame(FX.dumps(events), "record string"), base, "workout_events", run, ts)


def _build(spark, base):
    bronze = {d: L.bronze(L.read_landed(spark, base, d)) for d in L.DATASETS}
    cw = seed_frame(spark, FX.CROSSWALK, ["exercise_template_id STRING", "source_title STRING",
                                          "canonical_exercise STRING", "movement_pattern STRING",
                                          "is_unilateral BOOLEAN", "is_compound BOOLEAN"])
    eras = seed_frame(spark, FX.ERAS, ["era STRING", "start_date DATE", "end_date DATE", "description STRING"])
    return S.build_all(bronze, cw, eras)


def test_json_pipeline_end_to_end(spark, scratch):
    base = f"{scratch}/bronze"
    _land_all(spark, base, FX.WORKOUTS_V1, [], "20240701T000000Z")
    m = _build(spark, base)
    w = {r.workout_id: r for r in m["stg_workouts"].collect()}
    assert len(w) == 10 and not any(r.is_deleted for r in w.values())     # missing feed -> empty, still binds
    assert str(w["w1"].workout_date_local) == "2024-03-01" and w["w1"].part_of_day == "evening"
    assert w["w1"].duration_min == 75 and w["w9"].training_era is None and w["w7"].exercise_count is None
    sets = m["stg_workout_sets"]
    assert sets.count() == 16                                           # w7/w8 have no sets
    ex = {(r.workout_id, r.exercise_index): r for r in m["stg_workout_exercises"].collect()}
    assert ex[("w1", 0)].notes is None and ex[("w1", 1)].is_superset
    s1 = {r.set_key: r for r in sets.collect()}
    assert s1["w1-0-1"].weight_lb == 90.0 and s1["w2-0-0"].weight_kg == 1.005
    fw = {r.workout_id: r for r in m["fct_workout"].collect()}
    assert fw["w7"].total_sets == 0 and fw["w1"].total_exercises == 2
    fes = {(r.workout_id, r.canonical_exercise): r for r in m["fct_exercise_session"].collect()}
    assert fes[("w1", "bench_press")].days_since_last_exposure is None
    assert fes[("w3", "bench_press")].days_since_last_exposure == 0          # same local day as w2
    assert fes[("w4", "bench_press")].trailing_90d_max_e1rm_lb is not None   # 89 days after w1
    assert fes[("w6", "bench_press")].working_e1rm_lb is None               # dropset only
    assert ("w3", None) not in fes                                          # unmapped exercise dropped
    assert m["obt_sets"].count() == 16


def test_feed_delete_and_update(spark, scratch):
    base = f"{scratch}/bronze"
    events = [{"type": "deleted", "id": "w2", "deleted_at": "2024-07-02T00:00:00Z"},
              {"type": "deleted", "id": "w3", "deleted_at": "2024-07-02T00:00:00Z"}]
    _land_all(spark, base, FX.WORKOUTS_V1, events, "r1")
    ts = F.lit("2024-07-03T00:00:00+00:00").cast("timestamp")
    upd = FX.workout("w3", "2024-03-02T15:00:00+00:00", "2024-03-02T15:20:00+00:00", [], updated="2024-07-03T00:00:00Z")
    L.land(spark.createDataFrame(FX.dumps([{"type": "updated", "workout": upd}]), "record string"),
           base, "workout_events", "r2", ts)
    m = _build(spark, base)
    flags = {r.workout_id: r.is_deleted for r in m["stg_workouts"].collect()}
    assert flags["w2"] and not flags["w3"]
    assert m["fct_set"].where("workout_id = 'w2'").count() == 0


def _set_rows(updated):
    from repsmith.operators.nested import explode_json_array
    from repsmith.functions.json import json_text
    e = explode_json_array(updated, "workout", "$.exercises", "ex")
    s = explode_json_array(e, "ex", "$.sets", "st")
    return s.select("workout_id", json_text("ex", "$.index").cast("int").alias("exercise_index"),
                    json_text("st", "$.index").cast("int").alias("set_index"),
                    json_text("st", "$.reps").cast("int").alias("reps"))


def test_streaming_feed_apply_is_idempotent(spark, scratch):
    land = f"{scratch}/bronze"
    target = KeyedTable(spark, f"{scratch}/fct", "workout_id", n_buckets=4)
    full = spark.createDataFrame(FX.dumps(FX.WORKOUTS_V1), "record string") \
        .select(F.get_json_object("record", "$.id").alias("workout_id"), F.col("record").alias("workout"))
    target.overwrite(_set_rows(full))
    before = target.read().count()
    ts = F.lit("2024-07-05T00:00:00+00:00").cast("timestamp")
    edited = FX.workout("w1", "2024-03-01T23:30:00+00:00", "2024-03-02T00:45:30+00:00",
                        [FX.exercise(0, "t-bench", [FX._set(0, "normal", 50, 3)])], updated="2024-07-05T00:00:00Z")
    events = [{"type": "updated", "workout": edited},
              {"type": "deleted", "id": "w2", "deleted_at": "2024-07-05T00:00:00Z"}]
    L.land(spark.createDataFrame(FX.dumps(events), "record string"), land, "workout_events", "r1", ts)
    q = CF.start(spark, f"{land}/workout_events", f"{scratch}/ckpt", target, _set_rows)
    q.awaitTermination()
    got = sorted(tuple(r) for r in target.read().collect())
    assert before - 7 - 2 + 1 == len(got)
    assert [r for r in got if r[0] == "w1"] == [("w1", 0, 0, 3)] and not [r for r in got if r[0] == "w2"]
    # replaying the same batch changes nothing
    CF.apply_batch(L.read_landed(spark, land, "workout_events").drop("ingest_date"), target, _set_rows)
    assert sorted(tuple(r) for r in target.read().collect()) == got
