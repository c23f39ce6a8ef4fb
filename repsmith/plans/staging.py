"""Staging models from landed JSON.

Each staging model starts from the latest version of every record (aggregate-based
latest-per-key, ties broken by content hash so the winner is deterministic, B6).
Workout documents are parsed once with ``from_json`` against a declared schema whose
leaves are text (offsets and number spellings survive), exercises and sets explode from
that one struct, and every leaf is cast explicitly. Small documents (templates,
routines, events) read single members with ``get_json_object``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repsmith.functions import scalars as X
from repsmith.functions.json import json_array_len, json_text
from repsmith.operators.cdc import latest_by_key, soft_delete_flags
from repsmith.functions.versions import version_order
from repsmith.operators.joins import range_join


# Declared document schema: every leaf is read as text and cast explicitly (no inference).
SET_FIELDS = ["index", "type", "weight_kg", "reps", "rpe", "duration_seconds", "distance_meters", "custom_metric"]
EXERCISE_FIELDS = ["index", "title", "exercise_template_id", "superset_id", "notes"]
WORKOUT_FIELDS = ["id", "title", "description", "routine_id", "start_time", "end_time", "created_at", "updated_at"]
WORKOUT_SCHEMA = (
    "struct<" + ", ".join(f"`{f}`: string" for f in WORKOUT_FIELDS)
    + ", `exercises`: array<struct<" + ", ".join(f"`{f}`: string" for f in EXERCISE_FIELDS)
    + ", `sets`: array<struct<" + ", ".join(f"`{f}`: string" for f in SET_FIELDS) + ">>>>>")


def _len(arr) -> "F.Column":
    """Array length with null for a missing / non-array member (json_array_length semantics)."""
    return F.when(arr.isNull(), F.lit(None).cast("long")).otherwise(F.size(arr).cast("long"))


def parsed_workouts(bronze_workouts: DataFrame) -> DataFrame:
    """Latest version of each workout, parsed once: (ingested_at, d) with ``d`` the document struct."""
    return latest(bronze_workouts).select("ingested_at", F.from_json("record", WORKOUT_SCHEMA).alias("d"))


def latest(bronze: DataFrame) -> DataFrame:
    """Latest landed version per record id (C5), by landing time, own time, hash."""
    return latest_by_key(bronze.select("record_id", "ingested_at", "record_hash", "record"),
                         "record_id", version_order())


def _ts(doc: str, path: str):
    return X.utc_instant(json_text(doc, path))


def stg_workouts(bronze_workouts: DataFrame, bronze_events: DataFrame, eras: DataFrame,
                 tz: str = X.DEFAULT_LOCAL_TZ) -> DataFrame:
    """One row per workout (P1), soft-delete flag from the latest change event."""
    w = parsed_workouts(bronze_workouts)
    start, end = X.utc_instant(F.col("d.start_time")), X.utc_instant(F.col("d.end_time"))
    r = w.select(
        F.col("d.id").alias("workout_id"), F.col("d.title").alias("title"),
        F.col("d.description").alias("description"), F.col("d.routine_id").alias("routine_id"),
        start.alias("started_at_utc"), end.alias("ended_at_utc"),
        X.to_local(start, tz).alias("started_at_local"), X.to_local(end, tz).alias("ended_at_local"),
        X.utc_instant(F.col("d.created_at")).alias("created_at"),
        X.utc_instant(F.col("d.updated_at")).alias("updated_at"),
        _len(F.col("d.exercises")).alias("exercise_count"),
        "ingested_at")
    loc = F.col("started_at_local")
    d = r.select("*",
                 F.to_date(loc).alias("workout_date_local"),
                 X.local_hour(loc).alias("workout_hour_local"),
                 X.part_of_day(X.local_hour(loc)).alias("part_of_day"),
                 X.day_name(loc).alias("day_of_week"),
                 X.iso_day_of_week(loc).alias("day_of_week_number"),
                 X.is_weekend(loc).alias("is_weekend"),
                 X.minutes_between("started_at_utc", "ended_at_utc").alias("duration_min"))
    d = range_join(d, eras.select(F.col("era").alias("training_era"), "start_date", "end_date"),
                   F.col("workout_date_local"), "start_date", "end_date", "left").drop("start_date", "end_date")
    flagged = soft_delete_flags(
        d, bronze_events.select("record_id", "ingested_at", "record_hash", "record"), "workout_id", "record_id",
        json_text("record", "$.type") == F.lit("deleted"),
        version_order(), _ts("record", "$.deleted_at"))
    return flagged.select(
        "workout_id", "title", "description", "routine_id", "started_at_utc", "ended_at_utc",
        "started_at_local", "ended_at_local", "workout_date_local", "workout_hour_local", "part_of_day",
        "day_of_week", "day_of_week_number", "is_weekend", "duration_min", "exercise_count", "training_era",
        "is_deleted", "created_at", "updated_at", "ingested_at")


def _exercises(bronze_workouts: DataFrame) -> DataFrame:
    w = parsed_workouts(bronze_workouts)
    return w.select(F.col("d.id").alias("workout_id"), F.explode("d.exercises").alias("e"))


def stg_workout_exercises(bronze_workouts: DataFrame) -> DataFrame:
    """One row per exercise within a workout."""
    e = _exercises(bronze_workouts)
    return e.select(
        "workout_id",
        X.lenient_int(F.col("e.index")).alias("exercise_index"),
        F.col("e.title").alias("exercise_title"),
        F.col("e.exercise_template_id").alias("exercise_template_id"),
        X.lenient_int(F.col("e.superset_id")).alias("superset_id"),
        F.col("e.superset_id").isNotNull().alias("is_superset"),
        X.nullif_blank(F.col("e.notes")).alias("notes"),
        _len(F.col("e.sets")).alias("set_count"))


def stg_workout_sets(bronze_workouts: DataFrame) -> DataFrame:
    """One row per logged set."""
    s = _exercises(bronze_workouts).select("workout_id", "e", F.explode("e.sets").alias("st"))
    st = F.col("st.type")
    kg = X.lenient_double(F.col("st.weight_kg"))
    ex_index = X.lenient_int(F.col("e.index"))
    return s.select(
        "workout_id",
        ex_index.alias("exercise_index"),
        F.col("e.title").alias("exercise_title"),
        F.col("e.exercise_template_id").alias("exercise_template_id"),
        X.lenient_int(F.col("st.index")).alias("set_index"),
        X.positional_key("workout_id", ex_index, F.col("st.index")).alias("set_key"),
        st.alias("set_type"),
        *[v.alias(k) for k, v in X.set_flags(st).items()],
        X.weight_lb(kg).alias("weight_lb"),
        X.weight_kg_canonical(kg).alias("weight_kg"),
        X.lenient_int(F.col("st.reps")).alias("reps"),
        X.lenient_double(F.col("st.rpe")).alias("rpe"),
        X.lenient_int(F.col("st.duration_seconds")).alias("duration_seconds"),
        X.lenient_double(F.col("st.distance_meters")).alias("distance_meters"),
        F.col("st.custom_metric").alias("custom_metric"))


def stg_exercise_templates(bronze_templates: DataFrame) -> DataFrame:
    """Exercise definitions (P4, X16, X30); secondary muscles kept as JSON."""
    t = latest(bronze_templates)
    et = json_text("record", "$.type")
    return t.select(
        json_text("record", "$.id").alias("exercise_template_id"),
        json_text("record", "$.title").alias("exercise_title"),
        et.alias("exercise_type"),
        json_text("record", "$.primary_muscle_group").alias("primary_muscle_group"),
        F.get_json_object("record", "$.secondary_muscle_groups").alias("secondary_muscle_groups"),
        json_array_len("record", "$.secondary_muscle_groups").alias("secondary_muscle_count"),
        json_text("record", "$.equipment").alias("equipment"),
        X.lenient_bool(json_text("record", "$.is_custom")).alias("is_custom"),
        X.is_bodyweight(et).alias("is_bodyweight"),
        X.weight_semantics(et).alias("weight_semantics"),
        "ingested_at")


def stg_routines(bronze_routines: DataFrame) -> DataFrame:
    """Routines, current state (P5)."""
    r = latest(bronze_routines)
    return r.select(
        json_text("record", "$.id").alias("routine_id"),
        json_text("record", "$.title").alias("title"),
        X.lenient_int(json_text("record", "$.folder_id")).alias("folder_id"),
        X.nullif_blank(json_text("record", "$.notes")).alias("notes"),
        json_array_len("record", "$.exercises").alias("exercise_count"),
        _ts("record", "$.created_at").alias("created_at"),
        _ts("record", "$.updated_at").alias("updated_at"),
        "ingested_at")


def stg_routine_folders(bronze_folders: DataFrame) -> DataFrame:
    """Routine folders."""
    f = latest(bronze_folders)
    return f.select(
        X.lenient_int(json_text("record", "$.id")).alias("folder_id"),
        json_text("record", "$.title").alias("title"),
        X.lenient_int(json_text("record", "$.index")).alias("folder_index"),
        _ts("record", "$.created_at").alias("created_at"),
        _ts("record", "$.updated_at").alias("updated_at"),
        "ingested_at")


def build_all(bronze: dict[str, DataFrame], crosswalk: DataFrame, eras: DataFrame,
              tz: str = X.DEFAULT_LOCAL_TZ) -> dict[str, DataFrame]:
    """Staging + marts from bronze frames keyed by dataset name."""
    from repsmith.plans.marts import build_marts
    w = stg_workouts(bronze["workouts"], bronze["workout_events"], eras, tz)
    s = stg_workout_sets(bronze["workouts"])
    t = stg_exercise_templates(bronze["exercise_templates"])
    out = {"stg_workouts": w, "stg_workout_exercises": stg_workout_exercises(bronze["workouts"]),
           "stg_workout_sets": s, "stg_exercise_templates": t}
    if "routines" in bronze:
        out["stg_routines"] = stg_routines(bronze["routines"])
    if "routine_folders" in bronze:
        out["stg_routine_folders"] = stg_routine_folders(bronze["routine_folders"])
    out.update(build_marts(w, s, t, crosswalk))
    return out
