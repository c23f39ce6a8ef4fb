"""Marts built from staging frames, shared by the JSON pipeline
(:mod:`repsmith.plans.staging`) and the driver-table recipe
(:mod:`repsmith.plans.driver_tables`).

Staging contract (column names, as the marts read them):

* workouts: workout_id, workout_date_local, workout_hour_local, part_of_day, day_of_week,
  day_of_week_number, is_weekend, duration_min, training_era, is_deleted, title,
  routine_id, created_at, updated_at (+ an optional entity column such as athlete_id)
* sets: workout_id, exercise_index, exercise_template_id, set_index, set_key, set_type,
  is_working_set, is_warmup, is_to_failure, is_dropset, weight_lb, weight_kg, reps, rpe,
  duration_seconds, distance_meters
* templates: exercise_template_id, exercise_title, exercise_type, primary_muscle_group,
  secondary_muscle_count, equipment, is_custom, is_bodyweight, weight_semantics
* crosswalk: exercise_template_id, canonical_exercise, movement_pattern, is_unilateral, is_compound
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repsmith.functions.scalars import has_estimated_load, positional_key, supports_load_metrics
from repsmith.operators.joins import zero_filled
from repsmith.operators.rollups import exercise_session_rollup, workout_rollup
from repsmith.operators.windows import (attach_day_level, attach_gap, day_level_features, day_level_table, day_number, gap_since_previous, pr_flag,
                                       previous_day_table, relative_performance, trailing_range_max)

FCT_SET_COLUMNS = [
    "set_key", "workout_id", "workout_date_local", "workout_hour_local", "training_era",
    "exercise_index", "set_index", "exercise_template_id", "canonical_exercise", "movement_pattern",
    "supports_load_metrics", "has_estimated_load", "set_type", "is_working_set", "is_warmup",
    "is_to_failure", "is_dropset", "weight_lb", "weight_kg", "reps", "rpe", "duration_seconds",
    "distance_meters", "updated_at",
]


def dim_exercise(templates: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Templates x crosswalk, inner (P7, J3): a template with no mapping is not in the dimension."""
    x = crosswalk.select("exercise_template_id", "canonical_exercise", "movement_pattern",
                         "is_unilateral", "is_compound")
    t = templates.select("exercise_template_id", "exercise_title", "primary_muscle_group",
                         "secondary_muscle_count", "equipment", "exercise_type", "is_custom",
                         "is_bodyweight", "weight_semantics")
    return (t.join(x, "exercise_template_id", "inner")
            .withColumn("supports_load_metrics", supports_load_metrics("exercise_type"))
            .withColumn("has_estimated_load", has_estimated_load("exercise_type")))


def fct_set(sets: DataFrame, workouts: DataFrame, dim: DataFrame, entity_cols: Sequence[str] = (),
            derive: Callable[..., DataFrame] | None = None) -> DataFrame:
    """Atomic set fact (P8): sets inner-join live workouts (J4, F2), left-join the dimension.

    Sets and workouts both grow with the data: they sort and merge, which spills, at any size. The
    dimension comes first, so the fact comes out dealt by workout, as the rollups per workout and the
    wide table need it, and is not dealt again. Its join has no hint: AQE makes it a broadcast where
    it is small; else it too merges and splits a hot exercise.

    ``sets`` may be narrower rows that hold workout_id and exercise_template_id, from which
    ``derive(rows, also)`` makes the staging columns, and keeps the columns ``also``: it runs behind
    the joins, which then shuffle the narrow rows."""
    w = workouts.where(~F.col("is_deleted")).select(
        "workout_id", *entity_cols, "workout_date_local", "workout_hour_local", "training_era", "updated_at")
    of_exercise = ["canonical_exercise", "movement_pattern", "supports_load_metrics", "has_estimated_load"]
    of_workout = [*entity_cols, "workout_date_local", "workout_hour_local", "training_era", "updated_at"]
    s = sets if derive else sets.select(
        "workout_id", *(["set_key"] if "set_key" in sets.columns else []), "exercise_index",
        "set_index", "exercise_template_id", "set_type", "is_working_set", "is_warmup",
        "is_to_failure", "is_dropset", "weight_lb", "weight_kg", "reps", "rpe", "duration_seconds",
        "distance_meters")
    out = s.join(dim.select("exercise_template_id", *of_exercise), "exercise_template_id", "left")
    out = out.join(w.hint("merge"), "workout_id", "inner")
    if derive:
        out = derive(out, (*of_exercise, *of_workout))
    if "set_key" not in out.columns:   # built from its integer parts after the joins
        out = out.withColumn("set_key", positional_key("workout_id", "exercise_index", "set_index"))
    return out.select(*FCT_SET_COLUMNS[:2], *entity_cols, *FCT_SET_COLUMNS[2:])


def fct_workout(workouts: DataFrame, sets: DataFrame, entity_cols: Sequence[str] = ()) -> DataFrame:
    """Workout fact (P9, A4, J6): live workouts with zero-filled set rollups.

    The rollup reads only set columns, so it is taken over the staging sets (or fct_set,
    same result): the left join from live workouts drops sets of deleted workouts, which
    is exactly the inner join fct_set applies, without re-running the dimension join."""
    w = workouts.where(~F.col("is_deleted")).select(
        "workout_id", *entity_cols, "title", "routine_id", "workout_date_local",
        F.col("workout_hour_local").alias("hour_local"), "part_of_day", "day_of_week",
        "day_of_week_number", "is_weekend", F.col("duration_min").alias("session_duration"),
        "training_era", "created_at", "updated_at")
    m = workout_rollup(sets)
    out = zero_filled(w, m, "workout_id", ["total_exercises", "total_sets", "total_working_sets"])
    return out.select("workout_id", *entity_cols, "title", "routine_id", "workout_date_local", "hour_local",
                      "part_of_day", "day_of_week", "day_of_week_number", "is_weekend", "session_duration",
                      "training_era", "total_exercises", "total_sets", "total_working_sets",
                      "created_at", "updated_at")


def exercise_sessions(fct_set_df: DataFrame, entity_cols: Sequence[str] = ()) -> DataFrame:
    """Workout x canonical exercise rollup of working sets."""
    return exercise_session_rollup(fct_set_df, extra_group_cols=entity_cols)


def workout_gaps(live_workouts: DataFrame, entity_cols: Sequence[str] = ()) -> DataFrame:
    """Days since the previous live workout (W3). ``live_workouts`` holds exactly the rows of
    fct_workout (non-deleted workouts, with or without sets), so the set rollup is not needed.
    With no entity column this is one global sequence, computed on the per-day table so no
    task holds all workouts."""
    wg = gap_since_previous(live_workouts.select("workout_id", *entity_cols, "workout_date_local"),
                            list(entity_cols), "workout_date_local", "workout_id", "days_since_last_workout")
    return wg.select("workout_id", "days_since_last_workout")


def with_workout_gap(df: DataFrame, live_workouts: DataFrame, entity_cols: Sequence[str] = ()) -> DataFrame:
    """Attach days since the previous live workout (W3) to rows carrying (entity, workout_id,
    workout_date_local). With no entity column they join the per-day table of live workouts, bounded
    by the calendar, on their date. With one, that table grows with the workouts, and the rows, which
    are dealt by workout, join the gap of theirs, so only a number per workout is shuffled."""
    if entity_cols:
        return df.join(workout_gaps(live_workouts, entity_cols).hint("merge"), "workout_id", "left")
    days = previous_day_table(live_workouts.select("workout_id", "workout_date_local"), [], "workout_date_local", "workout_id")
    return attach_gap(df, days, [], "workout_date_local", "workout_id", "days_since_last_workout")


def rest_intervals(sessions: DataFrame, live_workouts: DataFrame, entity_cols: Sequence[str] = ()) -> DataFrame:
    """Days since the last exposure to the same exercise (W2) and since the last workout."""
    s = with_workout_gap(sessions, live_workouts, entity_cols)
    return gap_since_previous(s, [*entity_cols, "canonical_exercise"], "workout_date_local",
                              "workout_id", "days_since_last_exposure")


TRAILING = {"working_e1rm_lb": "trailing_90d_max_e1rm_lb", "working_e1rm_kg": "trailing_90d_max_e1rm_kg"}


def session_days(sessions: DataFrame, entity_cols: Sequence[str] = ()) -> DataFrame:
    """Per exercise and day what the session fact takes from other sessions."""
    return day_level_table(sessions, [*entity_cols, "canonical_exercise"], "workout_date_local", "workout_id", TRAILING, many_keys=bool(entity_cols))


def workout_days(live_workouts: DataFrame, entity_cols: Sequence[str] = ()) -> DataFrame:
    """Per day what the session fact takes from other workouts."""
    return previous_day_table(live_workouts, list(entity_cols), "workout_date_local", "workout_id")


def session_facts_at(sessions: DataFrame, of_workouts: DataFrame, of_sessions: DataFrame, entity_cols: Sequence[str] = ()) -> DataFrame:
    """The rows of :func:`fct_exercise_session` of some sessions, from :func:`workout_days` and :func:`session_days` of all."""
    s = attach_gap(sessions, of_workouts, list(entity_cols), "workout_date_local", "workout_id", "days_since_last_workout")
    return _session_facts(attach_day_level(s, of_sessions, [*entity_cols, "canonical_exercise"], "workout_date_local", "workout_id",
                                           "days_since_last_exposure"), entity_cols)


def session_features(sessions: DataFrame, live_workouts: DataFrame, entity_cols: Sequence[str] = (),
                     partition_extra: Sequence[str] = (), lo: int = 90, hi: int = 1) -> DataFrame:
    """Rest intervals and trailing 90-day bests together: one per-(exercise, day) table
    carries both the lag and the range max, so the sessions are aggregated and joined
    back once. With ``partition_extra`` the baseline partition differs from the gap
    partition, so the two are computed separately."""
    keys = [*entity_cols, "canonical_exercise"]
    vals = TRAILING
    s = with_workout_gap(sessions, live_workouts, entity_cols)
    if partition_extra:
        r = gap_since_previous(s, keys, "workout_date_local", "workout_id", "days_since_last_exposure")
        return trailing_range_max(r, [*entity_cols, *partition_extra, "canonical_exercise"], "workout_date_local",
                                  vals, lo=lo, hi=hi)
    return day_level_features(s, keys, "workout_date_local", "workout_id", "days_since_last_exposure",
                              vals, lo=lo, hi=hi, many_keys=bool(entity_cols))


def fct_exercise_session(sessions: DataFrame, live_workouts: DataFrame, entity_cols: Sequence[str] = (),
                         partition_extra: Sequence[str] = (), lo: int = 90, hi: int = 1,
                         require_value: bool = False) -> DataFrame:
    """Session fact (P10): trailing 90-day best (W4), relative performance (W5), PR flag.

    ``partition_extra`` (e.g. ``["training_era"]``) keeps baselines from crossing eras.
    """
    return _session_facts(session_features(sessions, live_workouts, entity_cols, partition_extra, lo, hi), entity_cols, require_value)


def _session_facts(t: DataFrame, entity_cols: Sequence[str] = (), require_value: bool = False) -> DataFrame:
    return t.select(
        "workout_id", *entity_cols, "workout_date_local", "workout_hour_local", "training_era",
        "canonical_exercise", "movement_pattern", "working_e1rm_lb", "working_e1rm_kg",
        "trailing_90d_max_e1rm_lb", "trailing_90d_max_e1rm_kg",
        relative_performance("working_e1rm_lb", "trailing_90d_max_e1rm_lb").alias("relative_performance"),
        pr_flag("working_e1rm_lb", "trailing_90d_max_e1rm_lb", require_value).alias("is_pr"),
        "weight_lb", "weight_kg", "reps", "days_since_last_exposure", "days_since_last_workout",
        "has_intensity_technique", "supports_load_metrics", "has_estimated_load")


def obt_sets(fct_set_df: DataFrame, fct_workout_df: DataFrame, fct_session: DataFrame,
             entity_cols: Sequence[str] = ()) -> DataFrame:
    """One big table at set grain (P11). Columns that do not bind in the SQL original
    (B1) are sourced from the real workout columns under the same output names.

    Sets and sessions meet by workout, as the sets are dealt already, and the exercise is compared
    within it (two bounds, so that it is no join key): the wide rows are not shuffled once more."""
    w = fct_workout_df.select("workout_id", "part_of_day", "day_of_week", "day_of_week_number", "is_weekend",
                              F.col("session_duration").alias("workout_duration_min"),
                              F.col("total_exercises").alias("actual_exercise_count"),
                              F.col("title").alias("workout_title"), "routine_id")
    es = fct_session.select(F.col("workout_id").alias("__es_wid"),
                            F.col("canonical_exercise").alias("__es_can"),
                            "working_e1rm_lb", "trailing_90d_max_e1rm_lb", "relative_performance", "is_pr",
                            "days_since_last_exposure", "days_since_last_workout")
    s = fct_set_df.select(*FCT_SET_COLUMNS[:2], *entity_cols, *FCT_SET_COLUMNS[2:-1])
    j = s.join(w, "workout_id", "left")
    own, other = F.coalesce(j["canonical_exercise"], F.lit("")), F.coalesce(es["__es_can"], F.lit(""))
    cond = (j["workout_id"] == es["__es_wid"]) & (own >= other) & (own <= other)
    return j.join(es, cond, "left").drop("__es_wid", "__es_can")


def build_marts(workouts: DataFrame, sets: DataFrame, templates: DataFrame, crosswalk: DataFrame,
                entity_cols: Sequence[str] = (), derive: Callable[..., DataFrame] | None = None) -> dict[str, DataFrame]:
    """All marts, lazily, in dependency order. With ``entity_cols`` (e.g. ``["athlete_id"]``)
    gaps, baselines and PRs are per entity, and every fact carries the columns. ``derive`` as in
    :func:`fct_set`."""
    dim = dim_exercise(templates, crosswalk)
    fs = fct_set(sets, workouts, dim, entity_cols, derive)
    fw = fct_workout(workouts, derive(sets) if derive else sets, entity_cols)
    sess = exercise_sessions(fs, entity_cols)
    live = workouts.where(~F.col("is_deleted"))
    rest = rest_intervals(sess, live, entity_cols)
    fes = fct_exercise_session(sess, live, entity_cols)
    return {"dim_exercise": dim, "fct_set": fs, "fct_workout": fw, "int_exercise_sessions": sess,
            "int_exercise_rest_intervals": rest, "fct_exercise_session": fes,
            "obt_sets": obt_sets(fs, fw, fes, entity_cols)}


def dim_routine(routines: DataFrame, folders: DataFrame) -> DataFrame:
    """Routine dimension with its folder (designed, G2): left join, a routine without a
    folder keeps null folder attributes."""
    f = folders.select("folder_id", F.col("title").alias("folder_title"), "folder_index")
    return routines.select("routine_id", "title", "folder_id", "notes", "exercise_count").join(f, "folder_id", "left")


def affected_exercises(fct_set_before: DataFrame, fct_set_after: DataFrame, changed_workouts: DataFrame,
                       live_before: DataFrame, live_after: DataFrame) -> DataFrame:
    """Canonical exercises whose session facts an increment can change.

    * exercises the changed workouts contained before or contain after the change -- their
      later sessions move too (gap since last exposure, 90-day baseline), so the recompute
      unit is the exercise, not the workout;
    * exercises of every workout on a changed workout's date or on the next date with a
      live workout (before and after) -- the gap since the last *workout* is global, so
      those workouts' gaps can change although their exercises did not.

    The date lookups run on per-date tables, bounded by the calendar.
    """
    ids = changed_workouts.select("workout_id").distinct()
    dated = lambda live: live.select("workout_id", "workout_date_local")
    changed_dates = (dated(live_before).unionByName(dated(live_after))
                     .join(ids, "workout_id", "left_semi").select("workout_date_local").distinct())

    def next_dates(live: DataFrame) -> DataFrame:
        # the first live date strictly after each changed date: one range window over the
        # union of live days and changed dates (both bounded by the calendar)
        days = live.select("workout_date_local").distinct().withColumn("__live", F.lit(True))
        both = days.unionByName(changed_dates.withColumn("__live", F.lit(False)))
        w = Window.orderBy(day_number("workout_date_local")).rangeBetween(1, Window.unboundedFollowing)
        nxt = both.withColumn("__next", F.min(F.when(F.col("__live"), F.col("workout_date_local"))).over(w))
        return nxt.where(~F.col("__live") & F.col("__next").isNotNull()).select(
            F.col("__next").alias("workout_date_local"))

    dates = changed_dates.unionByName(next_dates(live_before)).unionByName(next_dates(live_after)).distinct()
    on_dates = lambda fs: fs.join(dates, "workout_date_local", "left_semi").select("canonical_exercise")
    of_changed = lambda fs: fs.join(ids, "workout_id", "left_semi").select("canonical_exercise")
    return (of_changed(fct_set_before).unionByName(of_changed(fct_set_after))
            .unionByName(on_dates(fct_set_before)).unionByName(on_dates(fct_set_after))
            .where(F.col("canonical_exercise").isNotNull()).distinct())


def exercise_session_refresh(fct_set_df: DataFrame, live_workouts: DataFrame, exercises: DataFrame,
                             entity_cols: Sequence[str] = ()) -> DataFrame:
    """The session fact recomputed for the given exercises only, over all their history. The
    per-exercise windows need nothing from other exercises, and the workout gap reads all
    live workouts, so the rows equal those of a full rebuild for these exercises."""
    fs = fct_set_df.join(exercises.select("canonical_exercise"), "canonical_exercise", "left_semi")
    return fct_exercise_session(exercise_sessions(fs, entity_cols), live_workouts, entity_cols)
