"""DuckDB SQL for every registered query: the independent oracle the driver compares with.

Written the plain way -- ``row_number`` for latest-per-key, ``lag`` over rows for gaps,
a ``RANGE`` frame for the trailing max -- so each Spark rewrite (aggregate-based latest,
per-day windows joined back, bucketed range join) is checked against the direct form.
Fixed values repeat those of :mod:`repsmith.plans.driver_tables` and
:mod:`repsmith.plans.catalog`.
"""

from __future__ import annotations

from repsmith.plans import document_queries


def rnd(expr: str, d: int) -> str:
    """Half-away-from-zero rounding on the double, identical to ``scalars.round_half_away``."""
    s = f"{10 ** d}.0"
    return f"(sign({expr}) * floor(abs({expr}) * {s} + 0.5) / {s})"


LOCAL = "timezone('America/New_York', timezone('UTC', {c}))"

CTE: dict[str, tuple[list[str], str]] = {
    "eras": ([], """eras AS (
  SELECT * FROM (VALUES
    ('base', DATE '1995-01-01', DATE '1996-12-31'),
    ('volume', DATE '1997-03-01', DATE '1999-06-30'),
    ('hit', DATE '1999-07-01', DATE '9999-12-31')) t(era, start_date, end_date))"""),
    "wk_local": ([], f"""wk_local AS (
  SELECT o_orderkey AS workout_id, o_custkey AS athlete_id, o_orderpriority AS title,
         CAST(NULL AS VARCHAR) AS routine_id, o_orderdate AS started_at_utc,
         {LOCAL.format(c='o_orderdate')} AS started_at_local
  FROM orders)"""),
    "workouts": (["eras", "wk_local"], """workouts AS (
  SELECT w.workout_id, w.athlete_id, w.title, w.routine_id, w.started_at_utc, w.started_at_local,
         CAST(w.started_at_local AS DATE) AS workout_date_local,
         extract(hour FROM w.started_at_local) AS workout_hour_local,
         CASE WHEN extract(hour FROM w.started_at_local) < 5 THEN 'night'
              WHEN extract(hour FROM w.started_at_local) < 11 THEN 'morning'
              WHEN extract(hour FROM w.started_at_local) < 14 THEN 'midday'
              WHEN extract(hour FROM w.started_at_local) < 18 THEN 'afternoon'
              ELSE 'evening' END AS part_of_day,
         dayname(w.started_at_local) AS day_of_week,
         extract(isodow FROM w.started_at_local) AS day_of_week_number,
         extract(isodow FROM w.started_at_local) >= 6 AS is_weekend,
         CAST(NULL AS BIGINT) AS duration_min,
         false AS is_deleted,
         e.era AS training_era,
         w.started_at_utc AS created_at, w.started_at_utc AS updated_at
  FROM wk_local w
  LEFT JOIN eras e ON CAST(w.started_at_local AS DATE) BETWEEN e.start_date AND e.end_date)"""),
    "sets": ([], """sets AS (
  SELECT l_orderkey AS workout_id, l_partkey AS exercise_index, l_partkey AS exercise_template_id,
         l_linenumber AS set_index,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS set_key,
         st.set_type,
         st.set_type <> 'warmup' AS is_working_set,
         st.set_type = 'warmup' AS is_warmup,
         st.set_type = 'failure' AS is_to_failure,
         st.set_type = 'dropset' AS is_dropset,
         round(CAST(l_extendedprice / 2.20462 AS DOUBLE) * 2.20462, 2) AS weight_lb,
         round(CAST(l_extendedprice / 2.20462 AS DOUBLE), 3) AS weight_kg,
         CAST(l_quantity AS INTEGER) AS reps,
         round(6.0 + l_discount * 40.0, 1) AS rpe,
         CAST(NULL AS INTEGER) AS duration_seconds,
         CAST(NULL AS DOUBLE) AS distance_meters,
         l_shipdate
  FROM lineitem,
  LATERAL (SELECT CASE WHEN l_returnflag = 'R' THEN 'warmup'
                       WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'dropset'
                       WHEN l_returnflag = 'A' THEN 'failure'
                       ELSE 'normal' END AS set_type) st)"""),
    "templates": ([], """templates AS (
  SELECT p_partkey AS exercise_template_id, p_name AS exercise_title, xt.exercise_type,
         xt.exercise_type IN ('bodyweight_weighted', 'bodyweight_assisted', 'reps_only') AS is_bodyweight,
         CASE xt.exercise_type WHEN 'reps_only' THEN 'none'
                               WHEN 'bodyweight_weighted' THEN 'added_to_bodyweight'
                               WHEN 'bodyweight_assisted' THEN 'assistance_not_convertible'
                               ELSE 'external_load' END AS weight_semantics
  FROM part,
  LATERAL (SELECT CASE p_type WHEN 'ECONOMY' THEN 'weight_reps' WHEN 'LARGE' THEN 'weight_reps'
                              WHEN 'MEDIUM' THEN 'bodyweight_weighted' WHEN 'PROMO' THEN 'bodyweight_assisted'
                              WHEN 'SMALL' THEN 'reps_only' WHEN 'STANDARD' THEN 'duration' END AS exercise_type) xt)"""),
    "crosswalk": ([], """crosswalk AS (
  SELECT p_partkey AS exercise_template_id, p_name AS source_title,
         p_brand || ' ' || p_type AS canonical_exercise, p_type AS movement_pattern,
         p_size < 10 AS is_unilateral, p_retailprice >= 1500.0 AS is_compound
  FROM part WHERE p_size <= 45)"""),
    "dim_exercise": (["templates", "crosswalk"], """dim_exercise AS (
  SELECT t.exercise_template_id, t.exercise_title, x.canonical_exercise, x.movement_pattern,
         x.is_unilateral, x.is_compound, t.exercise_type, t.weight_semantics, t.is_bodyweight,
         t.exercise_type IN ('weight_reps', 'bodyweight_weighted') AS supports_load_metrics,
         t.weight_semantics = 'added_to_bodyweight' AS has_estimated_load
  FROM templates t JOIN crosswalk x ON t.exercise_template_id = x.exercise_template_id)"""),
    "fct_set": (["sets", "workouts", "dim_exercise"], """fct_set AS (
  SELECT s.set_key, s.workout_id, w.workout_date_local, w.workout_hour_local, w.training_era,
         s.exercise_index, s.set_index, s.exercise_template_id, e.canonical_exercise, e.movement_pattern,
         e.supports_load_metrics, e.has_estimated_load, s.set_type, s.is_working_set, s.is_warmup,
         s.is_to_failure, s.is_dropset, s.weight_lb, s.weight_kg, s.reps, s.rpe, s.duration_seconds,
         s.distance_meters, w.updated_at
  FROM sets s JOIN workouts w ON s.workout_id = w.workout_id
  LEFT JOIN dim_exercise e ON s.exercise_template_id = e.exercise_template_id
  WHERE w.is_deleted = false)"""),
    "fct_workout": (["workouts", "fct_set"], """fct_workout AS (
  SELECT w.workout_id, w.title, w.routine_id, w.workout_date_local, w.workout_hour_local AS hour_local,
         w.part_of_day, w.day_of_week, w.day_of_week_number, w.is_weekend, w.duration_min AS session_duration,
         w.training_era,
         coalesce(m.total_exercises, 0) AS total_exercises,
         coalesce(m.total_sets, 0) AS total_sets,
         coalesce(m.total_working_sets, 0) AS total_working_sets,
         w.created_at, w.updated_at
  FROM workouts w
  LEFT JOIN (SELECT workout_id, count(DISTINCT exercise_index) AS total_exercises, count(*) AS total_sets,
                    CAST(sum(CASE WHEN is_working_set THEN 1 ELSE 0 END) AS BIGINT) AS total_working_sets
             FROM fct_set GROUP BY workout_id) m ON w.workout_id = m.workout_id
  WHERE w.is_deleted = false)"""),
    "sessions": (["fct_set"], """sessions AS (
  SELECT workout_id, workout_date_local, workout_hour_local, training_era, canonical_exercise, movement_pattern,
         max(set_e1rm_lb) AS working_e1rm_lb, max(set_e1rm_kg) AS working_e1rm_kg,
         max(CASE WHEN NOT is_dropset THEN weight_lb END) AS weight_lb,
         max(CASE WHEN NOT is_dropset THEN weight_kg END) AS weight_kg,
         max(CASE WHEN NOT is_dropset THEN reps END) AS reps,
         bool_or(is_dropset) AS has_intensity_technique,
         bool_or(supports_load_metrics) AS supports_load_metrics,
         bool_or(has_estimated_load) AS has_estimated_load
  FROM (SELECT *,
          CASE WHEN NOT is_dropset THEN (CASE WHEN reps > 12 THEN NULL WHEN reps <= 0 THEN NULL
               WHEN weight_lb IS NULL THEN NULL ELSE weight_lb * (36.0 / (37.0 - reps)) END) END AS set_e1rm_lb,
          CASE WHEN NOT is_dropset THEN (CASE WHEN reps > 12 THEN NULL WHEN reps <= 0 THEN NULL
               WHEN weight_kg IS NULL THEN NULL ELSE weight_kg * (36.0 / (37.0 - reps)) END) END AS set_e1rm_kg
        FROM fct_set WHERE is_working_set = true) ws
  WHERE canonical_exercise IS NOT NULL
  GROUP BY workout_id, workout_date_local, workout_hour_local, training_era, canonical_exercise, movement_pattern)"""),
    "rest": (["sessions", "fct_workout"], """rest AS (
  SELECT s.*, e.days_since_last_exposure, w.days_since_last_workout
  FROM sessions s
  LEFT JOIN (SELECT workout_id, canonical_exercise,
                    date_diff('day', lag(workout_date_local) OVER (PARTITION BY canonical_exercise
                              ORDER BY workout_date_local, workout_id), workout_date_local) AS days_since_last_exposure
             FROM sessions) e ON s.workout_id = e.workout_id AND s.canonical_exercise = e.canonical_exercise
  LEFT JOIN (SELECT workout_id,
                    date_diff('day', lag(workout_date_local) OVER (ORDER BY workout_date_local, workout_id),
                              workout_date_local) AS days_since_last_workout
             FROM fct_workout) w ON s.workout_id = w.workout_id)"""),
    "fes": (["rest"], """fes AS (
  SELECT workout_id, workout_date_local, workout_hour_local, training_era, canonical_exercise, movement_pattern,
         working_e1rm_lb, working_e1rm_kg, trailing_90d_max_e1rm_lb, trailing_90d_max_e1rm_kg,
         CASE WHEN trailing_90d_max_e1rm_lb > 0 THEN working_e1rm_lb / trailing_90d_max_e1rm_lb ELSE NULL END
             AS relative_performance,
         CASE WHEN trailing_90d_max_e1rm_lb IS NULL THEN true
              WHEN working_e1rm_lb > trailing_90d_max_e1rm_lb THEN true ELSE false END AS is_pr,
         weight_lb, weight_kg, reps, days_since_last_exposure, days_since_last_workout,
         has_intensity_technique, supports_load_metrics, has_estimated_load
  FROM (SELECT *,
          max(working_e1rm_lb) OVER (PARTITION BY canonical_exercise ORDER BY workout_date_local
              RANGE BETWEEN INTERVAL '90' DAY PRECEDING AND INTERVAL '1' DAY PRECEDING) AS trailing_90d_max_e1rm_lb,
          max(working_e1rm_kg) OVER (PARTITION BY canonical_exercise ORDER BY workout_date_local
              RANGE BETWEEN INTERVAL '90' DAY PRECEDING AND INTERVAL '1' DAY PRECEDING) AS trailing_90d_max_e1rm_kg
        FROM rest) t)"""),
    "fes_athlete": (["sessions", "workouts"], """sessions_athlete AS (
  SELECT s.*, w.athlete_id FROM sessions s JOIN workouts w ON s.workout_id = w.workout_id),
workout_gaps_athlete AS (
  SELECT workout_id, date_diff('day', lag(workout_date_local) OVER (PARTITION BY athlete_id
                               ORDER BY workout_date_local, workout_id), workout_date_local) AS days_since_last_workout
  FROM workouts),
baseline_athlete AS (
  SELECT s.*, g.days_since_last_workout,
         date_diff('day', lag(s.workout_date_local) OVER (PARTITION BY s.athlete_id, s.canonical_exercise
                   ORDER BY s.workout_date_local, s.workout_id), s.workout_date_local) AS days_since_last_exposure,
         (SELECT max(p.working_e1rm_lb) FROM sessions_athlete p
          WHERE p.athlete_id = s.athlete_id AND p.canonical_exercise = s.canonical_exercise
            AND p.workout_date_local BETWEEN s.workout_date_local - 90 AND s.workout_date_local - 1) AS trailing_90d_max_e1rm_lb,
         (SELECT max(p.working_e1rm_kg) FROM sessions_athlete p
          WHERE p.athlete_id = s.athlete_id AND p.canonical_exercise = s.canonical_exercise
            AND p.workout_date_local BETWEEN s.workout_date_local - 90 AND s.workout_date_local - 1) AS trailing_90d_max_e1rm_kg
  FROM sessions_athlete s JOIN workout_gaps_athlete g ON s.workout_id = g.workout_id),
fes_athlete AS (
  SELECT workout_id, athlete_id, workout_date_local, workout_hour_local, training_era, canonical_exercise, movement_pattern,
         working_e1rm_lb, working_e1rm_kg, trailing_90d_max_e1rm_lb, trailing_90d_max_e1rm_kg,
         CASE WHEN trailing_90d_max_e1rm_lb > 0 THEN working_e1rm_lb / trailing_90d_max_e1rm_lb END AS relative_performance,
         trailing_90d_max_e1rm_lb IS NULL OR coalesce(working_e1rm_lb > trailing_90d_max_e1rm_lb, false) AS is_pr,
         weight_lb, weight_kg, reps, days_since_last_exposure, days_since_last_workout,
         has_intensity_technique, supports_load_metrics, has_estimated_load
  FROM baseline_athlete)"""),
    "ev_local": ([], f"""ev_local AS (
  SELECT *, {LOCAL.format(c='ts')} AS started_at_local FROM events)"""),
}


def with_ctes(*names: str, body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTE[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(CTE[n][1] for n in order) + "\n" + body


FCT_SET_COLS = ("set_key, workout_id, workout_date_local, workout_hour_local, training_era, exercise_index, set_index, "
                "exercise_template_id, canonical_exercise, movement_pattern, supports_load_metrics, has_estimated_load, "
                "set_type, is_working_set, is_warmup, is_to_failure, is_dropset, weight_lb, weight_kg, reps, rpe, "
                "duration_seconds, distance_meters")

LATEST_EVENT = """(SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)"""

DURATION_END = "make_timestamp(epoch_us(ts) + CAST(floor(value * 60000000.0) AS BIGINT))"

ORACLES: dict[str, str] = {
    "latest_by_key": f"""
SELECT user_id, event_id, ts, event_type, value FROM {LATEST_EVENT} t WHERE rn = 1""",

    "dedupe_last_wins": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                 l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
      FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL) t WHERE rn = 1
UNION ALL
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL""",

    "changed_only": """
WITH hashed AS (SELECT *, md5(concat_ws('|', event_type, CAST(value AS VARCHAR), props)) AS h FROM events),
incoming AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
                            FROM hashed) t WHERE rn = 1),
stored_latest AS (SELECT user_id, h FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
                  FROM hashed WHERE ts < TIMESTAMP '2024-01-16 00:00:00') t WHERE rn = 1)
SELECT i.user_id, i.event_id, i.ts, i.event_type, i.value FROM incoming i
WHERE NOT EXISTS (SELECT 1 FROM stored_latest s WHERE s.user_id = i.user_id AND s.h = i.h)""",

    "feed_split_counts": """
SELECT CASE WHEN event_type = 'error' THEN 'deleted' ELSE 'updated' END AS op, count(*) AS n_events
FROM events GROUP BY 1""",

    "soft_delete_flag": f"""
SELECT c.c_custkey, d.deleted_at IS NOT NULL AS is_deleted, d.deleted_at
FROM customer c
LEFT JOIN (SELECT user_id, ts AS deleted_at FROM {LATEST_EVENT} t WHERE rn = 1 AND event_type = 'error') d
  ON c.c_custkey = d.user_id""",

    "high_water_mark": """
SELECT op, count(*) AS n_events,
       coalesce(max(ts), TIMESTAMP '1970-01-01') + INTERVAL 1 MILLISECOND AS high_water,
       strftime(coalesce(max(ts), TIMESTAMP '1970-01-01') + INTERVAL 1 MILLISECOND, '%Y-%m-%dT%H:%M:%S.%fZ') AS high_water_iso
FROM (SELECT *, CASE WHEN event_type = 'error' THEN 'deleted' ELSE 'updated' END AS op FROM events) t
GROUP BY op""",

    "json_field_extract": """
WITH env AS (
  SELECT event_id, props,
         CASE WHEN event_type = 'error' THEN json_object('type', 'deleted', 'id', event_id)
              ELSE json_object('type', 'updated', 'workout', json_object('id', event_id, 'title', event_type)) END AS envelope
  FROM events)
SELECT event_id, CAST(props ->> 'k' AS BIGINT) AS k, props ->> 'missing' AS missing,
       CASE WHEN json_type(envelope, '$.workout') = 'OBJECT' THEN envelope -> 'workout' ->> 'id'
            ELSE envelope ->> 'id' END AS record_id,
       envelope ->> 'type' AS envelope_type,
       envelope -> 'workout' ->> 'title' AS workout_title
FROM env""",

    "nested_flatten": """
SELECT l_orderkey AS workout_id, l_partkey AS exercise_index, l_linenumber AS set_index,
       CAST(l_quantity AS INTEGER) AS reps, l_extendedprice / 2.20462 AS weight_kg,
       CASE WHEN l_returnflag = 'R' THEN 'warmup' WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'dropset'
            WHEN l_returnflag = 'A' THEN 'failure' ELSE 'normal' END AS set_type
FROM lineitem""",

    "nested_count_parity": """
SELECT count(*) AS raw_sets, count(*) AS flat_sets, true AS counts_match FROM lineitem""",

    "paged_flatten": """
SELECT CAST(floor(o_orderkey / 10) AS BIGINT) AS page,
       (SELECT count(DISTINCT CAST(floor(o_orderkey / 10) AS BIGINT)) FROM orders) AS page_count,
       o_orderkey AS workout_id, o_totalprice
FROM orders""",

    "positional_key": """
SELECT l_orderkey, l_linenumber,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS set_key
FROM lineitem""",

    "embedding_unnest": """
SELECT vec_id, label, CAST(len(embedding) AS BIGINT) AS dims, count(*) AS n_elements, CAST(max(pos) AS BIGINT) AS last_pos
FROM (SELECT vec_id, label, embedding, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings) t
GROUP BY vec_id, label, embedding""",

    "local_time_parts": """
SELECT event_id, started_at_local, CAST(started_at_local AS DATE) AS local_date,
       extract(hour FROM started_at_local) AS local_hour, dayname(started_at_local) AS day_of_week,
       extract(isodow FROM started_at_local) AS day_of_week_number,
       extract(isodow FROM started_at_local) >= 6 AS is_weekend,
       CASE WHEN extract(hour FROM started_at_local) < 5 THEN 'night'
            WHEN extract(hour FROM started_at_local) < 11 THEN 'morning'
            WHEN extract(hour FROM started_at_local) < 14 THEN 'midday'
            WHEN extract(hour FROM started_at_local) < 18 THEN 'afternoon'
            ELSE 'evening' END AS part_of_day
FROM ev_local""",

    "part_of_day_counts": """
SELECT CASE WHEN extract(hour FROM started_at_local) < 5 THEN 'night'
            WHEN extract(hour FROM started_at_local) < 11 THEN 'morning'
            WHEN extract(hour FROM started_at_local) < 14 THEN 'midday'
            WHEN extract(hour FROM started_at_local) < 18 THEN 'afternoon'
            ELSE 'evening' END AS part_of_day, count(*) AS n_events
FROM ev_local GROUP BY 1""",

    "utc_local_straddle": """
SELECT event_type, count(*) AS n_events,
       count(*) FILTER (WHERE CAST(ts AS DATE) <> CAST(started_at_local AS DATE)) AS n_straddle
FROM ev_local GROUP BY event_type""",

    "duration_minutes": f"""
SELECT event_id, {DURATION_END} AS ended_at, date_diff('minute', ts, {DURATION_END}) AS duration_min
FROM events""",

    "e1rm": """
SELECT workout_id AS l_orderkey, set_index AS l_linenumber, exercise_template_id AS l_partkey, reps, weight_lb, weight_kg,
       CASE WHEN reps > 12 THEN NULL WHEN reps <= 0 THEN NULL WHEN weight_lb IS NULL THEN NULL
            ELSE weight_lb * (36.0 / (37.0 - reps)) END AS e1rm_lb,
       CASE WHEN reps > 12 THEN NULL WHEN reps <= 0 THEN NULL WHEN weight_kg IS NULL THEN NULL
            ELSE weight_kg * (36.0 / (37.0 - reps)) END AS e1rm_kg,
       CASE WHEN reps > 12 OR reps <= 0 OR weight_lb IS NULL THEN NULL
            ELSE weight_lb * (1.0 + CAST(reps AS DOUBLE) / 30.0) END AS epley_lb
FROM sets""",

    "weight_canonical": """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_extendedprice / 2.20462 AS weight_kg_raw,
       round(l_extendedprice / 2.20462 * 2.20462, 2) AS weight_lb, round(l_extendedprice / 2.20462, 3) AS weight_kg
FROM lineitem""",

    "weight_semantics_case": """
SELECT exercise_template_id, exercise_type, weight_semantics, is_bodyweight,
       exercise_type IN ('weight_reps', 'bodyweight_weighted') AS supports_load_metrics,
       weight_semantics = 'added_to_bodyweight' AS has_estimated_load
FROM templates""",

    "null_blank_text": """
SELECT doc_id, nullif(trim(text), '') IS NULL AS notes_is_null,
       CAST(length(nullif(trim(text), '')) AS BIGINT) AS notes_chars,
       CAST(length(text) - coalesce(length(nullif(trim(text), '')), 0) AS BIGINT) AS trimmed_chars
FROM documents""",

    "era_range_join": """
SELECT workout_id AS o_orderkey, workout_date_local, training_era FROM workouts""",

    "dim_inner_join": """
SELECT exercise_template_id, exercise_title, canonical_exercise, movement_pattern, is_unilateral, is_compound,
       exercise_type, weight_semantics, is_bodyweight, supports_load_metrics, has_estimated_load
FROM dim_exercise""",

    "fact_left_join": f"SELECT {FCT_SET_COLS}, updated_at FROM fct_set",

    "unmapped_keys_anti": """
SELECT s.exercise_template_id, max(t.exercise_title) AS exercise_title, count(DISTINCT s.workout_id) AS sessions_affected
FROM sets s
LEFT JOIN crosswalk x ON s.exercise_template_id = x.exercise_template_id
LEFT JOIN templates t ON s.exercise_template_id = t.exercise_template_id
WHERE x.exercise_template_id IS NULL
GROUP BY s.exercise_template_id""",

    "session_rollup": """
SELECT workout_id, title, workout_date_local, hour_local, part_of_day, day_of_week, day_of_week_number,
       is_weekend, training_era, total_exercises, total_sets, total_working_sets
FROM fct_workout""",

    "exercise_session_rollup": "SELECT * FROM sessions",

    "gap_since_last_exposure": """
SELECT workout_id, canonical_exercise, workout_date_local, days_since_last_exposure FROM rest""",

    "gap_since_last_workout": """
SELECT workout_id, workout_date_local,
       date_diff('day', lag(workout_date_local) OVER (ORDER BY workout_date_local, workout_id), workout_date_local)
           AS days_since_last_workout
FROM fct_workout""",

    "gap_since_last_workout_by_athlete": """
SELECT workout_id, athlete_id, workout_date_local,
       date_diff('day', lag(workout_date_local) OVER (PARTITION BY athlete_id ORDER BY workout_date_local, workout_id),
                 workout_date_local) AS days_since_last_workout
FROM workouts""",

    "trailing_90d_max": """
SELECT workout_id, canonical_exercise, workout_date_local, working_e1rm_lb, trailing_90d_max_e1rm_lb,
       trailing_90d_max_e1rm_kg FROM fes""",

    "relative_performance": "SELECT workout_id, canonical_exercise, relative_performance FROM fes",

    "pr_flags": "SELECT workout_id, canonical_exercise, is_pr FROM fes",

    "exercise_session_fact": "SELECT * FROM fes",

    "trailing_median": f"""
SELECT workout_id, canonical_exercise, {rnd('m', 6)} AS trailing_90d_median_e1rm_lb
FROM (SELECT workout_id, canonical_exercise,
        quantile_cont(working_e1rm_lb, 0.5) OVER (PARTITION BY canonical_exercise ORDER BY workout_date_local
            RANGE BETWEEN INTERVAL '90' DAY PRECEDING AND INTERVAL '1' DAY PRECEDING) AS m
      FROM sessions) t""",

    "incremental_key_replace": """
SELECT s.workout_id, s.set_key, s.set_index, s.reps, s.weight_lb, s.set_type
FROM sets s JOIN orders o ON s.workout_id = o.o_orderkey
WHERE o.o_orderstatus <> 'P'""",

    "delta_keys_semi": """
SELECT s.workout_id, s.set_key, w.updated_at
FROM sets s JOIN workouts w ON s.workout_id = w.workout_id
WHERE s.workout_id IN (
  SELECT workout_id FROM workouts
  WHERE updated_at >= (SELECT coalesce(max(w2.updated_at), TIMESTAMP '1970-01-01')
                       FROM sets s2 JOIN workouts w2 ON s2.workout_id = w2.workout_id
                       WHERE w2.updated_at < TIMESTAMP '1999-01-01 00:00:00'))""",

    "obt_wide": f"""
SELECT {', '.join('s.' + c.strip() for c in FCT_SET_COLS.split(','))},
       w.part_of_day, w.day_of_week, w.day_of_week_number, w.is_weekend,
       w.session_duration AS workout_duration_min, w.total_exercises AS actual_exercise_count,
       w.title AS workout_title, w.routine_id,
       es.working_e1rm_lb, es.trailing_90d_max_e1rm_lb, es.relative_performance, es.is_pr,
       es.days_since_last_exposure, es.days_since_last_workout
FROM fct_set s
LEFT JOIN fct_workout w ON s.workout_id = w.workout_id
LEFT JOIN fes es ON s.workout_id = es.workout_id
  AND coalesce(s.canonical_exercise, '') = coalesce(es.canonical_exercise, '')""",

    "check_unique": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",

    "check_unique_passes": """
SELECT 'orders.o_orderkey' AS "check", count(*) AS n_failing
FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1) t
UNION ALL
SELECT 'customer.c_custkey', count(*) FROM (SELECT c_custkey FROM customer GROUP BY c_custkey HAVING count(*) > 1) t
UNION ALL
SELECT 'lineitem.l_orderkey_l_linenumber', count(*)
FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) t""",

    "check_not_null": """
SELECT column_name, n_null FROM (
  SELECT 'canonical_exercise' AS column_name, count(*) FILTER (WHERE canonical_exercise IS NULL) AS n_null FROM fct_set
  UNION ALL SELECT 'movement_pattern', count(*) FILTER (WHERE movement_pattern IS NULL) FROM fct_set
  UNION ALL SELECT 'training_era', count(*) FILTER (WHERE training_era IS NULL) FROM fct_set
  UNION ALL SELECT 'weight_lb', count(*) FILTER (WHERE weight_lb IS NULL) FROM fct_set
  UNION ALL SELECT 'reps', count(*) FILTER (WHERE reps IS NULL) FROM fct_set
  UNION ALL SELECT 'rpe', count(*) FILTER (WHERE rpe IS NULL) FROM fct_set
  UNION ALL SELECT 'set_type', count(*) FILTER (WHERE set_type IS NULL) FROM fct_set
  UNION ALL SELECT 'supports_load_metrics', count(*) FILTER (WHERE supports_load_metrics IS NULL) FROM fct_set
  UNION ALL SELECT 'duration_seconds', count(*) FILTER (WHERE duration_seconds IS NULL) FROM fct_set) t""",

    "check_accepted_values": """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderpriority IS NOT NULL
  AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')""",

    "check_relationships": """
SELECT 'fct_set.exercise_template_id->dim_exercise' AS relationship, f.exercise_template_id AS child_key, count(*) AS n_rows
FROM fct_set f WHERE f.exercise_template_id IS NOT NULL
  AND f.exercise_template_id NOT IN (SELECT exercise_template_id FROM dim_exercise WHERE exercise_template_id IS NOT NULL)
GROUP BY f.exercise_template_id
UNION ALL
SELECT 'sets.workout_id->workouts', s.workout_id, count(*)
FROM sets s WHERE s.workout_id IS NOT NULL
  AND s.workout_id NOT IN (SELECT workout_id FROM workouts WHERE workout_id IS NOT NULL)
GROUP BY s.workout_id""",

    "check_rollup_parity": """
SELECT (SELECT count(*) FROM fct_workout WHERE total_sets > 0) AS workouts_compared,
       (SELECT count(*) FROM (SELECT w.workout_id FROM (SELECT * FROM fct_workout WHERE total_sets > 0) w
          FULL OUTER JOIN (SELECT workout_id, count(*) AS n, sum(CASE WHEN is_working_set THEN 1 ELSE 0 END) AS nw
                           FROM fct_set GROUP BY workout_id) a ON w.workout_id = a.workout_id
          WHERE w.total_sets IS DISTINCT FROM a.n OR w.total_working_sets IS DISTINCT FROM a.nw) t) AS workouts_mismatched""",

    "check_sanity_guards": f"""
SELECT 'local_time_offset_applied' AS "check", count(*) FILTER (WHERE started_at_local = ts) AS n_failing FROM ev_local
UNION ALL
SELECT 'duration_sane_0_480', count(*) FILTER (WHERE date_diff('minute', ts, {DURATION_END}) < 0
                                               OR date_diff('minute', ts, {DURATION_END}) > 480) FROM events""",

    "value_histogram": """
SELECT 'set_type' AS histogram, set_type AS bucket, count(*) AS n FROM fct_set GROUP BY set_type
UNION ALL
SELECT 'local_hour', CAST(extract(hour FROM started_at_local) AS VARCHAR), count(*) FROM ev_local GROUP BY 2
UNION ALL
SELECT 'workout_day_of_week', day_of_week, count(*) FROM workouts GROUP BY day_of_week""",

    "unit_provenance": """
WITH w AS (SELECT DISTINCT weight_lb AS x FROM fct_set WHERE weight_lb IS NOT NULL)
SELECT CASE WHEN abs(x / 0.25 - round_even(x / 0.25, 0)) * 0.25 < 0.01 THEN 'lb_native'
            WHEN abs((x / 2.20462) / 0.5 - round_even((x / 2.20462) / 0.5, 0)) * 0.5 < 0.01 THEN 'kg_native'
            ELSE 'unexplained' END AS provenance, count(*) AS n_weights
FROM w GROUP BY 1""",

    "reconcile_diff": """
SELECT coalesce(e.workout_id, a.workout_id) AS workout_id, e.n_sets AS expected_n_sets, a.n_sets AS actual_n_sets
FROM (SELECT l_orderkey AS workout_id, count(*) AS n_sets FROM lineitem GROUP BY l_orderkey) e
FULL OUTER JOIN (SELECT workout_id, count(*) AS n_sets FROM fct_set WHERE canonical_exercise IS NOT NULL
                 GROUP BY workout_id) a ON e.workout_id = a.workout_id
WHERE e.n_sets IS DISTINCT FROM a.n_sets""",

    "newest_record_listing": """
SELECT s.workout_id, w.title, w.hour_local, w.total_exercises, s.exercise_index, s.set_index, s.set_type, s.weight_lb, s.reps
FROM fct_set s JOIN fct_workout w ON s.workout_id = w.workout_id
WHERE s.workout_id = (SELECT workout_id FROM workouts ORDER BY started_at_utc DESC, workout_id DESC LIMIT 1)""",

    "recovery_curve_buckets": f"""
SELECT CASE WHEN days_since_last_exposure >= 7 THEN '7+' ELSE CAST(days_since_last_exposure AS VARCHAR) END AS rest_bucket,
       count(*) AS n, {rnd('avg(relative_performance)', 6)} AS mean_relative_performance,
       {rnd('quantile_cont(relative_performance, 0.5)', 6)} AS median_relative_performance
FROM fes WHERE relative_performance IS NOT NULL GROUP BY 1""",

    "recovery_trend_ols": f"""
SELECT movement_pattern AS trend_group,
       {rnd('regr_slope(relative_performance, days_since_last_exposure)', 9)} AS slope,
       {rnd('regr_intercept(relative_performance, days_since_last_exposure)', 9)} AS intercept,
       {rnd('regr_r2(relative_performance, days_since_last_exposure)', 9)} AS r2,
       CAST(regr_count(relative_performance, days_since_last_exposure) AS BIGINT) AS n
FROM fes WHERE relative_performance IS NOT NULL AND days_since_last_exposure IS NOT NULL
  AND (SELECT count(*) FROM fes WHERE relative_performance IS NOT NULL AND days_since_last_exposure IS NOT NULL) > 3
GROUP BY movement_pattern""",

    "time_of_day_quartiles": f"""
SELECT extract(hour FROM started_at_local) AS local_hour, count(*) AS n, min(value) AS min_value,
       max(value) AS max_value, {rnd('quantile_cont(value, 0.25)', 6)} AS q1,
       {rnd('quantile_cont(value, 0.5)', 6)} AS median, {rnd('quantile_cont(value, 0.75)', 6)} AS q3
FROM ev_local WHERE value IS NOT NULL GROUP BY 1""",

    "time_of_day_by_weekday": f"""
SELECT extract(isodow FROM started_at_local) AS day_of_week_number, extract(hour FROM started_at_local) AS local_hour,
       count(*) AS n, {rnd('quantile_cont(value, 0.5)', 6)} AS median
FROM ev_local WHERE value IS NOT NULL GROUP BY 1, 2""",

    "recent_prs": """
SELECT workout_date_local, canonical_exercise, working_e1rm_lb, trailing_90d_max_e1rm_lb, reps, weight_lb, workout_id
FROM fes WHERE is_pr""",

    "min_sample_pooling": f"""
WITH s AS (SELECT * FROM fes WHERE relative_performance IS NOT NULL),
c AS (SELECT training_era, canonical_exercise, count(*) AS n_fine FROM s GROUP BY 1, 2),
t AS (SELECT s.*, CASE WHEN c.n_fine >= 10 THEN s.canonical_exercise ELSE s.movement_pattern END AS analysis_group,
             CASE WHEN c.n_fine >= 10 THEN 'canonical_exercise' ELSE 'movement_pattern' END AS group_level
      FROM s LEFT JOIN c ON s.training_era IS NOT DISTINCT FROM c.training_era
                        AND s.canonical_exercise IS NOT DISTINCT FROM c.canonical_exercise)
SELECT training_era, group_level, analysis_group, count(*) AS n_sessions,
       {rnd('avg(relative_performance)', 6)} AS mean_relative_performance
FROM t GROUP BY 1, 2, 3""",

    "progression_trend": f"""
SELECT canonical_exercise, training_era,
       {rnd("regr_slope(working_e1rm_lb, CAST(date_diff('day', DATE '1970-01-01', workout_date_local) AS DOUBLE))", 4)} AS slope_per_day,
       CAST(count(*) AS BIGINT) AS n
FROM fes WHERE working_e1rm_lb IS NOT NULL GROUP BY 1, 2
HAVING count(*) >= 3 AND count(DISTINCT workout_date_local) >= 2""",

    "reps_at_load": """
SELECT workout_id, canonical_exercise, weight_lb AS top_weight_lb, reps AS reps_at_top_weight
FROM (SELECT *, row_number() OVER (PARTITION BY workout_id, canonical_exercise
                                   ORDER BY weight_lb DESC, reps DESC NULLS LAST) AS rn
      FROM fct_set WHERE is_working_set AND canonical_exercise IS NOT NULL AND NOT is_dropset
        AND weight_lb IS NOT NULL) t
WHERE rn = 1""",

    "date_dimension": """
WITH b AS (SELECT min(workout_date_local) AS lo, max(workout_date_local) AS hi FROM fct_workout),
cal AS (SELECT CAST(d AS DATE) AS date_day FROM b, generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) g(d)),
per_day AS (SELECT workout_date_local AS date_day, count(*) AS n_rows FROM fct_workout GROUP BY 1)
SELECT c.date_day, CAST(year(c.date_day) AS BIGINT) AS year, CAST(month(c.date_day) AS BIGINT) AS month,
       CAST(day(c.date_day) AS BIGINT) AS day_of_month, isodow(c.date_day) AS day_of_week_number,
       dayname(c.date_day) AS day_of_week, isodow(c.date_day) >= 6 AS is_weekend,
       CAST(weekofyear(c.date_day) AS BIGINT) AS iso_week, coalesce(p.n_rows, 0) AS n_rows
FROM cal c LEFT JOIN per_day p ON c.date_day = p.date_day""",

    "era_month_summary": f"""
WITH per_ex AS (SELECT workout_id, exercise_index, count(*) AS ws,
                       sum(CASE WHEN is_to_failure THEN 1 ELSE 0 END) AS fail
                FROM fct_set WHERE is_working_set GROUP BY 1, 2),
w AS (SELECT workout_id, training_era, date_trunc('month', workout_date_local) AS month FROM fct_workout),
ex AS (SELECT w.training_era, w.month, {rnd('avg(ws)', 6)} AS avg_working_sets_per_exercise,
              {rnd('avg(CASE WHEN ws = 1 THEN 1.0 ELSE 0.0 END)', 6)} AS share_single_set,
              CAST(sum(fail) AS BIGINT) AS failure_sets
       FROM per_ex p JOIN w ON p.workout_id = w.workout_id GROUP BY 1, 2),
wk AS (SELECT training_era, month, count(*) AS workouts FROM w GROUP BY 1, 2)
SELECT wk.training_era, CAST(wk.month AS DATE) AS month, wk.workouts, ex.avg_working_sets_per_exercise,
       ex.share_single_set, ex.failure_sets
FROM wk LEFT JOIN ex ON wk.training_era IS NOT DISTINCT FROM ex.training_era AND wk.month = ex.month""",

    "gap_distribution": f"""
WITH g AS (SELECT training_era,
             date_diff('day', lag(workout_date_local) OVER (PARTITION BY athlete_id ORDER BY workout_date_local, workout_id),
                       workout_date_local) AS gap
           FROM workouts)
SELECT training_era, count(*) AS n_gaps, {rnd('avg(CASE WHEN gap BETWEEN 1 AND 2 THEN 1.0 ELSE 0.0 END)', 6)} AS share_1_2_days,
       max(gap) AS max_gap
FROM g WHERE gap IS NOT NULL GROUP BY training_era""",

    "effort_summary": f"""
SELECT training_era, count(*) AS working_sets,
       {rnd('avg(CASE WHEN rpe IS NOT NULL THEN 1.0 ELSE 0.0 END)', 6)} AS rpe_coverage,
       {rnd('avg(CASE WHEN rpe < 9.0 THEN 1.0 WHEN rpe IS NOT NULL THEN 0.0 END)', 6)} AS share_low_effort
FROM fct_set WHERE is_working_set GROUP BY training_era""",

    "snapshot_scd2": """
WITH s AS (SELECT user_id, event_id, ts, event_type,
                  lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
           FROM events),
c AS (SELECT * FROM s WHERE prev IS NULL OR prev <> event_type)
SELECT user_id, event_id, ts AS valid_from,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to, event_type,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
FROM c""",

    "filter_values": """
SELECT DISTINCT 'movement_pattern' AS filter, movement_pattern AS value FROM fes
WHERE training_era = 'hit' AND movement_pattern IS NOT NULL
UNION ALL
SELECT DISTINCT 'canonical_exercise', canonical_exercise FROM fes
WHERE training_era = 'hit' AND movement_pattern = 'SMALL' AND canonical_exercise IS NOT NULL""",

    "table_inventory": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, "
        f"(SELECT CAST(count(*) AS BIGINT) FROM (DESCRIBE {t})) AS n_columns FROM {t}"
        for t in sorted(["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                         "documents", "embeddings", "pages", "benchmark", "labels", "conversations"])),
}

# Queries whose SQL reads a shared CTE get the CTE block prepended.
_NEEDS = {
    "nested_flatten": [], "e1rm": ["sets"], "weight_semantics_case": ["templates"],
    "local_time_parts": ["ev_local"], "part_of_day_counts": ["ev_local"], "utc_local_straddle": ["ev_local"],
    "era_range_join": ["workouts"], "dim_inner_join": ["dim_exercise"], "fact_left_join": ["fct_set"],
    "unmapped_keys_anti": ["sets", "crosswalk", "templates"], "session_rollup": ["fct_workout"],
    "exercise_session_rollup": ["sessions"], "gap_since_last_exposure": ["rest"],
    "gap_since_last_workout": ["fct_workout"], "gap_since_last_workout_by_athlete": ["workouts"],
    "trailing_90d_max": ["fes"], "relative_performance": ["fes"], "pr_flags": ["fes"],
    "exercise_session_fact": ["fes"], "trailing_median": ["sessions"], "incremental_key_replace": ["sets"],
    "delta_keys_semi": ["sets", "workouts"], "obt_wide": ["fct_set", "fct_workout", "fes"],
    "check_not_null": ["fct_set"], "check_relationships": ["fct_set", "dim_exercise", "sets", "workouts"],
    "check_rollup_parity": ["fct_workout", "fct_set"], "check_sanity_guards": ["ev_local"],
    "value_histogram": ["fct_set", "ev_local", "workouts"], "unit_provenance": ["fct_set"],
    "reconcile_diff": ["fct_set"], "newest_record_listing": ["fct_set", "fct_workout"],
    "recovery_curve_buckets": ["fes"], "recovery_trend_ols": ["fes"], "time_of_day_quartiles": ["ev_local"],
    "time_of_day_by_weekday": ["ev_local"], "recent_prs": ["fes"], "min_sample_pooling": ["fes"],
    "progression_trend": ["fes"], "reps_at_load": ["fct_set"], "date_dimension": ["fct_workout"],
    "era_month_summary": ["fct_set", "fct_workout"], "gap_distribution": ["workouts"],
    "effort_summary": ["fct_set"], "filter_values": ["fes"],
}

ORACLES.update({
    "feed_entity_refresh": """
SELECT CAST(user_id AS VARCHAR) AS record_id, event_type AS title,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS updated_at
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events WHERE event_type <> 'error') t WHERE rn = 1""",

    "snapshot_ingest": """
WITH incoming AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
                                 FROM events) t WHERE rn = 1),
stored AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn
                          FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00') t WHERE rn = 1)
SELECT CAST(i.user_id AS VARCHAR) AS record_id, i.event_type AS entity_type, CAST(i.props ->> 'k' AS BIGINT) AS k
FROM incoming i
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.user_id = i.user_id AND s.event_type = i.event_type
                  AND CAST(s.props ->> 'k' AS BIGINT) = CAST(i.props ->> 'k' AS BIGINT))""",

    "reconcile_counts": """
SELECT 'workouts' AS "check", (SELECT count(*) FROM orders) AS expected, (SELECT count(*) FROM fct_workout) AS actual,
       (SELECT count(*) FROM orders) = (SELECT count(*) FROM fct_workout) AS matches
UNION ALL
SELECT 'sets', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM fct_set),
       (SELECT count(*) FROM lineitem) = (SELECT count(*) FROM fct_set)
UNION ALL
SELECT 'working_sets', (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'R'),
       (SELECT CAST(sum(total_working_sets) AS BIGINT) FROM fct_workout),
       (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'R') = (SELECT sum(total_working_sets) FROM fct_workout)
UNION ALL
SELECT 'exercises', (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) t),
       (SELECT CAST(sum(total_exercises) AS BIGINT) FROM fct_workout),
       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) t) = (SELECT sum(total_exercises) FROM fct_workout)""",

    "set_type_reconcile": """
SELECT set_type, count(*) AS expected_n, count(*) AS actual_n, true AS matches FROM sets GROUP BY set_type""",

    "local_time_reconcile": """
SELECT CAST(started_at_local AS DATE) AS local_date, extract(hour FROM started_at_local) AS local_hour,
       count(*) AS expected_n, count(*) AS actual_n, true AS matches
FROM ev_local GROUP BY 1, 2""",

    "disrupted_period_flags": """
SELECT workout_id AS o_orderkey, workout_date_local,
       EXISTS (SELECT 1 FROM (VALUES (DATE '1996-06-01', DATE '1996-08-31'), (DATE '1999-12-15', DATE '2000-01-15')) p(s, e)
               WHERE workouts.workout_date_local BETWEEN p.s AND p.e) AS is_disrupted
FROM workouts""",
})
_NEEDS.update({"reconcile_counts": ["fct_workout", "fct_set"], "set_type_reconcile": ["sets"],
               "local_time_reconcile": ["ev_local"], "disrupted_period_flags": ["workouts"]})

ORACLES["stream_latest_state"] = ORACLES["latest_by_key"]
ORACLES["weight_reconcile"] = """
SELECT DISTINCT round(l_extendedprice / 2.20462 * 2.20462, 2) AS weight_lb, true AS in_native, true AS in_independent
FROM lineitem"""

ORACLES.update({
    "content_hash": """
SELECT event_id, min(event_id) OVER (PARTITION BY event_type, value, props, user_id) AS same_content_as FROM events""",

    "exercise_session_fact_by_athlete": "SELECT * FROM fes_athlete",

    "obt_wide_by_athlete": f"""
SELECT {', '.join('s.' + c.strip() for c in FCT_SET_COLS.split(','))}, a.athlete_id,
       w.part_of_day, w.day_of_week, w.day_of_week_number, w.is_weekend,
       w.session_duration AS workout_duration_min, w.total_exercises AS actual_exercise_count,
       w.title AS workout_title, w.routine_id,
       es.working_e1rm_lb, es.trailing_90d_max_e1rm_lb, es.relative_performance, es.is_pr,
       es.days_since_last_exposure, es.days_since_last_workout
FROM fct_set s
JOIN workouts a ON s.workout_id = a.workout_id
LEFT JOIN fct_workout w ON s.workout_id = w.workout_id
LEFT JOIN fes_athlete es ON s.workout_id = es.workout_id
  AND coalesce(s.canonical_exercise, '') = coalesce(es.canonical_exercise, '')""",

    "trailing_median_by_athlete": f"""
SELECT workout_id, athlete_id, canonical_exercise, {rnd('m', 6)} AS trailing_90d_median_e1rm_lb
FROM (SELECT workout_id, athlete_id, canonical_exercise,
        quantile_cont(working_e1rm_lb, 0.5) OVER (PARTITION BY athlete_id, canonical_exercise ORDER BY workout_date_local
            RANGE BETWEEN INTERVAL '90' DAY PRECEDING AND INTERVAL '1' DAY PRECEDING) AS m
      FROM sessions_athlete) t""",

    "relative_performance_by_hour": f"""
SELECT training_era, workout_hour_local, count(*) AS n, {rnd('quantile_cont(relative_performance, 0.25)', 6)} AS q1,
       {rnd('quantile_cont(relative_performance, 0.5)', 6)} AS median, {rnd('quantile_cont(relative_performance, 0.75)', 6)} AS q3
FROM fes WHERE relative_performance IS NOT NULL GROUP BY 1, 2""",

    "relative_performance_by_weekday_hour": f"""
SELECT extract(isodow FROM workout_date_local) AS day_of_week_number, workout_hour_local, count(*) AS n,
       {rnd('quantile_cont(relative_performance, 0.5)', 6)} AS median
FROM fes WHERE relative_performance IS NOT NULL GROUP BY 1, 2""",
})
_NEEDS.update({"exercise_session_fact_by_athlete": ["fes_athlete"], "obt_wide_by_athlete": ["fct_set", "fct_workout", "fes_athlete"],
               "trailing_median_by_athlete": ["fes_athlete"], "relative_performance_by_hour": ["fes"],
               "relative_performance_by_weekday_hour": ["fes"], "newest_record_listing": ["fct_set", "fct_workout", "workouts"]})

# era_range_join_bucketed checks the bucketed path against the same oracle.
ORACLES["era_range_join_bucketed"] = ORACLES["era_range_join"]
_NEEDS["era_range_join_bucketed"] = ["workouts"]


from repsmith.plans import merge_queries  # noqa: E402, F401 (registers its queries there)

ORACLES.update(document_queries.ORACLES)
_NEEDS.update(document_queries.NEEDS)

# The refreshed wide table is that of the whole data.
ORACLES["mart_refresh"], _NEEDS["mart_refresh"] = ORACLES["obt_wide"], _NEEDS["obt_wide"]


def _merge_with(ctes: list[str], body: str) -> str:
    body = body.strip()
    if not ctes:
        return body
    head = with_ctes(*ctes, body="")
    if body.upper().startswith("WITH "):
        return head.rstrip() + ",\n" + body[5:]
    return head + body


def oracle_sql() -> dict[str, str]:
    return {name: _merge_with(_NEEDS.get(name, []), sql) for name, sql in ORACLES.items()}
