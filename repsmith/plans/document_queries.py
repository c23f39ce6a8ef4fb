"""Registered queries over whole documents: staging P1-P6, the designed dimensions on top, and sources.

Each document is built from one driver row's own columns, so a record keeps its identity and
no list is collected. ``events`` gives workout versions (id = user; all versions of a day land
together, so the record's own time decides among them) and the change feed; ``part`` gives
templates, ``customer`` routines, ``nation`` folders. The SQL beside each query states the
expected rows from the columns, without any JSON.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repsmith.functions import scalars as X
from repsmith.operators import analysis as A
from repsmith.plans import driver_tables as D
from repsmith.plans import ingest, marts, staging
from repsmith.sources import landing, tables
from repsmith.operators.incremental import KeyedTable
from repsmith.session import checkpoint_dir, written
from repsmith.streaming import changefeed

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
NEEDS: dict[str, list[str]] = {}

# Fixed parameters (the SQL states the same values).
SNAPSHOT_FROM = "2024-01-30 12:00:00"
STATE_FROM = "2024-01-16 00:00:00"
BODYWEIGHT_KG = 80.0
N_PLANS = 50


def query(name: str, sql: str, needs: tuple[str, ...] = ()):
    def deco(fn):
        QUERIES[name] = fn
        ORACLES[name] = sql
        NEEDS[name] = list(needs)
        return fn
    return deco


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = D.load(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    return (e.withColumn("own", F.timestamp_micros(F.unix_micros("at") + F.col("event_id")))
            .withColumn("landed", F.date_trunc("day", "at") + F.expr("INTERVAL '1' DAY")))


def _offset_text(c: Column) -> Column:
    """The instant as ISO text at a fixed offset of five hours."""
    return F.concat(F.date_format(c - F.expr("INTERVAL '5' HOUR"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("-05:00"))


def _bronze(records: DataFrame) -> DataFrame:
    return ingest.identify(records)


def workout_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every live event as a version of its user's workout document."""
    e = _events(spark, sf_dir).where(F.col("event_type") != D.FEED_DELETE_TYPE)
    n = F.col("event_id")

    def one_set(i: int, kind: str, kg: Column, reps: Column, rpe: Column) -> Column:
        return F.struct(F.lit(i).alias("index"), F.lit(kind).alias("type"), kg.alias("weight_kg"), reps.alias("reps"), rpe.alias("rpe"))

    def exercise(i: int, superset: Column, notes: Column, sets: Column) -> Column:
        return F.struct(F.lit(i).alias("index"), F.col("event_type").alias("title"), (n % 250).cast("string").alias("exercise_template_id"),
                        superset.alias("superset_id"), notes.alias("notes"), sets.alias("sets"))

    first = F.array(one_set(0, "warmup", F.col("value"), (n % 31) / F.lit(2.0), F.lit(None).cast("double")),
                    one_set(1, "normal", F.col("value") * 1.5, (n % 13).cast("double"), F.lit(8.5)))
    second = F.filter(F.array(one_set(0, "failure", F.lit(None).cast("double"), F.lit(5.0), F.lit(10.0))), lambda _: n % 2 == 1)
    doc = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("title"), _offset_text(F.col("at")).alias("start_time"),
                   _offset_text(F.timestamp_seconds(F.unix_micros("at") / 1000000 + n % 7200)).alias("end_time"),
                   _offset_text(F.col("at")).alias("created_at"), _offset_text(F.col("own")).alias("updated_at"),
                   F.array(exercise(0, F.lit(None).cast("long"), F.lit("   "), first), exercise(1, n % 3, F.concat(F.lit("n"), n.cast("string")), second)).alias("exercises"))
    return _bronze(e.select(F.to_json(doc).alias("record"), F.col("landed").alias("ingested_at")))


def feed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a change-feed record."""
    e = _events(spark, sf_dir)
    own = _offset_text(F.col("own"))
    gone = F.to_json(F.struct(F.lit("deleted").alias("type"), F.col("user_id").alias("id"), own.alias("deleted_at")))
    new = F.to_json(F.struct(F.lit("updated").alias("type"), F.struct(F.col("user_id").alias("id"), own.alias("updated_at")).alias("workout")))
    return _bronze(e.select(F.when(F.col("event_type") == D.FEED_DELETE_TYPE, gone).otherwise(new).alias("record"), F.col("landed").alias("ingested_at")))


def template_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    doc = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), D.exercise_type_of().alias("type"), F.col("p_brand").alias("primary_muscle_group"),
                   F.filter(F.array("p_name", "p_type"), lambda _: size % 2 == 1).alias("secondary_muscle_groups"),
                   F.when(size % 3 == 0, "true").when(size % 3 == 1, "false").otherwise("maybe").alias("is_custom"))
    return _bronze(D.load(spark, sf_dir, "part").select(F.to_json(doc).alias("record"), F.lit("2024-01-01").cast("timestamp").alias("ingested_at")))


def routine_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    doc = F.struct(key.alias("id"), F.col("c_name").alias("title"), F.when(key % 4 != 0, F.col("c_nationkey")).alias("folder_id"),
                   F.when(key % 2 == 0, " ").otherwise(F.col("c_mktsegment")).alias("notes"), F.sequence(F.lit(1), (key % 5 + 1).cast("int")).alias("exercises"))
    return _bronze(D.load(spark, sf_dir, "customer").select(F.to_json(doc).alias("record"), F.lit("2024-01-01").cast("timestamp").alias("ingested_at")))


def folder_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("title"), F.col("n_regionkey").alias("index"),
                   F.concat(F.lit("2024-01-0"), (F.col("n_regionkey") + 1).cast("string"), F.lit("T01:00:00+02:00")).alias("created_at"))
    return _bronze(D.load(spark, sf_dir, "nation").select(F.to_json(doc).alias("record"), F.lit("2024-01-01").cast("timestamp").alias("ingested_at")))


def _plain(df: DataFrame, *drop: str) -> DataFrame:
    """Instants as naive UTC timestamps, as the SQL has them."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.simpleString() == "timestamp" else F.col(f.name)
                       for f in df.schema.fields if f.name not in drop])


# ---------------------------------------------------------------- staging

_LOCAL = "timezone('America/New_York', timezone('UTC', {c}))"
_VERSIONS = """v AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC, ts + to_microseconds(event_id) DESC) AS rn
  FROM events WHERE event_type <> 'error'),
latest AS (SELECT * FROM v WHERE rn = 1)"""


@query("stg_workouts", f"""
WITH {_VERSIONS},
f AS (SELECT user_id, arg_max(event_type, ts + to_microseconds(event_id)) AS last_type, max(ts + to_microseconds(event_id)) AS last_at FROM events GROUP BY user_id),
w AS (SELECT CAST(l.user_id AS VARCHAR) AS workout_id, l.event_type AS title, ts AS started_at_utc, ts + to_seconds(event_id % 7200) AS ended_at_utc,
        {_LOCAL.format(c='ts')} AS started_at_local, {_LOCAL.format(c='ts + to_seconds(event_id % 7200)')} AS ended_at_local,
        ts AS created_at, ts + to_microseconds(event_id) AS updated_at, date_trunc('day', ts) + INTERVAL 1 DAY AS ingested_at,
        last_type = 'error' AS is_deleted, CASE WHEN last_type = 'error' THEN 1 ELSE 0 END AS gone
      FROM latest l JOIN f USING (user_id))
SELECT workout_id, title, started_at_utc, ended_at_utc, started_at_local, ended_at_local, CAST(started_at_local AS DATE) AS workout_date_local,
       CAST(extract(hour FROM started_at_local) AS BIGINT) AS workout_hour_local,
       CASE WHEN extract(hour FROM started_at_local) < 5 THEN 'night' WHEN extract(hour FROM started_at_local) < 11 THEN 'morning'
            WHEN extract(hour FROM started_at_local) < 14 THEN 'midday' WHEN extract(hour FROM started_at_local) < 18 THEN 'afternoon' ELSE 'evening' END AS part_of_day,
       dayname(started_at_local) AS day_of_week, CAST(extract(isodow FROM started_at_local) AS BIGINT) AS day_of_week_number,
       extract(isodow FROM started_at_local) >= 6 AS is_weekend, date_diff('minute', started_at_utc, ended_at_utc) AS duration_min,
       CAST(2 AS BIGINT) AS exercise_count, 'hit' AS training_era, is_deleted, created_at, updated_at, ingested_at
FROM w""")
def q_stg_workouts(spark, sf_dir):
    w = staging.stg_workouts(workout_versions(spark, sf_dir), feed_versions(spark, sf_dir), D.era_seed(spark), D.LOCAL_TZ)
    return _plain(w, "description", "routine_id")


@query("stg_workout_exercises", f"""
WITH {_VERSIONS}
SELECT CAST(user_id AS VARCHAR) AS workout_id, CAST(i AS INTEGER) AS exercise_index, event_type AS exercise_title, CAST(event_id % 250 AS VARCHAR) AS exercise_template_id,
       CASE WHEN i = 1 THEN CAST(event_id % 3 AS INTEGER) END AS superset_id, i = 1 AS is_superset, CASE WHEN i = 1 THEN 'n' || CAST(event_id AS VARCHAR) END AS notes,
       CAST(CASE WHEN i = 0 THEN 2 ELSE event_id % 2 END AS BIGINT) AS set_count
FROM latest, (VALUES (0), (1)) t(i)""")
def q_stg_workout_exercises(spark, sf_dir):
    return staging.stg_workout_exercises(workout_versions(spark, sf_dir))


_KG = "CASE s WHEN 0 THEN value WHEN 1 THEN value * 1.5 END"


@query("stg_workout_sets", f"""
WITH {_VERSIONS},
s AS (SELECT CAST(user_id AS VARCHAR) AS workout_id, CASE WHEN s = 2 THEN 1 ELSE 0 END AS e, CASE WHEN s = 1 THEN 1 ELSE 0 END AS i, event_type, event_id,
        CASE s WHEN 0 THEN 'warmup' WHEN 1 THEN 'normal' ELSE 'failure' END AS set_type, {_KG} AS kg,
        CASE s WHEN 0 THEN floor((event_id % 31) / 2.0 + 0.5) WHEN 1 THEN event_id % 13 ELSE 5 END AS reps, CASE s WHEN 1 THEN 8.5 WHEN 2 THEN 10.0 END AS rpe
      FROM latest, (VALUES (0), (1), (2)) t(s) WHERE s < 2 OR event_id % 2 = 1)
SELECT workout_id, CAST(e AS INTEGER) AS exercise_index, event_type AS exercise_title, CAST(event_id % 250 AS VARCHAR) AS exercise_template_id, CAST(i AS INTEGER) AS set_index,
       workout_id || '-' || CAST(e AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS set_key, set_type, set_type <> 'warmup' AS is_working_set, set_type = 'warmup' AS is_warmup,
       set_type = 'failure' AS is_to_failure, set_type = 'dropset' AS is_dropset, floor(CAST(kg AS DOUBLE) * 2.20462 * 100.0 + 0.5) / 100.0 AS weight_lb,
       floor(CAST(kg AS DOUBLE) * 1000.0 + 0.5) / 1000.0 AS weight_kg, CAST(reps AS INTEGER) AS reps, CAST(rpe AS DOUBLE) AS rpe
FROM s""")
def q_stg_workout_sets(spark, sf_dir):
    return staging.stg_workout_sets(workout_versions(spark, sf_dir)).drop("duration_seconds", "distance_meters", "custom_metric")


_TYPES = "CASE p_type WHEN 'ECONOMY' THEN 'weight_reps' WHEN 'LARGE' THEN 'weight_reps' WHEN 'MEDIUM' THEN 'bodyweight_weighted' WHEN 'PROMO' THEN 'bodyweight_assisted' WHEN 'SMALL' THEN 'reps_only' WHEN 'STANDARD' THEN 'duration' END"


@query("stg_exercise_templates", f"""
WITH t AS (SELECT *, {_TYPES} AS et FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS exercise_template_id, p_name AS exercise_title, et AS exercise_type, p_brand AS primary_muscle_group,
       CASE WHEN p_size % 2 = 1 THEN '["' || p_name || '","' || p_type || '"]' ELSE '[]' END AS secondary_muscle_groups,
       CAST(CASE WHEN p_size % 2 = 1 THEN 2 ELSE 0 END AS BIGINT) AS secondary_muscle_count,
       CASE p_size % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_custom, et IN ('bodyweight_weighted', 'bodyweight_assisted', 'reps_only') AS is_bodyweight,
       CASE et WHEN 'reps_only' THEN 'none' WHEN 'bodyweight_weighted' THEN 'added_to_bodyweight' WHEN 'bodyweight_assisted' THEN 'assistance_not_convertible' ELSE 'external_load' END AS weight_semantics
FROM t""")
def q_stg_exercise_templates(spark, sf_dir):
    return staging.stg_exercise_templates(template_documents(spark, sf_dir)).drop("equipment", "ingested_at")


_ROUTINES = """SELECT CAST(c_custkey AS VARCHAR) AS routine_id, c_name AS title, CASE WHEN c_custkey % 4 <> 0 THEN c_nationkey END AS folder_id,
       CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS notes, CAST(c_custkey % 5 + 1 AS BIGINT) AS exercise_count FROM customer"""


@query("stg_routines", _ROUTINES)
def q_stg_routines(spark, sf_dir):
    return staging.stg_routines(routine_documents(spark, sf_dir)).drop("created_at", "updated_at", "ingested_at")


@query("stg_routine_folders", """
SELECT n_nationkey AS folder_id, n_name AS title, n_regionkey AS folder_index,
       TIMESTAMP '2023-12-31 23:00:00' + to_days(CAST(n_regionkey AS INTEGER)) AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS ingested_at
FROM nation""")
def q_stg_routine_folders(spark, sf_dir):
    return _plain(staging.stg_routine_folders(folder_documents(spark, sf_dir)), "updated_at")


# ---------------------------------------------------------------- designed models on top

@query("dim_routine", f"""
SELECT r.*, n_name AS folder_title, n_regionkey AS folder_index FROM ({_ROUTINES}) r LEFT JOIN nation ON folder_id = n_nationkey""")
def q_dim_routine(spark, sf_dir):
    return marts.dim_routine(staging.stg_routines(routine_documents(spark, sf_dir)), staging.stg_routine_folders(folder_documents(spark, sf_dir)))


@query("muscle_bridge", """
SELECT CAST(p_partkey AS VARCHAR) AS exercise_template_id, p_brand AS muscle, 'primary' AS role, CASE WHEN p_size % 2 = 1 THEN 0.5 ELSE 1.0 END::DOUBLE AS weight FROM part
UNION ALL
SELECT CAST(p_partkey AS VARCHAR), m, 'secondary', 0.25::DOUBLE FROM (SELECT p_partkey, unnest([p_name, p_type]) AS m FROM part WHERE p_size % 2 = 1)""")
def q_muscle_bridge(spark, sf_dir):
    return A.muscle_bridge(staging.stg_exercise_templates(template_documents(spark, sf_dir)))


@query("routine_adherence", f"""
WITH w AS (SELECT o_orderkey AS workout_id, o_custkey % {N_PLANS} AS routine_id FROM orders WHERE o_orderkey % 3 <> 0),
plan AS (SELECT p_partkey % {N_PLANS} AS routine_id, count(*) AS planned FROM part GROUP BY 1),
done AS (SELECT l_orderkey AS workout_id, count(DISTINCT l_partkey) AS performed FROM lineitem GROUP BY 1),
m AS (SELECT workout_id, count(DISTINCT l_partkey) AS matched FROM w JOIN lineitem ON l_orderkey = workout_id AND l_partkey % {N_PLANS} = routine_id JOIN part ON p_partkey = l_partkey GROUP BY 1)
SELECT w.workout_id, w.routine_id, coalesce(planned, 0) AS planned, coalesce(performed, 0) AS performed, coalesce(matched, 0) AS matched
FROM w LEFT JOIN plan USING (routine_id) LEFT JOIN done USING (workout_id) LEFT JOIN m USING (workout_id)""")
def q_routine_adherence(spark, sf_dir):
    w = D.load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("workout_id"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey") % N_PLANS).alias("routine_id"))
    done = D.load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("workout_id"), F.col("l_partkey").alias("exercise_template_id"))
    plan = D.load(spark, sf_dir, "part").select((F.col("p_partkey") % N_PLANS).alias("routine_id"), F.col("p_partkey").alias("exercise_template_id"))
    return A.routine_adherence(w, done, plan)


@query("effective_load", f"""
SELECT p_partkey, CASE p_type WHEN 'MEDIUM' THEN {BODYWEIGHT_KG} + p_retailprice / 10.0::DOUBLE WHEN 'PROMO' THEN {BODYWEIGHT_KG} - p_retailprice / 10.0::DOUBLE
       WHEN 'SMALL' THEN {BODYWEIGHT_KG}::DOUBLE ELSE p_retailprice / 10.0::DOUBLE END AS load_kg
FROM part""")
def q_effective_load(spark, sf_dir):
    return D.load(spark, sf_dir, "part").select("p_partkey", X.effective_load(F.col("p_retailprice") / F.lit(10.0), X.weight_semantics(D.exercise_type_of()), BODYWEIGHT_KG).alias("load_kg"))


@query("rest_buckets_designed", """
SELECT CASE WHEN days_since_last_exposure >= 7 THEN '7+' WHEN days_since_last_exposure >= 4 THEN '4-6' ELSE CAST(days_since_last_exposure AS VARCHAR) END AS rest_bucket, count(*) AS n
FROM fes GROUP BY 1""", ("fes",))
def q_rest_buckets_designed(spark, sf_dir):
    s = D.marts(spark, sf_dir)["fct_exercise_session"]
    return s.groupBy(X.rest_bucket_designed("days_since_last_exposure").alias("rest_bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("missed_deletes", f"""
SELECT CAST(user_id AS VARCHAR) AS record_id, max(date_trunc('day', ts)) + INTERVAL 1 DAY AS ingested_at
FROM events WHERE event_type <> 'error' AND user_id NOT IN (SELECT user_id FROM events WHERE ts >= TIMESTAMP '{SNAPSHOT_FROM}') GROUP BY user_id""")
def q_missed_deletes(spark, sf_dir):
    live = _events(spark, sf_dir).where(F.col("ts") >= F.lit(SNAPSHOT_FROM).cast("timestamp_ntz")).select(F.col("user_id").cast("string").alias("record_id")).distinct()
    return _plain(ingest.missing_from_snapshot(workout_versions(spark, sf_dir), live), "record_hash")


# ---------------------------------------------------------------- sources written and read back

def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events landed as JSON lines under a new folder, one run a day, and read back."""
    base = _scratch(spark, "landing")
    e = _events(spark, sf_dir)
    doc = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("user_id"), F.col("event_type")))
    landing.land(e.select(doc.alias("record"), "landed"), base, "workout_events", ingested_at=F.col("landed"))
    return landing.read_landed(spark, base, "workout_events")


@query("landing_round_trip", """
SELECT CAST(event_id AS VARCHAR) AS record_id, strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y%m%dT%H%M%SZ') AS run_id, '/v1/workouts/events' AS endpoint,
       date_trunc('day', ts) + INTERVAL 1 DAY AS ingested_at, CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS DATE) AS ingest_date, user_id, event_type
FROM events""")
def q_landing_round_trip(spark, sf_dir):
    b = landing.bronze(_landed(spark, sf_dir))
    return _plain(b.select("record_id", "run_id", "endpoint", "ingested_at", "ingest_date", F.get_json_object("record", "$.user_id").cast("long").alias("user_id"),
                           F.get_json_object("record", "$.event_type").alias("event_type")))


@query("run_summary", """
SELECT 'workout_events' AS dataset, strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y%m%dT%H%M%SZ') AS run_id, count(*) AS n_records FROM events GROUP BY ALL""")
def q_run_summary(spark, sf_dir):
    return landing.run_summary({"workout_events": _landed(spark, sf_dir)})


@query("table_write_read", """
SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM events WHERE event_type = 'purchase' GROUP BY event_type""")
def q_table_write_read(spark, sf_dir):
    """Two versions written, the newest read with a predicate, then aggregated through a view."""
    base, e = _scratch(spark, "table"), D.load(spark, sf_dir, "events").select("event_id", "event_type")
    tables.write_table(e.where("event_id < 10"), base)
    tables.write_table(e, base)
    tables.register_views({"table_write_read_events": tables.read_table(spark, base, F.col("event_type") == "purchase")})
    return spark.sql("SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM table_write_read_events GROUP BY event_type")


@query("csv_round_trip", "SELECT p_partkey, p_name, p_size, p_retailprice, p_size > 25 AS is_large FROM part")
def q_csv_round_trip(spark, sf_dir):
    path = _scratch(spark, "csv")
    landing.export_csv(D.load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice", (F.col("p_size") > 25).alias("is_large")), path)
    return landing.read_seed(spark, path, "p_partkey long, p_name string, p_size int, p_retailprice double, is_large boolean")


@query("state_upsert", f"""
SELECT event_type AS dataset, max(ts) AS high_water FROM events WHERE ts < TIMESTAMP '{STATE_FROM}' OR event_type <> 'click' GROUP BY event_type""")
def q_state_upsert(spark, sf_dir):
    """Marks of the first half, then those of the second for all types but one."""
    e = D.load(spark, sf_dir, "events")
    marks = lambda cond: e.where(cond).groupBy(F.col("event_type").alias("dataset")).agg(F.max("ts").alias("high_water"))
    before = F.col("ts") < F.lit(STATE_FROM).cast("timestamp_ntz")
    return ingest.upsert_state(marks(before), marks(~before & (F.col("event_type") != "click")))


@query("backfill_check", "SELECT count(*) AS landed, count(*) AS source_count, true AS counts_match FROM events")
def q_backfill_check(spark, sf_dir):
    return ingest.backfill_check(_landed(spark, sf_dir), D.load(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- deletions in the fact (F2), the feed as a stream

@query("fct_set_live_documents", f"""
SELECT s.set_key, s.workout_id, w.workout_date_local, w.training_era, s.exercise_template_id, s.set_type, s.weight_lb, s.reps,
       p.p_brand || ' ' || p.p_type AS canonical_exercise, p.p_type AS movement_pattern,
       p.p_type IN ('ECONOMY', 'LARGE', 'MEDIUM') AS supports_load_metrics, p.p_type = 'MEDIUM' AS has_estimated_load
FROM ({ORACLES['stg_workout_sets']}) s JOIN ({ORACLES['stg_workouts']}) w USING (workout_id)
LEFT JOIN part p ON CAST(p.p_partkey AS VARCHAR) = s.exercise_template_id AND p.p_size <= {D.MAPPED_MAX_SIZE}
WHERE NOT w.is_deleted""")
def q_fct_set_live_documents(spark, sf_dir):
    """The set fact over staged documents, with deleted workouts among them. Both staging models start from
    the latest versions: these are found once, of versions made and hashed once, and written."""
    bronze = written(staging.latest(written(workout_versions(spark, sf_dir), "versions")), "latest")
    w = staging.stg_workouts(bronze, feed_versions(spark, sf_dir), D.era_seed(spark), D.LOCAL_TZ)
    x = D.crosswalk(spark, sf_dir)
    dim = marts.dim_exercise(staging.stg_exercise_templates(template_documents(spark, sf_dir)), x.withColumn("exercise_template_id", F.col("exercise_template_id").cast("string")))
    f = marts.fct_set(staging.stg_workout_sets(bronze), w, dim)
    return f.select("set_key", "workout_id", "workout_date_local", "training_era", "exercise_template_id", "set_type", "weight_lb", "reps",
                    "canonical_exercise", "movement_pattern", "supports_load_metrics", "has_estimated_load")


def _land_feed(spark: SparkSession, sf_dir: str, base: str, cond: Column) -> None:
    e = _events(spark, sf_dir).where(cond)
    gone = F.to_json(F.struct(F.lit("deleted").alias("type"), F.col("user_id").alias("id"), _offset_text(F.col("own")).alias("deleted_at")))
    new = F.to_json(F.struct(F.lit("updated").alias("type"), F.struct(
        F.col("user_id").alias("id"), F.col("event_type").alias("title"), F.col("value"), _offset_text(F.col("own")).alias("updated_at")).alias("workout")))
    record = F.when(F.col("event_type") == D.FEED_DELETE_TYPE, gone).otherwise(new).alias("record")
    landing.land(e.select(record, "landed"), base, "workout_events", ingested_at=F.col("landed"))


@query("change_feed_apply", """
WITH v AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC, ts + to_microseconds(event_id) DESC) AS rn FROM events)
SELECT CAST(user_id AS VARCHAR) AS workout_id, event_type AS title, value FROM v WHERE rn = 1 AND event_type <> 'error'""")
def q_change_feed_apply(spark, sf_dir):
    """The feed drained in two runs of the stream, the newer half first: late events and
    deletions must not disturb what is newer, and a run without news changes nothing."""
    base, ckpt = _scratch(spark, "feed"), _scratch(spark, "feed-offsets")
    target = KeyedTable(spark, _scratch(spark, "feed-target"), "workout_id", n_buckets=8)

    def rows(updated: DataFrame) -> DataFrame:
        return updated.select("workout_id", F.get_json_object("workout", "$.title").alias("title"), F.get_json_object("workout", "$.value").cast("double").alias("value"))

    newer = F.col("ts") >= F.lit(STATE_FROM).cast("timestamp_ntz")
    for cond in (newer, ~newer):
        _land_feed(spark, sf_dir, base, cond)
        for _ in range(2):
            changefeed.start(spark, f"{base}/workout_events", ckpt, target, rows).awaitTermination()
    return target.read()


@query("stream_dedupe", """
SELECT CAST(user_id AS VARCHAR) AS record_id, count(*) AS n FROM events GROUP BY user_id""")
def q_stream_dedupe(spark, sf_dir):
    """Every event delivered twice; the stream keeps one of each (id, content) inside the watermark."""
    base, ckpt, out = _scratch(spark, "pages"), _scratch(spark, "pages-offsets"), _scratch(spark, "pages-kept")
    for _ in range(2):
        _land_feed(spark, sf_dir, base, F.lit(True))
    stream = spark.readStream.schema(landing.ENVELOPE).option("recursiveFileLookup", True).json(f"{base}/workout_events")
    once = changefeed.dedupe_stream(stream.withColumn("at", F.col("_ingested_at").cast("timestamp")), "_record_id", "at", "60 days")
    once.writeStream.format("parquet").option("checkpointLocation", ckpt).option("path", out).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).groupBy(F.col("_record_id").alias("record_id")).agg(F.count(F.lit(1)).alias("n"))
