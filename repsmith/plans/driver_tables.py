"""Staging frames derived from the TPC-H-style driver tables.

The recipe (documented in FIXTURES.md) reads the star schema as a training log:

* ``orders``  -> workouts: ``o_orderkey`` is the workout, ``o_custkey`` the athlete,
  ``o_orderdate`` the UTC start instant (TIMESTAMP_NTZ read as UTC).
* ``lineitem`` -> sets: one set per line; ``l_partkey`` is the exercise (template and
  exercise index), ``l_linenumber`` the set index (``set_key`` is derived from the three
  parts where it is used, see :func:`with_set_key`), ``l_quantity`` the reps,
  ``l_extendedprice`` the load as typed in pounds (stored, like the source app does,
  as ``lb / 2.20462`` kg with float noise), the return flag / line status the set type.
* ``part`` -> exercise templates; parts with ``p_size <= 45`` have a crosswalk entry
  (canonical exercise = brand + type, movement pattern = type); larger ones are unmapped.
* a fixed three-row era seed with a gap, so some workouts have no era.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repsmith.functions import scalars as X
from repsmith.operators.joins import range_join

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Fixed values of the recipe (the oracle SQL states the same values).
LOCAL_TZ = "America/New_York"
ERAS = [
    ("base", "1995-01-01", "1996-12-31", "first block"),
    ("volume", "1997-03-01", "1999-06-30", "higher volume"),
    ("hit", "1999-07-01", "9999-12-31", "high intensity, open ended"),
]
PART_TYPE_TO_EXERCISE_TYPE = {
    "ECONOMY": "weight_reps",
    "LARGE": "weight_reps",
    "MEDIUM": "bodyweight_weighted",
    "PROMO": "bodyweight_assisted",
    "SMALL": "reps_only",
    "STANDARD": "duration",
}
MAPPED_MAX_SIZE = 45
FEED_DELETE_TYPE = "error"


_LOADED: dict[tuple[int, str, str], DataFrame] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One DataFrame per (session, driver table): the driver tables are read-only, so the
    file listing and footer read happen once per session instead of once per reference."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), spark.sparkContext.applicationId, path)
    if key not in _LOADED:
        _LOADED[key] = spark.read.parquet(path)
    return _LOADED[key]


def era_seed(spark: SparkSession) -> DataFrame:
    """The era seed as a typed DataFrame (3 rows by construction).

    Built as a SQL ``VALUES`` relation, so it lives in the plan (exact statistics, no
    Python worker) rather than as an opaque Python-side RDD."""
    return seed_frame(spark, ERAS, ["era STRING", "start_date DATE", "end_date DATE", "description STRING"])


def seed_frame(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """Small fixed table -> LocalRelation with typed columns (``"name TYPE"`` specs)."""
    names = [c.split()[0] for c in columns]
    types = [c.split(None, 1)[1] for c in columns]

    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, (int, float)):
            return repr(v)
        return "'" + str(v).replace("'", "''") + "'"

    values = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in zip(names, types))
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({', '.join(names)})")


def set_type_of(returnflag: str = "l_returnflag", linestatus: str = "l_linestatus"):
    rf, ls = F.col(returnflag), F.col(linestatus)
    return (F.when(rf == "R", F.lit("warmup"))
            .when((rf == "A") & (ls == "F"), F.lit("dropset"))
            .when(rf == "A", F.lit("failure"))
            .otherwise(F.lit("normal")))


def workouts(spark: SparkSession, sf_dir: str, tz: str = LOCAL_TZ) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    local = X.to_local("o_orderdate", tz)
    w = o.select(
        F.col("o_orderkey").alias("workout_id"),
        F.col("o_custkey").alias("athlete_id"),
        F.col("o_orderpriority").alias("title"),
        F.lit(None).cast("string").alias("routine_id"),
        F.col("o_orderdate").cast("timestamp").alias("started_at_utc"),
        local.alias("started_at_local"),
    )
    w = (w.withColumn("workout_date_local", F.to_date("started_at_local"))
          .withColumn("workout_hour_local", X.local_hour("started_at_local"))
          .withColumn("part_of_day", X.part_of_day(F.col("workout_hour_local")))
          .withColumn("day_of_week", X.day_name("started_at_local"))
          .withColumn("day_of_week_number", X.iso_day_of_week("started_at_local"))
          .withColumn("is_weekend", X.is_weekend("started_at_local"))
          .withColumn("duration_min", F.lit(None).cast("long"))
          .withColumn("is_deleted", F.lit(False))
          .withColumn("created_at", F.col("started_at_utc"))
          .withColumn("updated_at", F.col("started_at_utc")))
    eras = era_seed(spark)
    w = range_join(w, eras.select(F.col("era").alias("training_era"), "start_date", "end_date"),
                   F.col("workout_date_local"), "start_date", "end_date", "left")
    return w.drop("start_date", "end_date")


def set_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sets as stored: the few columns that :func:`set_columns` makes the staging columns from."""
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("workout_id"),
        F.col("l_partkey").alias("exercise_template_id"),
        F.col("l_linenumber").alias("set_index"),
        "l_returnflag", "l_linestatus", "l_extendedprice", "l_quantity", "l_discount")


def set_columns(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The staging columns of :func:`set_rows`, and ``keep``. A row's own columns are all it takes, so
    it may run behind joins, which then shuffle the narrow rows."""
    raw_kg = F.col("l_extendedprice") / F.lit(X.LB_PER_KG)
    st = set_type_of()
    flags = X.set_flags(st)
    return rows.select(
        "workout_id",
        F.col("exercise_template_id").alias("exercise_index"),
        "exercise_template_id",
        "set_index",
        st.alias("set_type"),
        *[v.alias(k) for k, v in flags.items()],
        X.weight_lb(raw_kg).alias("weight_lb"),
        X.weight_kg_canonical(raw_kg).alias("weight_kg"),
        X.round_half_away("l_quantity", 0).cast("int").alias("reps"),
        X.round_half_away(F.lit(6.0) + F.col("l_discount") * F.lit(40.0), 1).alias("rpe"),
        F.lit(None).cast("int").alias("duration_seconds"),
        F.lit(None).cast("double").alias("distance_meters"),
        F.lit(None).cast("string").alias("custom_metric"),
        *keep,
    )


def sets(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").withColumnsRenamed(
        {"l_orderkey": "workout_id", "l_partkey": "exercise_template_id", "l_linenumber": "set_index"})
    return set_columns(rows, keep)


def with_set_key(sets_df: DataFrame) -> DataFrame:
    """``workout-exercise-set`` positional key from the integer parts."""
    return sets_df.withColumn("set_key", X.positional_key("workout_id", "exercise_index", "set_index"))


def exercise_type_of(p_type: str = "p_type"):
    t = F.col(p_type)
    expr = None
    for k, v in PART_TYPE_TO_EXERCISE_TYPE.items():
        expr = F.when(t == k, F.lit(v)) if expr is None else expr.when(t == k, F.lit(v))
    return expr


def templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    et = exercise_type_of()
    return p.select(
        F.col("p_partkey").alias("exercise_template_id"),
        F.col("p_name").alias("exercise_title"),
        et.alias("exercise_type"),
        F.lit(None).cast("string").alias("primary_muscle_group"),
        F.lit(0).cast("long").alias("secondary_muscle_count"),
        F.lit(None).cast("string").alias("equipment"),
        F.lit(False).alias("is_custom"),
        X.is_bodyweight(et).alias("is_bodyweight"),
        X.weight_semantics(et).alias("weight_semantics"),
    )


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    return p.where(F.col("p_size") <= MAPPED_MAX_SIZE).select(
        F.col("p_partkey").alias("exercise_template_id"),
        F.col("p_name").alias("source_title"),
        F.concat_ws(" ", "p_brand", "p_type").alias("canonical_exercise"),
        F.col("p_type").alias("movement_pattern"),
        (F.col("p_size") < 10).alias("is_unilateral"),
        (F.col("p_retailprice") >= 1500.0).alias("is_compound"),
    )


def staging(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"workouts": workouts(spark, sf_dir), "sets": sets(spark, sf_dir),
            "templates": templates(spark, sf_dir), "crosswalk": crosswalk(spark, sf_dir)}


_MARTS: dict[tuple, dict[str, DataFrame]] = {}


def marts(spark: SparkSession, sf_dir: str, entity_cols: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The marts over the driver tables, built (lazily) once per session, directory and entity
    columns; the frames are immutable plans, so every query can derive from the same ones."""
    from repsmith.plans.marts import build_marts
    key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"), entity_cols)
    if key not in _MARTS:
        s = staging(spark, sf_dir)
        _MARTS[key] = build_marts(s["workouts"], set_rows(spark, sf_dir), s["templates"], s["crosswalk"], entity_cols, set_columns)
    return _MARTS[key]
