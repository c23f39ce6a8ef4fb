"""Registered queries over the driver tables: one per operator family in SURVEY §2.

Each entry is ``(spark, sf_dir) -> DataFrame`` and reads whole tables. Output columns
are named and typed to match the DuckDB oracle in :mod:`repsmith.plans.oracle_sql`
(integers as BIGINT/long unless the source column is INTEGER, timestamps as
TIMESTAMP_NTZ). Aggregated doubles are rounded the same way on both sides, because
the order of a floating-point sum differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repsmith.functions import json as J
from repsmith.functions import scalars as X
from repsmith.operators import analysis as A
from repsmith.operators import cdc, nested, quality as Q
from repsmith.operators.incremental import delta_since, key_replace
from repsmith.operators.joins import range_join
from repsmith.plans import document_queries, merge_queries  # noqa: F401 (merge_queries registers there)
from repsmith.plans import driver_tables as D
from repsmith.plans.marts import build_marts
from repsmith.session import written
from repsmith.sources.inventory import table_inventory

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ROWS_ONLY: set[str] = set()

# Fixed parameters of the registered queries (the oracle SQL states the same values).
STORED_BEFORE = "2024-01-16 00:00:00"
INCREMENT_CUTOFF = "1998-01-01 00:00:00"
TARGET_BEFORE = "1999-01-01 00:00:00"
ACCEPTED_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
POOLING_MIN_SESSIONS = 10
PAGE_SIZE = 10


def query(name: str, rows_only: bool = False):
    def deco(fn):
        QUERIES[name] = fn
        if rows_only:
            ROWS_ONLY.add(name)
        return fn
    return deco


def r6(c) -> Column:
    return X.round_half_away(c, 6)


def r9(c) -> Column:
    return X.round_half_away(c, 9)


def ntz(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def _marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return D.marts(spark, sf_dir)


def _events(spark, sf_dir) -> DataFrame:
    return D.load(spark, sf_dir, "events")


def _op(event_type: str = "event_type") -> Column:
    return F.when(F.col(event_type) == D.FEED_DELETE_TYPE, F.lit("deleted")).otherwise(F.lit("updated"))


def _event_local(spark, sf_dir) -> DataFrame:
    e = _events(spark, sf_dir)
    return e.withColumn("started_at_local", X.to_local("ts", D.LOCAL_TZ))


# ---------------------------------------------------------------- CDC

@query("latest_by_key")
def q_latest_by_key(spark, sf_dir):
    e = _events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type", "value")
    return cdc.latest_by_key(e, "user_id", [F.col("ts"), F.col("event_id")])


@query("dedupe_last_wins")
def q_dedupe_last_wins(spark, sf_dir):
    li = D.load(spark, sf_dir, "lineitem")
    seq = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
           "l_returnflag", "l_linestatus"]
    return cdc.dedupe_last_wins(li, ["l_orderkey", "l_linenumber"], [F.col(c) for c in seq])


@query("changed_only")
def q_changed_only(spark, sf_dir):
    e = (_events(spark, sf_dir)
         .withColumn("record_id", F.col("user_id"))
         .withColumn("record_hash", J.columns_hash("event_type", "value", "props")))
    order = [F.col("ts"), F.col("event_id")]
    incoming = cdc.latest_by_key(e, "record_id", order)          # current snapshot per user
    stored = e.where(F.col("ts") < F.lit(STORED_BEFORE).cast("timestamp_ntz"))
    kept = cdc.changed_only(incoming, stored, "record_id", "record_hash", stored_order=order)
    return kept.select("user_id", "event_id", "ts", "event_type", "value")


@query("feed_split_counts")
def q_feed_split_counts(spark, sf_dir):
    return cdc.feed_counts(_events(spark, sf_dir), _op())


@query("soft_delete_flag")
def q_soft_delete_flag(spark, sf_dir):
    c = D.load(spark, sf_dir, "customer").select("c_custkey")
    e = _events(spark, sf_dir)
    out = cdc.soft_delete_flags(c, e, "c_custkey", "user_id", F.col("event_type") == D.FEED_DELETE_TYPE,
                                [F.col("ts"), F.col("event_id")], "ts")
    return out.select("c_custkey", "is_deleted", ntz("deleted_at").alias("deleted_at"))


@query("high_water_mark")
def q_high_water_mark(spark, sf_dir):
    e = _events(spark, sf_dir).withColumn("op", _op())
    return cdc.high_water_mark(e, "ts", ["op"]).select("op", "n_events", "high_water", "high_water_iso")


@query("json_field_extract")
def q_json_field_extract(spark, sf_dir):
    e = _events(spark, sf_dir)
    env = (F.when(F.col("event_type") == D.FEED_DELETE_TYPE,
                  F.to_json(F.struct(F.lit("deleted").alias("type"), F.col("event_id").alias("id"))))
           .otherwise(F.to_json(F.struct(F.lit("updated").alias("type"),
                                         F.struct(F.col("event_id").alias("id"),
                                                  F.col("event_type").alias("title")).alias("workout")))))
    e = e.withColumn("envelope", env)
    return e.select(
        "event_id",
        J.json_text("props", "$.k").cast("long").alias("k"),
        J.json_text("props", "$.missing").alias("missing"),
        J.record_id("envelope").alias("record_id"),
        J.json_text("envelope", "$.type").alias("envelope_type"),
        J.json_text("envelope", "$.workout.title").alias("workout_title"))


@query("content_hash")
def q_content_hash(spark, sf_dir):
    """Equality classes of the content hash: per event the smallest event with the same content."""
    e = _events(spark, sf_dir)
    doc = F.to_json(F.struct("event_type", "value", "props", "user_id"))
    hashed = e.select("event_id", J.content_hash(doc).alias("record_hash"))
    first = hashed.groupBy("record_hash").agg(F.min("event_id").alias("same_content_as"))
    return hashed.join(first, "record_hash").select("event_id", "same_content_as")


# ---------------------------------------------------------------- nested

def _workout_documents(spark, sf_dir) -> DataFrame:
    """One JSON document per (order, chunk): {"id", "exercises": [{"index", "sets": [...]}]}."""
    s = D.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        (F.col("l_extendedprice") / F.lit(X.LB_PER_KG)).alias("weight_kg"),
        D.set_type_of().alias("type"))
    set_struct_cols = ["l_linenumber", "l_quantity", "weight_kg", "type"]
    ex = nested.nest_children(s, ["l_orderkey", "l_partkey"], set_struct_cols, "sets_raw")
    ex = ex.select("l_orderkey", F.struct(
        F.col("l_partkey").alias("index"),
        F.transform("sets_raw", lambda r: F.struct(
            r["l_linenumber"].alias("index"), r["l_quantity"].alias("reps"),
            r["weight_kg"].alias("weight_kg"), r["type"].alias("type"))).alias("sets")).alias("exercise"))
    docs = nested.nest_children(ex, ["l_orderkey"], ["exercise"], "exercises_raw")
    return docs.select(F.to_json(F.struct(
        F.col("l_orderkey").alias("id"),
        F.transform("exercises_raw", lambda r: r["exercise"]).alias("exercises"))).alias("record"))


def _flatten_documents(docs: DataFrame) -> DataFrame:
    return nested.flatten_two_levels(
        docs, "record",
        {"workout_id": ("$.id", "long")},
        "$.exercises", {"exercise_index": ("$.index", "long")},
        "$.sets", {"set_index": ("$.index", "int"), "reps_raw": ("$.reps", "double"),
                   "weight_kg": ("$.weight_kg", "double"), "set_type": ("$.type", "string")})


@query("nested_flatten")
def q_nested_flatten(spark, sf_dir):
    flat = _flatten_documents(_workout_documents(spark, sf_dir))
    return flat.select("workout_id", "exercise_index", "set_index",
                       X.round_half_away("reps_raw", 0).cast("int").alias("reps"), "weight_kg", "set_type")


@query("nested_count_parity")
def q_nested_count_parity(spark, sf_dir):
    docs = _workout_documents(spark, sf_dir)
    raw = docs.agg(F.sum(nested.nested_length_sum("record", "$.exercises", "$.sets")).cast("long").alias("raw_sets"))
    flat = _flatten_documents(docs).agg(F.count(F.lit(1)).cast("long").alias("flat_sets"))
    return raw.select("raw_sets", flat.scalar().alias("flat_sets")) \
        .withColumn("counts_match", F.col("raw_sets") == F.col("flat_sets"))


@query("paged_flatten")
def q_paged_flatten(spark, sf_dir):
    o = D.load(spark, sf_dir, "orders").withColumn("page", F.floor(F.col("o_orderkey") / PAGE_SIZE).cast("long"))
    pages = nested.nest_children(o, ["page"], ["o_orderkey", "o_totalprice"], "orders_raw", max_children=PAGE_SIZE)
    n_pages = o.agg(F.count_distinct("page").cast("long").alias("page_count"))
    bodies = pages.select(F.to_json(F.struct(
        "page", n_pages.scalar().alias("page_count"), F.col("orders_raw").alias("orders"))).alias("body"))
    recs = nested.pages_to_records(bodies, "orders")
    return recs.select("page", "page_count",
                       J.json_text("record", "$.o_orderkey").cast("long").alias("workout_id"),
                       J.json_text("record", "$.o_totalprice").cast("double").alias("o_totalprice"))


@query("positional_key")
def q_positional_key(spark, sf_dir):
    li = D.load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     X.positional_key("l_orderkey", "l_partkey", "l_linenumber").alias("set_key"))


@query("embedding_unnest")
def q_embedding_unnest(spark, sf_dir):
    e = D.load(spark, sf_dir, "embeddings")
    ex = e.select("vec_id", "label", F.size("embedding").cast("long").alias("dims"),
                  F.posexplode("embedding").alias("pos", "x"))
    return ex.groupBy("vec_id", "label", "dims").agg(
        F.count(F.lit(1)).cast("long").alias("n_elements"),
        F.max("pos").cast("long").alias("last_pos"))


# ---------------------------------------------------------------- scalars (X*)

@query("local_time_parts")
def q_local_time_parts(spark, sf_dir):
    e = _event_local(spark, sf_dir)
    loc = F.col("started_at_local")
    return e.select("event_id", loc.alias("started_at_local"), F.to_date(loc).alias("local_date"),
                    X.local_hour(loc).alias("local_hour"), X.day_name(loc).alias("day_of_week"),
                    X.iso_day_of_week(loc).alias("day_of_week_number"), X.is_weekend(loc).alias("is_weekend"),
                    X.part_of_day(X.local_hour(loc)).alias("part_of_day"))


@query("part_of_day_counts")
def q_part_of_day_counts(spark, sf_dir):
    e = _event_local(spark, sf_dir)
    return e.groupBy(X.part_of_day(X.local_hour("started_at_local")).alias("part_of_day")).agg(
        F.count(F.lit(1)).cast("long").alias("n_events"))


@query("utc_local_straddle")
def q_utc_local_straddle(spark, sf_dir):
    e = _event_local(spark, sf_dir)
    return e.groupBy("event_type").agg(
        F.count(F.lit(1)).cast("long").alias("n_events"),
        F.count_if(F.to_date("ts") != F.to_date("started_at_local")).cast("long").alias("n_straddle"))


@query("duration_minutes")
def q_duration_minutes(spark, sf_dir):
    e = _events(spark, sf_dir)
    micros = F.floor(F.col("value") * F.lit(60000000.0)).cast("long")
    ended = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + micros)
    return e.select("event_id", ntz(ended).alias("ended_at"),
                    X.minutes_between(F.col("ts"), ended).alias("duration_min"))


@query("e1rm")
def q_e1rm(spark, sf_dir):
    s = D.sets(spark, sf_dir)
    return s.select(F.col("workout_id").alias("l_orderkey"), F.col("set_index").alias("l_linenumber"),
                    F.col("exercise_template_id").alias("l_partkey"), "reps", "weight_lb", "weight_kg",
                    X.e1rm("weight_lb", "reps").alias("e1rm_lb"), X.e1rm("weight_kg", "reps").alias("e1rm_kg"),
                    X.epley("weight_lb", "reps").alias("epley_lb"))


@query("weight_canonical")
def q_weight_canonical(spark, sf_dir):
    li = D.load(spark, sf_dir, "lineitem")
    raw = F.col("l_extendedprice") / F.lit(X.LB_PER_KG)
    return li.select("l_orderkey", "l_linenumber", "l_extendedprice", raw.alias("weight_kg_raw"),
                     X.weight_lb(raw).alias("weight_lb"), X.weight_kg_canonical(raw).alias("weight_kg"))


@query("weight_semantics_case")
def q_weight_semantics_case(spark, sf_dir):
    t = D.templates(spark, sf_dir)
    return t.select("exercise_template_id", "exercise_type", "weight_semantics", "is_bodyweight",
                    X.supports_load_metrics("exercise_type").alias("supports_load_metrics"),
                    X.has_estimated_load("exercise_type").alias("has_estimated_load"))


@query("null_blank_text")
def q_null_blank_text(spark, sf_dir):
    d = D.load(spark, sf_dir, "documents")
    notes = X.nullif_blank("text")
    return d.select("doc_id", notes.isNull().alias("notes_is_null"),
                    F.char_length(notes).cast("long").alias("notes_chars"),
                    (F.char_length("text") - F.coalesce(F.char_length(notes), F.lit(0))).cast("long").alias("trimmed_chars"))


# ---------------------------------------------------------------- joins (J*)

@query("era_range_join")
def q_era_range_join(spark, sf_dir):
    w = D.workouts(spark, sf_dir)
    return w.select(F.col("workout_id").alias("o_orderkey"), "workout_date_local", "training_era")


@query("era_range_join_bucketed")
def q_era_range_join_bucketed(spark, sf_dir):
    """Same join forced down the bucketed path (as used when the range table is large)."""
    w = D.workouts(spark, sf_dir).drop("training_era")
    eras = D.era_seed(spark).select(F.col("era").alias("training_era"), "start_date", "end_date")
    j = range_join(w, eras, F.col("workout_date_local"), "start_date", "end_date", "left", max_broadcast_rows=0, bucket="month")
    return j.select(F.col("workout_id").alias("o_orderkey"), "workout_date_local", "training_era")


@query("dim_inner_join")
def q_dim_inner_join(spark, sf_dir):
    m = build_marts(*[D.staging(spark, sf_dir)[k] for k in ("workouts", "sets", "templates", "crosswalk")])
    return m["dim_exercise"].select("exercise_template_id", "exercise_title", "canonical_exercise",
                                    "movement_pattern", "is_unilateral", "is_compound", "exercise_type",
                                    "weight_semantics", "is_bodyweight", "supports_load_metrics",
                                    "has_estimated_load")


@query("fact_left_join")
def q_fact_left_join(spark, sf_dir):
    fs = _marts(spark, sf_dir)["fct_set"]
    return fs.withColumn("updated_at", ntz("updated_at"))


@query("unmapped_keys_anti")
def q_unmapped_keys_anti(spark, sf_dir):
    st = D.staging(spark, sf_dir)
    unmapped = st["sets"].join(st["crosswalk"].select("exercise_template_id"), "exercise_template_id", "left_anti")
    titled = unmapped.join(st["templates"].select("exercise_template_id", "exercise_title"),
                           "exercise_template_id", "left")
    return titled.groupBy("exercise_template_id").agg(
        F.max("exercise_title").alias("exercise_title"),
        F.count_distinct("workout_id").cast("long").alias("sessions_affected"))


# ---------------------------------------------------------------- aggregates (A*)

@query("session_rollup")
def q_session_rollup(spark, sf_dir):
    fw = _marts(spark, sf_dir)["fct_workout"]
    return fw.drop("created_at", "updated_at", "session_duration", "routine_id")


@query("exercise_session_rollup")
def q_exercise_session_rollup(spark, sf_dir):
    return _marts(spark, sf_dir)["int_exercise_sessions"]


# ---------------------------------------------------------------- windows (W*)

@query("gap_since_last_exposure")
def q_gap_since_last_exposure(spark, sf_dir):
    r = _marts(spark, sf_dir)["int_exercise_rest_intervals"]
    return r.select("workout_id", "canonical_exercise", "workout_date_local", "days_since_last_exposure")


@query("gap_since_last_workout")
def q_gap_since_last_workout(spark, sf_dir):
    from repsmith.operators.windows import gap_since_previous
    fw = _marts(spark, sf_dir)["fct_workout"].select("workout_id", "workout_date_local")
    return gap_since_previous(fw, [], "workout_date_local", "workout_id", "days_since_last_workout")


@query("gap_since_last_workout_by_athlete")
def q_gap_since_last_workout_by_athlete(spark, sf_dir):
    from repsmith.operators.windows import gap_since_previous
    w = D.workouts(spark, sf_dir).select("workout_id", "athlete_id", "workout_date_local")
    return gap_since_previous(w, ["athlete_id"], "workout_date_local", "workout_id", "days_since_last_workout")


def _fes(spark, sf_dir) -> DataFrame:
    return _marts(spark, sf_dir)["fct_exercise_session"]


@query("trailing_90d_max")
def q_trailing_90d_max(spark, sf_dir):
    return _fes(spark, sf_dir).select("workout_id", "canonical_exercise", "workout_date_local", "working_e1rm_lb",
                                      "trailing_90d_max_e1rm_lb", "trailing_90d_max_e1rm_kg")


@query("relative_performance")
def q_relative_performance(spark, sf_dir):
    return _fes(spark, sf_dir).select("workout_id", "canonical_exercise", "relative_performance")


@query("pr_flags")
def q_pr_flags(spark, sf_dir):
    return _fes(spark, sf_dir).select("workout_id", "canonical_exercise", "is_pr")


@query("exercise_session_fact")
def q_exercise_session_fact(spark, sf_dir):
    return _fes(spark, sf_dir)


@query("trailing_median")
def q_trailing_median(spark, sf_dir):
    from repsmith.operators.windows import trailing_range_percentile
    s = _marts(spark, sf_dir)["int_exercise_sessions"]
    t = trailing_range_percentile(s, ["canonical_exercise"], "workout_date_local", "working_e1rm_lb",
                                  "trailing_90d_median_e1rm_lb")
    return t.select("workout_id", "canonical_exercise", r6("trailing_90d_median_e1rm_lb").alias("trailing_90d_median_e1rm_lb"))


# Marts of many athletes: gaps, baselines and PRs per athlete.

ATHLETE = ("athlete_id",)


@query("exercise_session_fact_by_athlete")
def q_exercise_session_fact_by_athlete(spark, sf_dir):
    return D.marts(spark, sf_dir, ATHLETE)["fct_exercise_session"]


@query("obt_wide_by_athlete")
def q_obt_wide_by_athlete(spark, sf_dir):
    return D.marts(spark, sf_dir, ATHLETE)["obt_sets"]


@query("trailing_median_by_athlete")
def q_trailing_median_by_athlete(spark, sf_dir):
    from repsmith.operators.windows import trailing_range_percentile
    s = D.marts(spark, sf_dir, ATHLETE)["int_exercise_sessions"]
    t = trailing_range_percentile(s, ["athlete_id", "canonical_exercise"], "workout_date_local", "working_e1rm_lb",
                                  "trailing_90d_median_e1rm_lb")
    return t.select("workout_id", "athlete_id", "canonical_exercise",
                    r6("trailing_90d_median_e1rm_lb").alias("trailing_90d_median_e1rm_lb"))


# ---------------------------------------------------------------- incremental

@query("incremental_key_replace")
def q_incremental_key_replace(spark, sf_dir):
    s = D.sets(spark, sf_dir, keep=("l_shipdate",))
    cut = F.lit(INCREMENT_CUTOFF).cast("timestamp_ntz")
    v1 = s.where(F.col("l_shipdate") < cut)                                     # state before the cutoff
    deleted = (D.load(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
               .select(F.col("o_orderkey").alias("workout_id")))
    changed = s.where(F.col("l_shipdate") >= cut).select("workout_id").unionByName(deleted)
    delta = s.join(changed, "workout_id", "left_semi").join(deleted, "workout_id", "left_anti")
    out = D.with_set_key(key_replace(v1, delta, "workout_id", changed))
    return out.select("workout_id", "set_key", "set_index", "reps", "weight_lb", "set_type")


@query("delta_keys_semi")
def q_delta_keys_semi(spark, sf_dir):
    st = D.staging(spark, sf_dir)
    w = st["workouts"]
    target = (st["sets"].join(w.select("workout_id", "updated_at"), "workout_id")
              .where(F.col("updated_at") < F.lit(TARGET_BEFORE).cast("timestamp")))
    changed = delta_since(w, target, "updated_at")
    out = D.with_set_key(st["sets"].join(changed.select("workout_id", "updated_at"), "workout_id", "inner"))
    return out.select("workout_id", "set_key", ntz("updated_at").alias("updated_at"))


@query("obt_wide")
def q_obt_wide(spark, sf_dir):
    return _marts(spark, sf_dir)["obt_sets"]


# ---------------------------------------------------------------- checks (Q*, R*)

@query("check_unique")
def q_check_unique(spark, sf_dir):
    return Q.check_unique(D.load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("check_unique_passes")
def q_check_unique_passes(spark, sf_dir):
    o = D.load(spark, sf_dir, "orders")
    return Q.summarize({"orders.o_orderkey": Q.check_unique(o, "o_orderkey"),
                        "customer.c_custkey": Q.check_unique(D.load(spark, sf_dir, "customer"), "c_custkey"),
                        "lineitem.l_orderkey_l_linenumber": Q.check_unique(D.load(spark, sf_dir, "lineitem"),
                                                                           ["l_orderkey", "l_linenumber"])})


NOT_NULL_COLUMNS = ["canonical_exercise", "movement_pattern", "training_era", "weight_lb", "reps", "rpe",
                    "set_type", "supports_load_metrics", "duration_seconds"]


@query("check_not_null")
def q_check_not_null(spark, sf_dir):
    return Q.null_counts(_marts(spark, sf_dir)["fct_set"], NOT_NULL_COLUMNS)


@query("check_accepted_values")
def q_check_accepted_values(spark, sf_dir):
    o = D.load(spark, sf_dir, "orders")
    return Q.check_accepted_values(o, "o_orderpriority", ACCEPTED_PRIORITIES).select("o_orderkey", "o_orderpriority")


@query("check_relationships")
def q_check_relationships(spark, sf_dir):
    m = _marts(spark, sf_dir)
    st = D.staging(spark, sf_dir)
    orphans_dim = Q.check_relationships(m["fct_set"], "exercise_template_id", m["dim_exercise"], "exercise_template_id")
    orphans_w = Q.check_relationships(st["sets"], "workout_id", st["workouts"], "workout_id")
    a = orphans_dim.groupBy(F.lit("fct_set.exercise_template_id->dim_exercise").alias("relationship"),
                            F.col("exercise_template_id").alias("child_key"))
    b = orphans_w.groupBy(F.lit("sets.workout_id->workouts").alias("relationship"),
                          F.col("workout_id").alias("child_key"))
    agg = [F.count(F.lit(1)).cast("long").alias("n_rows")]
    return a.agg(*agg).unionByName(b.agg(*agg))


@query("check_rollup_parity")
def q_check_rollup_parity(spark, sf_dir):
    m = _marts(spark, sf_dir)
    actual = m["fct_set"].groupBy("workout_id").agg(
        F.count(F.lit(1)).cast("long").alias("total_sets"),
        F.sum(F.when(F.col("is_working_set"), 1).otherwise(0)).cast("long").alias("total_working_sets"))
    expected = written(m["fct_workout"].where(F.col("total_sets") > 0).select("workout_id", "total_sets", "total_working_sets"), "expected")
    diff = Q.reconcile_by_checksum(expected, written(actual, "actual"), "workout_id", ["total_sets", "total_working_sets"])
    n = expected.agg(F.count(F.lit(1)).cast("long").alias("workouts_compared"))
    return n.select("workouts_compared",
                    diff.agg(F.count(F.lit(1)).cast("long")).scalar().alias("workouts_mismatched"))


@query("check_sanity_guards")
def q_check_sanity_guards(spark, sf_dir):
    e = _event_local(spark, sf_dir)
    micros = F.floor(F.col("value") * F.lit(60000000.0)).cast("long")
    e = e.withColumn("duration_min", X.minutes_between(F.col("ts"), F.timestamp_micros(
        F.unix_micros(F.col("ts").cast("timestamp")) + micros)))
    return Q.summarize({
        "local_time_offset_applied": Q.check_columns_differ(e, F.col("started_at_local"), F.col("ts")),
        "duration_sane_0_480": Q.check_range(e, "duration_min", 0, 480),
    })


@query("value_histogram")
def q_value_histogram(spark, sf_dir):
    fs = _marts(spark, sf_dir)["fct_set"]
    e = _event_local(spark, sf_dir)
    w = D.workouts(spark, sf_dir)
    h1 = _hist(fs, "set_type", "set_type")
    h2 = _hist(e, X.local_hour("started_at_local").cast("string"), "local_hour")
    h3 = _hist(w, F.col("day_of_week"), "workout_day_of_week")
    return h1.unionByName(h2).unionByName(h3)


def _hist(df, value, name) -> DataFrame:
    from repsmith.operators.rollups import histogram
    return histogram(df, value).select(
        F.lit(name).alias("histogram"), F.col("bucket").cast("string").alias("bucket"), "n")


@query("unit_provenance")
def q_unit_provenance(spark, sf_dir):
    return Q.unit_provenance(_marts(spark, sf_dir)["fct_set"], "weight_lb")


@query("reconcile_diff")
def q_reconcile_diff(spark, sf_dir):
    li = D.load(spark, sf_dir, "lineitem")
    expected = li.groupBy(F.col("l_orderkey").alias("workout_id")).agg(F.count(F.lit(1)).cast("long").alias("n_sets"))
    fs = _marts(spark, sf_dir)["fct_set"].where(F.col("canonical_exercise").isNotNull())
    actual = fs.groupBy("workout_id").agg(F.count(F.lit(1)).cast("long").alias("n_sets"))
    return Q.reconcile_by_checksum(written(expected, "expected"), written(actual, "actual"), "workout_id", ["n_sets"])


@query("newest_record_listing")
def q_newest_record_listing(spark, sf_dir):
    """Newest workout end to end (R9/O5): arg-max by start instant, its hour and exercise count, its set listing."""
    from repsmith.operators.rollups import argmax_row
    m = _marts(spark, sf_dir)
    live = D.workouts(spark, sf_dir).where(~F.col("is_deleted")).select("workout_id", "started_at_utc")
    newest = argmax_row(live, [F.col("started_at_utc"), F.col("workout_id")]).select("workout_id")
    w = m["fct_workout"].join(newest, "workout_id").select("workout_id", "title", "hour_local", "total_exercises")
    return (m["fct_set"].join(w, "workout_id")
            .select("workout_id", "title", "hour_local", "total_exercises", "exercise_index", "set_index", "set_type", "weight_lb", "reps"))


# ---------------------------------------------------------------- analyses (D*, G*)

def _rel(spark, sf_dir) -> DataFrame:
    return _fes(spark, sf_dir)


@query("recovery_curve_buckets")
def q_recovery_curve_buckets(spark, sf_dir):
    r = A.recovery_curve(_rel(spark, sf_dir))
    return r.select("rest_bucket", "n", r6("mean_relative_performance").alias("mean_relative_performance"),
                    r6("median_relative_performance").alias("median_relative_performance"))


@query("recovery_trend_ols")
def q_recovery_trend_ols(spark, sf_dir):
    t = A.ols_trend(_rel(spark, sf_dir), F.col("movement_pattern"), "days_since_last_exposure", "relative_performance")
    return t.select("trend_group", r9("slope").alias("slope"), r9("intercept").alias("intercept"),
                    r9("r2").alias("r2"), "n")


@query("time_of_day_quartiles")
def q_time_of_day_quartiles(spark, sf_dir):
    e = _event_local(spark, sf_dir).withColumn("local_hour", X.local_hour("started_at_local"))
    b = A.box_stats(e, [F.col("local_hour")], "value")
    return b.select("local_hour", "n", "min_value", "max_value", r6("q1").alias("q1"), r6("median").alias("median"),
                    r6("q3").alias("q3"))


@query("time_of_day_by_weekday")
def q_time_of_day_by_weekday(spark, sf_dir):
    e = _event_local(spark, sf_dir).withColumn("local_hour", X.local_hour("started_at_local")) \
        .withColumn("day_of_week_number", X.iso_day_of_week("started_at_local"))
    b = A.box_stats(e, [F.col("day_of_week_number"), F.col("local_hour")], "value")
    return b.select("day_of_week_number", "local_hour", "n", r6("median").alias("median"))


@query("relative_performance_by_hour")
def q_relative_performance_by_hour(spark, sf_dir):
    """D3 on the session fact, with the era as control."""
    b = A.box_stats(_rel(spark, sf_dir), [F.col("training_era"), F.col("workout_hour_local")], "relative_performance")
    return b.select("training_era", "workout_hour_local", "n", r6("q1").alias("q1"), r6("median").alias("median"), r6("q3").alias("q3"))


@query("relative_performance_by_weekday_hour")
def q_relative_performance_by_weekday_hour(spark, sf_dir):
    """The same within each weekday."""
    s = _rel(spark, sf_dir).withColumn("day_of_week_number", X.iso_day_of_week("workout_date_local"))
    b = A.box_stats(s, [F.col("day_of_week_number"), F.col("workout_hour_local")], "relative_performance")
    return b.select("day_of_week_number", "workout_hour_local", "n", r6("median").alias("median"))


@query("recent_prs")
def q_recent_prs(spark, sf_dir):
    return A.recent_prs(_rel(spark, sf_dir))


@query("min_sample_pooling")
def q_min_sample_pooling(spark, sf_dir):
    s = _rel(spark, sf_dir).where(F.col("relative_performance").isNotNull())
    p = A.pooled_groups(s, "canonical_exercise", "movement_pattern", POOLING_MIN_SESSIONS, by=["training_era"])
    return p.select("training_era", "group_level", "analysis_group", "n_sessions",
                    r6("mean_relative_performance").alias("mean_relative_performance"))


@query("progression_trend")
def q_progression_trend(spark, sf_dir):
    t = A.progression_trend(_rel(spark, sf_dir), ["canonical_exercise", "training_era"])
    return t.select("canonical_exercise", "training_era",
                    X.round_half_away("slope_per_day", 4).alias("slope_per_day"), "n")


@query("reps_at_load")
def q_reps_at_load(spark, sf_dir):
    fs = _marts(spark, sf_dir)["fct_set"].where(
        F.col("is_working_set") & F.col("canonical_exercise").isNotNull() & ~F.col("is_dropset"))
    return A.reps_at_load(fs, ["workout_id", "canonical_exercise"])


@query("date_dimension")
def q_date_dimension(spark, sf_dir):
    return A.date_dimension(_marts(spark, sf_dir)["fct_workout"], "workout_date_local")


@query("era_month_summary")
def q_era_month_summary(spark, sf_dir):
    m = _marts(spark, sf_dir)
    s = A.era_month_summary(m["fct_workout"], m["fct_set"])
    return s.select("training_era", "month", "workouts",
                    r6("avg_working_sets_per_exercise").alias("avg_working_sets_per_exercise"),
                    r6("share_single_set").alias("share_single_set"), "failure_sets")


@query("gap_distribution")
def q_gap_distribution(spark, sf_dir):
    from repsmith.operators.windows import gap_since_previous
    w = D.workouts(spark, sf_dir).select("workout_id", "athlete_id", "workout_date_local", "training_era")
    g = gap_since_previous(w, ["athlete_id"], "workout_date_local", "workout_id", "days_since_last_workout")
    d = A.gap_distribution(g, by=["training_era"])
    return d.select("training_era", "n_gaps", r6("share_1_2_days").alias("share_1_2_days"), "max_gap")


@query("effort_summary")
def q_effort_summary(spark, sf_dir):
    e = A.effort_summary(_marts(spark, sf_dir)["fct_set"])
    return e.select("training_era", "working_sets", r6("rpe_coverage").alias("rpe_coverage"),
                    r6("share_low_effort").alias("share_low_effort"))


@query("snapshot_scd2")
def q_snapshot_scd2(spark, sf_dir):
    e = _events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
    h = cdc.snapshot_scd2(e, "user_id", "ts", ["event_type"], tiebreak=["event_id"])
    return h.select("user_id", "event_id", F.col("ts").alias("valid_from"), "valid_to", "event_type", "is_current")


@query("filter_values")
def q_filter_values(spark, sf_dir):
    s = _rel(spark, sf_dir)
    pats = A.filter_values(s, "movement_pattern", A.equals_or_all("training_era", "hit"))
    ex = A.filter_values(s, "canonical_exercise",
                         A.equals_or_all("training_era", "hit") & A.equals_or_all("movement_pattern", "SMALL"))
    return (pats.select(F.lit("movement_pattern").alias("filter"), F.col("movement_pattern").alias("value"))
            .unionByName(ex.select(F.lit("canonical_exercise").alias("filter"),
                                   F.col("canonical_exercise").alias("value"))))


# ---------------------------------------------------------------- sources

@query("table_inventory")
def q_table_inventory(spark, sf_dir):
    return table_inventory({t: D.load(spark, sf_dir, t) for t in D.TABLES})


# ---------------------------------------------------------------- ingest compositions

def _feed_records(spark, sf_dir) -> DataFrame:
    """The events table as a change feed of per-user entity documents, in delivery order."""
    e = _events(spark, sf_dir)
    iso = X.iso_utc_text(F.col("ts").cast("timestamp"))
    upd = F.to_json(F.struct(F.lit("updated").alias("type"), F.struct(
        F.col("user_id").alias("id"), F.col("event_type").alias("title"), iso.alias("updated_at")).alias("workout")))
    dele = F.to_json(F.struct(F.lit("deleted").alias("type"), F.col("user_id").alias("id"), iso.alias("deleted_at")))
    rec = F.when(F.col("event_type") == D.FEED_DELETE_TYPE, dele).otherwise(upd)
    return e.select(rec.alias("record"), F.col("ts").alias("page"), F.col("event_id").alias("pos"))


@query("feed_entity_refresh")
def q_feed_entity_refresh(spark, sf_dir):
    from repsmith.plans.ingest import entities_from_feed
    ent = entities_from_feed(_feed_records(spark, sf_dir))
    return ent.select("record_id", J.json_text("record", "$.title").alias("title"),
                      J.json_text("record", "$.updated_at").alias("updated_at"))


@query("snapshot_ingest")
def q_snapshot_ingest(spark, sf_dir):
    from repsmith.plans.ingest import identify, snapshot_to_land
    e = _events(spark, sf_dir)
    doc = F.to_json(F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("type"),
                             J.json_text("props", "$.k").cast("long").alias("k")))
    fetched = e.select(doc.alias("record"), F.floor(F.col("event_id") / 100).alias("page"),
                       (F.col("event_id") - F.floor(F.col("event_id") / 100) * 100).alias("pos"))
    stored = (identify(e.where(F.col("ts") < F.lit(STORED_BEFORE).cast("timestamp_ntz"))
                       .select(doc.alias("record"), F.col("ts").cast("timestamp").alias("ingested_at"))))
    out = snapshot_to_land(fetched, stored)
    return out.select("record_id", J.json_text("record", "$.type").alias("entity_type"),
                      J.json_text("record", "$.k").cast("long").alias("k"))


# ---------------------------------------------------------------- reconciliation

@query("reconcile_counts")
def q_reconcile_counts(spark, sf_dir):
    m = _marts(spark, sf_dir)
    o, li = D.load(spark, sf_dir, "orders"), D.load(spark, sf_dir, "lineitem")
    cnt = lambda df: df.agg(F.count(F.lit(1)).alias("n"))
    return Q.count_checks({
        "workouts": (cnt(o), cnt(m["fct_workout"])),
        "sets": (cnt(li), cnt(m["fct_set"])),
        "working_sets": (cnt(li.where(F.col("l_returnflag") != "R")),
                         m["fct_workout"].agg(F.sum("total_working_sets").alias("n"))),
        "exercises": (li.agg(F.count_distinct("l_orderkey", "l_partkey").alias("n")),
                      m["fct_workout"].agg(F.sum("total_exercises").alias("n"))),
    })


@query("set_type_reconcile")
def q_set_type_reconcile(spark, sf_dir):
    li = D.load(spark, sf_dir, "lineitem")
    expected = li.groupBy(D.set_type_of().alias("set_type")).agg(F.count(F.lit(1)).alias("n"))
    actual = _marts(spark, sf_dir)["fct_set"].groupBy("set_type").agg(F.count(F.lit(1)).alias("n"))
    return Q.compare_counts(expected, actual, "set_type")


@query("local_time_reconcile")
def q_local_time_reconcile(spark, sf_dir):
    from repsmith.functions.independent import local_parts_independent
    e = _events(spark, sf_dir)
    local = X.to_local("ts", D.LOCAL_TZ)
    native = e.groupBy(F.to_date(local).alias("local_date"), X.local_hour(local).alias("local_hour")).agg(F.count(F.lit(1)).alias("n"))
    indep = (e.select(local_parts_independent("ts", D.LOCAL_TZ).alias("p"))
             .groupBy(F.col("p.local_date").alias("local_date"), F.col("p.local_hour").alias("local_hour")).agg(F.count(F.lit(1)).alias("n")))
    return Q.compare_counts(native, indep, ["local_date", "local_hour"])


# ---------------------------------------------------------------- designed analyses

DISRUPTED_PERIODS = [("1996-06-01", "1996-08-31"), ("1999-12-15", "2000-01-15")]


@query("disrupted_period_flags")
def q_disrupted_period_flags(spark, sf_dir):
    periods = D.seed_frame(spark, DISRUPTED_PERIODS, ["start_date DATE", "end_date DATE"])
    w = D.workouts(spark, sf_dir).select(F.col("workout_id").alias("o_orderkey"), "workout_date_local")
    return A.flag_periods(w, "workout_date_local", periods)


# ---------------------------------------------------------------- streaming

@query("stream_latest_state")
def q_stream_latest_state(spark, sf_dir):
    """The events table drained through a stateful streaming aggregation into a keyed table."""
    from repsmith.streaming.state import latest_state_table
    return latest_state_table(spark, sf_dir, "events", "user_id", ["ts", "event_id"], ["event_type", "value"]) \
        .select("user_id", "event_id", "ts", "event_type", "value")


@query("weight_reconcile")
def q_weight_reconcile(spark, sf_dir):
    """Distinct converted weights from the fact vs an independent NumPy recomputation
    from the raw prices; a full outer join shows values present on one side only."""
    from repsmith.functions.independent import weight_lb_independent
    native = _marts(spark, sf_dir)["fct_set"].select("weight_lb").distinct().withColumn("in_native", F.lit(True))
    indep = (D.load(spark, sf_dir, "lineitem")
             .select(weight_lb_independent(F.col("l_extendedprice") / F.lit(X.LB_PER_KG)).alias("weight_lb"))
             .distinct().withColumn("in_independent", F.lit(True)))
    from repsmith.operators.joins import join_null_safe
    j = join_null_safe(native, indep, ["weight_lb"], "full_outer")
    return j.select("weight_lb", F.coalesce("in_native", F.lit(False)).alias("in_native"),
                    F.coalesce("in_independent", F.lit(False)).alias("in_independent"))


QUERIES.update(document_queries.QUERIES)
