"""Registered queries of the incremental and merge mechanisms, with SQL for their results."""

from __future__ import annotations

from pyspark.sql import functions as F

from repsmith.functions import scalars as X
from repsmith.operators import quality as Q
from repsmith.operators.cdc import latest_by_key
from repsmith.operators.joins import range_join
from repsmith.operators.scd2 import Scd2Table
from repsmith.plans import document_queries as doc
from repsmith.plans import driver_tables as D
from repsmith.plans import ingest_run
from repsmith.plans.document_queries import query


@query("era_range_join_sweep", "SELECT workout_id AS o_orderkey, workout_date_local, training_era FROM workouts", ("workouts",))
def q_era_range_join_sweep(spark, sf_dir):
    """The era join by the sweep (as used for more than a handful of ranges)."""
    w = D.workouts(spark, sf_dir).drop("training_era")
    eras = D.era_seed(spark).select(F.col("era").alias("training_era"), "start_date", "end_date")
    j = range_join(w, eras, F.col("workout_date_local"), "start_date", "end_date", "left", max_broadcast_rows=0)
    return j.select(F.col("workout_id").alias("o_orderkey"), "workout_date_local", "training_era")


@query("overlapping_ranges", """
SELECT a.o_orderkey AS workout_id, count(*) AS n_near, min(b.o_orderkey) AS first_near, max(b.o_orderkey) AS last_near
FROM orders a JOIN orders b ON b.o_orderdate BETWEEN a.o_orderdate AND a.o_orderdate + INTERVAL '2' DAY
WHERE a.o_orderpriority = '1-URGENT' GROUP BY a.o_orderkey""")
def q_overlapping_ranges(spark, sf_dir):
    """Per urgent workout, the workouts that start within two days of it: as many overlapping ranges as such workouts."""
    o = D.load(spark, sf_dir, "orders")
    ranges = o.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").alias("workout_id"), F.col("o_orderdate").alias("since"), (F.col("o_orderdate") + F.expr("INTERVAL '2' DAY")).alias("until"))
    near = range_join(o.select("o_orderkey", "o_orderdate"), ranges, F.col("o_orderdate"), "since", "until", "inner", per_range={
        "n_near": ("count", None), "first_near": ("min", "o_orderkey"), "last_near": ("max", "o_orderkey")})
    return near.groupBy("workout_id").agg(F.sum("n_near").alias("n_near"), F.min("first_near").alias("first_near"), F.max("last_near").alias("last_near"))


@query("reconcile_changed_rows", """
SELECT CAST(l_orderkey AS BIGINT) AS workout_id, CAST(l_linenumber AS BIGINT) AS set_index,
       l_quantity AS expected_reps, CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_quantity + 1 END AS actual_reps
FROM (SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2)
WHERE l_orderkey % 97 = 0 OR l_orderkey % 89 = 3""")
def q_reconcile_changed_rows(spark, sf_dir):
    """Two copies of the sets, one with some workouts missing and some edited: the differing keys by checksums."""
    li = D.load(spark, sf_dir, "lineitem")
    sets = li.groupBy(F.col("l_orderkey").cast("long").alias("workout_id"), F.col("l_linenumber").cast("long").alias("set_index")).agg(F.max("l_quantity").alias("reps"))
    other = sets.where(F.col("workout_id") % 97 != 0).withColumn("reps", F.col("reps") + F.when(F.col("workout_id") % 89 == 3, 1).otherwise(0))
    return Q.reconcile_by_checksum(sets, other, ["workout_id", "set_index"], ["reps"])


@query("scd2_merge", """
WITH s AS (SELECT user_id, date_trunc('week', ts) AS since, arg_max(event_type, struct_pack(a := ts, b := event_id)) AS title FROM events GROUP BY 1, 2),
c AS (SELECT *, lag(title) OVER (PARTITION BY user_id ORDER BY since) AS before FROM s),
v AS (SELECT user_id, since, title FROM c WHERE before IS NULL OR before <> title)
SELECT user_id, title, since AS valid_from, lead(since) OVER (PARTITION BY user_id ORDER BY since) AS valid_to,
       lead(since) OVER (PARTITION BY user_id ORDER BY since) IS NULL AS is_current FROM v""")
def q_scd2_merge(spark, sf_dir):
    """Weekly snapshots of every user's last event type, merged one by one; the second week arrives last."""
    e = D.load(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", F.date_trunc("week", F.col("ts")).cast("timestamp_ntz").alias("valid_from"))
    weekly = latest_by_key(e, ["user_id", "valid_from"], [F.col("ts"), F.col("event_id")]).select("user_id", "valid_from", F.col("event_type").alias("title"))
    table = Scd2Table(spark, doc._scratch(spark, "scd2"), "user_id", "valid_from", ["title"], n_buckets=8)
    weeks = [r["valid_from"] for r in e.select("valid_from").distinct().orderBy("valid_from").collect()]  # a number per week
    for at in [*weeks[:1], *weeks[2:], *weeks[1:2]]:
        table.merge(weekly.where(F.col("valid_from") == F.lit(at).cast("timestamp_ntz")), weeks.index(at))
    return table.read().select("user_id", "title", "valid_from", "valid_to", "is_current")


@query("ingest_runs", f"""
WITH e AS (SELECT *, ts + to_microseconds(event_id) AS own FROM events),
f AS (SELECT count(DISTINCT user_id) AS n, max(own) + INTERVAL 1 MILLISECOND AS m FROM e WHERE ts < TIMESTAMP '{doc.STATE_FROM}' AND event_type <> 'error'),
x AS (SELECT count(DISTINCT user_id) AS c FROM e WHERE ts < TIMESTAMP '{doc.STATE_FROM}'),
i AS (SELECT count(*) AS n, max(own) + INTERVAL 1 MILLISECOND AS m FROM e, f WHERE own >= f.m)
SELECT 'r1' AS run_id, 'exercise_templates' AS dataset, 'snapshot' AS mode, (SELECT count(*) FROM part) AS n_records, CAST(NULL AS BIGINT) AS expected, CAST(NULL AS BOOLEAN) AS counts_match, CAST(NULL AS VARCHAR) AS high_water
UNION ALL SELECT 'r1', 'workouts', 'full', n, c, n = c, strftime(m, '%Y-%m-%dT%H:%M:%S.%fZ') FROM f, x
UNION ALL SELECT 'r2', 'exercise_templates', 'snapshot', (SELECT count(*) FROM part WHERE p_partkey % 7 = 0), NULL, NULL, NULL
UNION ALL SELECT 'r2', 'workout_events', 'incremental', n, NULL, NULL, strftime(m, '%Y-%m-%dT%H:%M:%S.%fZ') FROM i
UNION ALL SELECT 'r3', 'exercise_templates', 'snapshot', 0, NULL, NULL, NULL
UNION ALL SELECT 'r3', 'workout_events', 'incremental', 0, NULL, NULL, strftime(m, '%Y-%m-%dT%H:%M:%S.%fZ') FROM i""")
def q_ingest_runs(spark, sf_dir):
    """Three runs: no mark yet, so the workouts are pulled whole; then the feed since the mark, with some
    templates edited; then nothing new. The summaries without the seconds."""
    base = doc._scratch(spark, "ingest")
    events = doc._events(spark, sf_dir)
    early = events.where(F.col("ts") < F.lit(doc.STATE_FROM).cast("timestamp_ntz"))
    parts = D.load(spark, sf_dir, "part").select("p_partkey", "p_name").repartition("p_partkey")  # a small file: dealt before its documents are made

    def source(edited: bool) -> ingest_run.Source:
        def fetch(dataset, since):
            if dataset == "exercise_templates":
                title = F.when(F.lit(edited) & (F.col("p_partkey") % 7 == 0), F.concat("p_name", F.lit("!"))).otherwise(F.col("p_name"))
                return parts.select(F.to_json(F.struct(F.col("p_partkey").alias("id"), title.alias("title"))).alias("record"), F.lit(1).alias("page"), F.col("p_partkey").alias("pos"))
            at = doc._offset_text(F.col("own"))
            body = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("title"), at.alias("updated_at"))
            if dataset == "workouts":
                return early.where(F.col("event_type") != D.FEED_DELETE_TYPE).select(F.to_json(body).alias("record"), F.lit(1).alias("page"), F.col("event_id").alias("pos"))
            gone = F.to_json(F.struct(F.lit("deleted").alias("type"), F.col("user_id").alias("id"), at.alias("deleted_at")))
            record = F.when(F.col("event_type") == D.FEED_DELETE_TYPE, gone).otherwise(F.to_json(F.struct(F.lit("updated").alias("type"), body.alias("workout"))))
            return events.where(F.col("own") >= F.lit(since).cast("timestamp")).select(record.alias("record"), F.lit(1).alias("page"), F.col("event_id").alias("pos"))
        return ingest_run.Source(fetch, lambda: early.agg(F.count_distinct("user_id").alias("n")))

    out = None
    for run_id, edited in (("r1", False), ("r2", True), ("r3", True)):
        s = ingest_run.run(spark, source(edited), base, run_id, datasets=("exercise_templates", "workouts")).drop("elapsed_s")
        out = s if out is None else out.unionByName(s)
    return out


@query("paging_stop", """
WITH p AS (SELECT o_custkey AS list, year(o_orderdate) - 1994 AS page, count(*) FILTER (WHERE o_orderkey % 5 <> 0) AS n_records, max(o_custkey % 6 + 1) AS page_count FROM orders GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY list ORDER BY page) = page AND coalesce(bool_and(n_records > 0 AND page_count > page) OVER (PARTITION BY list ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS reached FROM p)
SELECT list, page, n_records FROM r WHERE reached""")
def q_paging_stop(spark, sf_dir):
    """Every customer's orders as a paged list, a page a year: the pages that paging reaches."""
    o = D.load(spark, sf_dir, "orders")
    pages = o.groupBy(F.col("o_custkey").alias("list"), (F.year("o_orderdate") - 1994).cast("long").alias("page")).agg(
        F.count(F.when(F.col("o_orderkey") % 5 != 0, 1)).alias("n_records"), F.max(F.col("o_custkey") % 6 + 1).alias("page_count"))
    return ingest_run.read_pages(pages, ["list"]).select("list", "page", "n_records")


@query("recovery_curve_by_era", """
SELECT training_era, CASE WHEN days_since_last_exposure >= 7 THEN '7+' ELSE CAST(days_since_last_exposure AS VARCHAR) END AS rest_bucket, count(*) AS n,
       floor(avg(relative_performance) * 1000 + 0.5) / 1000 AS mean_relative_performance, floor(quantile_cont(relative_performance, 0.5) * 1000 + 0.5) / 1000 AS median_relative_performance
FROM fes WHERE relative_performance IS NOT NULL GROUP BY 1, 2""", ("fes",))
def q_recovery_curve_by_era(spark, sf_dir):
    """D2 with the era as control."""
    from repsmith.operators.analysis import recovery_curve
    r = recovery_curve(D.marts(spark, sf_dir)["fct_exercise_session"], by=["training_era"])
    r3 = lambda c: (F.floor(F.col(c) * 1000 + 0.5) / 1000).alias(c)
    return r.select("training_era", "rest_bucket", "n", r3("mean_relative_performance"), r3("median_relative_performance"))


@query("recent_prs_by_era", """
SELECT training_era, canonical_exercise, workout_id, workout_date_local, working_e1rm_lb,
       count(*) OVER (PARTITION BY training_era) AS era_prs
FROM fes WHERE is_pr AND training_era IS NOT DISTINCT FROM 'volume' OR is_pr AND training_era IS NULL""", ("fes",))
def q_recent_prs_by_era(spark, sf_dir):
    """D4 with the era control: the PR sessions of one era, and those of none, with each era's number."""
    from repsmith.operators.analysis import equals_or_all, recent_prs
    s = D.marts(spark, sf_dir)["fct_exercise_session"]
    prs = recent_prs(s.where(equals_or_all("training_era", "volume") | F.col("training_era").isNull()).where(equals_or_all("training_era", "All")), also=["training_era"])
    n = prs.groupBy("training_era").agg(F.count(F.lit(1)).alias("era_prs"))  # a row per era
    from repsmith.operators.joins import join_null_safe
    return join_null_safe(prs, n, ["training_era"], "inner").select("training_era", "canonical_exercise", "workout_id", "workout_date_local", "working_e1rm_lb", "era_prs")


def _as_first_stored(spark, sf_dir):
    """Staging frames, and as first stored: the workouts, some of them deleted, and the rows of the sets, the warm-ups of some workouts missing."""
    st = D.staging(spark, sf_dir)
    w = st["workouts"].withColumn("is_deleted", F.col("workout_id") % 211 == 5)
    rows = D.set_rows(spark, sf_dir).where(~((F.col("workout_id") % 173 == 1) & X.set_flags(D.set_type_of())["is_warmup"]))
    return st, w, rows


@query("mart_refresh", "")  # its SQL is that of obt_wide, see oracle_sql
def q_mart_refresh(spark, sf_dir):
    """The marts stored with some sets missing and some workouts deleted, then two increments that bring
    the sets and the workouts back: the wide table equals that of the whole data."""
    from repsmith.plans import marts as M
    from repsmith.plans.mart_refresh import StoredMarts
    st, w, rows = _as_first_stored(spark, sf_dir)
    dim = M.dim_exercise(st["templates"], st["crosswalk"])
    stored = StoredMarts(spark, doc._scratch(spark, "marts"), n_buckets=16)
    stored.build(w, rows, dim, D.set_columns)
    ids = st["workouts"].select("workout_id")
    stored.refresh(w, st["sets"], dim, ids.where(F.col("workout_id") % 173 == 1), 1)
    stored.refresh(st["workouts"], st["sets"], dim, ids.where(F.col("workout_id") % 211 == 5), 2)
    from repsmith.plans.catalog import QUERIES
    return stored.obt_sets.read().select(*QUERIES["obt_wide"](spark, sf_dir).columns)
