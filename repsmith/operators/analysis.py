"""Analysis outputs and the designed analyses.

Each returns the data behind a chart or table as a grouped DataFrame; nothing is
collected. Statistics are Spark aggregates (``regr_*``); exact quantiles come from the rank
selection of :mod:`repsmith.operators.order_statistics`, which needs no buffer per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repsmith.functions._util import as_col, ColumnOrName
from repsmith.functions.scalars import day_name, iso_day_of_week, rest_bucket
from repsmith.operators.order_statistics import distribution
from repsmith.operators.windows import day_number


def filter_values(df: DataFrame, col: str, where: Column | None = None) -> DataFrame:
    """Distinct non-null values of ``col`` for a filter list."""
    d = df if where is None else df.where(where)
    return d.where(F.col(col).isNotNull()).select(col).distinct()


def equals_or_all(col: str, value: str | None) -> Column:
    """``col = value`` unless value is None / 'All' (no filter)."""
    return F.lit(True) if value in (None, "All") else (F.col(col) == F.lit(value))


def quantiles(col: str, qs, approx_accuracy: int) -> Column:
    """Sketched quantiles (``percentile_approx``) as an aggregate: rank error <= n / approx_accuracy."""
    return F.percentile_approx(F.col(col), list(qs), approx_accuracy).cast("array<double>")


def recovery_curve(sessions: DataFrame, days: str = "days_since_last_exposure",
                   perf: str = "relative_performance", cap: int = 7,
                   approx_accuracy: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Relative performance by rest-day bucket (0..6, 7+): n, mean, median (D2, G7). ``by`` adds
    controls, such as the era (G10). The median is exact, or sketched with ``approx_accuracy``."""
    d = sessions.where(F.col(perf).isNotNull()).select(*by, rest_bucket(days, cap).alias("rest_bucket"), perf)
    s = _summary(d, [*by, "rest_bucket"], perf, [0.5], approx_accuracy)
    return s.select(*by, "rest_bucket", "n", F.col("mean_value").alias("mean_relative_performance"),
                    F.col("quantiles")[0].alias("median_relative_performance"))


def _summary(df: DataFrame, groups: Sequence[str], value: str, qs: Sequence[float], approx_accuracy: int | None) -> DataFrame:
    """n, mean_value, min_value, max_value and quantiles per group of a column without nulls."""
    if not approx_accuracy:
        return distribution(df, groups, value, qs)
    return df.groupBy(*groups).agg(F.count(F.lit(1)).cast("long").alias("n"), F.avg(value).alias("mean_value"), F.min(value).alias("min_value"),
                                   F.max(value).alias("max_value"), quantiles(value, qs, approx_accuracy).alias("quantiles"))


def ols_trend(df: DataFrame, group: ColumnOrName, x: str, y: str, min_rows: int = 3) -> DataFrame:
    """Least-squares trend of ``y`` on ``x`` per group; fitted only when more than
    ``min_rows`` rows exist in total (D2). Rows with a null x or y are skipped."""
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    total = d.agg(F.count(F.lit(1)).alias("__total")).scalar()
    fits = d.groupBy(as_col(group).alias("trend_group")).agg(
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.regr_r2(F.col(y), F.col(x)).alias("r2"),
        F.regr_count(F.col(y), F.col(x)).cast("long").alias("n"))
    return fits.where(total > min_rows)


def box_stats(df: DataFrame, group: Sequence[ColumnOrName], value: str, approx_accuracy: int | None = None) -> DataFrame:
    """Quartiles (exact, linear interpolation; or sketched), whiskers and count per group (D3)."""
    d = df.where(F.col(value).isNotNull()).select(*group, F.col(value).alias("__value"))
    names = d.columns[:-1]
    s = _summary(d, names, "__value", [0.25, 0.5, 0.75], approx_accuracy)
    return s.select(*names, "min_value", "max_value", "n", F.col("quantiles")[0].alias("q1"),
                    F.col("quantiles")[1].alias("median"), F.col("quantiles")[2].alias("q3"))


def recent_prs(sessions: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """PR sessions, newest first (D4); ``also`` adds columns such as the era it is controlled by."""
    return (sessions.where(F.col("is_pr"))
            .select("workout_date_local", "canonical_exercise", "working_e1rm_lb",
                    "trailing_90d_max_e1rm_lb", "reps", "weight_lb", "workout_id", *also)
            .orderBy(F.col("workout_date_local").desc(), F.col("canonical_exercise"), F.col("workout_id")))


def pooled_groups(sessions: DataFrame, fine: str, coarse: str, min_n: int = 10,
                  metric: str = "relative_performance", by: Sequence[str] = ()) -> DataFrame:
    """Minimum-sample gate (G8): a fine group with fewer than ``min_n`` sessions is pooled
    into its coarse group. Every result carries its n."""
    from repsmith.operators.joins import join_null_safe
    counts = sessions.groupBy(*by, fine).agg(F.count(F.lit(1)).alias("__n_fine"))
    tagged = join_null_safe(sessions, counts, [*by, fine], "left")     # a null era is a group too
    use_fine = F.col("__n_fine") >= min_n
    tagged = (tagged.withColumn("analysis_group", F.when(use_fine, F.col(fine)).otherwise(F.col(coarse)))
              .withColumn("group_level", F.when(use_fine, F.lit(fine)).otherwise(F.lit(coarse))))
    return tagged.groupBy(*by, "group_level", "analysis_group").agg(
        F.count(F.lit(1)).cast("long").alias("n_sessions"),
        F.avg(metric).alias(f"mean_{metric}"))


def progression_trend(sessions: DataFrame, group: Sequence[str], date_col: str = "workout_date_local",
                      value: str = "working_e1rm_lb", min_points: int = 3) -> DataFrame:
    """Per group, least-squares slope of ``value`` per day (G18). A line needs
    ``min_points`` sessions on at least two distinct days (else the slope is undefined)."""
    d = sessions.where(F.col(value).isNotNull()).withColumn("__day", day_number(date_col).cast("double"))
    return (d.groupBy(*group).agg(
        F.regr_slope(F.col(value), F.col("__day")).alias("slope_per_day"),
        F.regr_intercept(F.col(value), F.col("__day")).alias("intercept"),
        F.regr_count(F.col(value), F.col("__day")).cast("long").alias("n"),
        F.count_distinct("__day").alias("__days"))
        .where((F.col("n") >= min_points) & (F.col("__days") >= 2)).drop("__days"))


def reps_at_load(sets: DataFrame, group: Sequence[str], weight: str = "weight_lb", reps: str = "reps") -> DataFrame:
    """Reps performed at the heaviest load of each group (G3); ties on load -> most reps."""
    best = F.max(F.struct(F.col(weight).alias("w"), F.col(reps).alias("r")))
    return (sets.where(F.col(weight).isNotNull()).groupBy(*group).agg(best.alias("__b"))
            .select(*group, F.col("__b.w").alias("top_weight_lb"), F.col("__b.r").alias("reps_at_top_weight")))


def date_dimension(df: DataFrame, date_col: str, counts: bool = True) -> DataFrame:
    """Calendar between the first and last date of ``df`` (G1), one row per day with its
    attributes (and the number of rows of ``df`` on that day). The calendar is bounded by
    the date span, not by the data volume."""
    bounds = df.agg(F.min(date_col).alias("__lo"), F.max(date_col).alias("__hi"))
    cal = bounds.select(F.explode(F.sequence(F.col("__lo"), F.col("__hi"), F.expr("INTERVAL 1 DAY"))).alias("date_day"))
    cal = cal.select(
        "date_day",
        F.year("date_day").cast("long").alias("year"),
        F.month("date_day").cast("long").alias("month"),
        F.dayofmonth("date_day").cast("long").alias("day_of_month"),
        iso_day_of_week("date_day").alias("day_of_week_number"),
        day_name("date_day").alias("day_of_week"),
        (iso_day_of_week("date_day") >= 6).alias("is_weekend"),
        F.weekofyear("date_day").cast("long").alias("iso_week"))
    if counts:
        per_day = df.groupBy(F.col(date_col).alias("date_day")).agg(F.count(F.lit(1)).cast("long").alias("n_rows"))
        cal = cal.join(per_day, "date_day", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0).cast("long")))
    return cal


def era_month_summary(fct_workout: DataFrame, fct_set: DataFrame) -> DataFrame:
    """Per era and month (G10): workouts, average working sets per exercise, share of
    single-set exercises, failure sets."""
    per_ex = (fct_set.where(F.col("is_working_set"))
              .groupBy("workout_id", "exercise_index")
              .agg(F.count(F.lit(1)).alias("__ws"),
                   F.sum(F.when(F.col("is_to_failure"), 1).otherwise(0)).alias("__fail")))
    w = fct_workout.select("workout_id", "training_era", F.trunc("workout_date_local", "MM").alias("month"))
    ex = per_ex.join(w, "workout_id")
    ex_stats = ex.groupBy("training_era", "month").agg(
        F.avg("__ws").alias("avg_working_sets_per_exercise"),
        F.avg(F.when(F.col("__ws") == 1, 1.0).otherwise(0.0)).alias("share_single_set"),
        F.sum("__fail").cast("long").alias("failure_sets"))
    wk = w.groupBy("training_era", "month").agg(F.count(F.lit(1)).cast("long").alias("workouts"))
    es = ex_stats.withColumnRenamed("training_era", "__era").withColumnRenamed("month", "__month")
    cond = wk["training_era"].eqNullSafe(es["__era"]) & (wk["month"] == es["__month"])
    return wk.join(es, cond, "left").drop("__era", "__month")


def gap_distribution(gaps: DataFrame, col: str = "days_since_last_workout", by: Sequence[str] = ()) -> DataFrame:
    """Share of 1-2 day gaps and the longest gap."""
    g = F.col(col)
    return gaps.where(g.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).cast("long").alias("n_gaps"),
        F.avg(F.when((g >= 1) & (g <= 2), 1.0).otherwise(0.0)).alias("share_1_2_days"),
        F.max(g).cast("long").alias("max_gap"))


def effort_summary(fct_set: DataFrame, by: Sequence[str] = ("training_era",), threshold: float = 9.0) -> DataFrame:
    """RPE coverage of working sets and share of low-effort sets (RPE below ``threshold``)."""
    ws = fct_set.where(F.col("is_working_set"))
    return ws.groupBy(*by).agg(
        F.count(F.lit(1)).cast("long").alias("working_sets"),
        F.avg(F.when(F.col("rpe").isNotNull(), 1.0).otherwise(0.0)).alias("rpe_coverage"),
        F.avg(F.when(F.col("rpe") < threshold, 1.0).when(F.col("rpe").isNotNull(), 0.0)).alias("share_low_effort"))


def display_limit(df: DataFrame, n: int = 20) -> DataFrame:
    """Display limit (O2): ``n <= 0`` means all rows. Pair with ``df.count()`` for "n of m"."""
    return df if n <= 0 else df.limit(n)


def exists(df: DataFrame) -> bool:
    """Existence probe (O3): reads at most one row."""
    return not df.isEmpty()


def muscle_bridge(templates: DataFrame) -> DataFrame:
    """Template -> muscle bridge with weights that sum to 1 per template (G12), so a set is
    not counted once per muscle: the primary muscle alone gets 1; with n secondaries the
    primary gets 0.5 and each secondary 0.5 / n."""
    sec = F.from_json(F.col("secondary_muscle_groups"), "array<string>")
    n = F.coalesce(F.size(sec), F.lit(0))
    n = F.when(n < 0, F.lit(0)).otherwise(n)
    prim = templates.where(F.col("primary_muscle_group").isNotNull()).select(
        "exercise_template_id", F.col("primary_muscle_group").alias("muscle"), F.lit("primary").alias("role"),
        F.when(n > 0, F.lit(0.5)).otherwise(F.lit(1.0)).alias("weight"))
    secs = templates.select("exercise_template_id", F.explode(sec).alias("muscle"), n.alias("__n")).select(
        "exercise_template_id", "muscle", F.lit("secondary").alias("role"),
        (F.lit(0.5) / F.col("__n")).alias("weight"))
    return prim.unionByName(secs)


def routine_adherence(workouts: DataFrame, workout_exercises: DataFrame, routine_exercises: DataFrame) -> DataFrame:
    """Planned vs performed exercises per workout that follows a routine (G13): planned,
    performed, matched (by template) counts.

    A plan is counted once per routine and looked up by what was done, so no workout is paired
    with the exercises of its plan."""
    w = workouts.where(F.col("routine_id").isNotNull()).select("workout_id", "routine_id")
    plan = routine_exercises.select("routine_id", "exercise_template_id").distinct()
    planned = plan.groupBy("routine_id").agg(F.count(F.lit(1)).alias("planned"))
    done = workout_exercises.select("workout_id", "exercise_template_id").distinct().join(w, "workout_id")
    per_workout = (done.join(plan.withColumn("__planned", F.lit(1)), ["routine_id", "exercise_template_id"], "left")
                   .groupBy("workout_id", "routine_id").agg(F.count(F.lit(1)).alias("performed"), F.count("__planned").alias("matched")))
    out = w.join(planned, "routine_id", "left").join(per_workout, ["workout_id", "routine_id"], "left")
    return out.select("workout_id", "routine_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("planned", "performed", "matched")])


def flag_periods(df: DataFrame, date_col: str, periods: DataFrame, flag: str = "is_disrupted") -> DataFrame:
    """Flag rows whose date falls in any listed period (G15), for any number of periods.

    The periods become the distinct days they cover within the data's span (bounded by the
    calendar), which join on equality, so overlapping periods never duplicate rows."""
    day = F.col(date_col).cast("date")
    lo, hi = df.agg(F.min(day)).scalar(), df.agg(F.max(day)).scalar()
    start, end = F.col("start_date").cast("date"), F.col("end_date").cast("date")
    days = (periods.where((end >= lo) & (start <= hi) & (start <= end))
            .select(F.explode(F.sequence(F.greatest(start, lo), F.least(end, hi))).alias("__day")).distinct())
    return df.join(days, day == F.col("__day"), "left").withColumn(flag, F.col("__day").isNotNull()).drop("__day")
