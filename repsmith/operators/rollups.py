"""Aggregations. All are ``groupBy().agg()`` so Spark combines map-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repsmith.functions._util import as_col, ColumnOrName
from repsmith.functions.scalars import e1rm


def count_if_true(flag: ColumnOrName) -> Column:
    """``sum(case when flag then 1 else 0 end)``: a null flag counts 0."""
    return F.sum(F.when(as_col(flag), F.lit(1)).otherwise(F.lit(0))).cast("long")


def workout_rollup(sets: DataFrame, key: str = "workout_id", exercise_col: str = "exercise_index",
                   working_flag: str = "is_working_set", approx_distinct: bool = False) -> DataFrame:
    """Per workout: distinct exercises, sets, working sets (A4). ``approx_distinct`` uses a
    HyperLogLog++ count (A2 variant) instead of the exact distinct count."""
    distinct = (F.approx_count_distinct(exercise_col) if approx_distinct else F.count_distinct(exercise_col))
    return sets.groupBy(key).agg(
        distinct.cast("long").alias("total_exercises"),
        F.count(F.lit(1)).cast("long").alias("total_sets"),
        count_if_true(working_flag).alias("total_working_sets"))


def exercise_session_rollup(fct_set: DataFrame, group_cols: Sequence[str] = (
        "workout_id", "workout_date_local", "workout_hour_local", "training_era",
        "canonical_exercise", "movement_pattern"), extra_group_cols: Sequence[str] = ()) -> DataFrame:
    """Working sets -> one row per (workout x canonical exercise).

    Warm-ups are excluded; dropsets are folded in as a flag but excluded from the load
    metrics; unmapped exercises (null canonical) are dropped. e1RM per set is computed
    in both units and the session keeps the best.
    """
    not_drop = ~F.col("is_dropset")
    working = (fct_set.where(F.col("is_working_set"))
               .where(F.col("canonical_exercise").isNotNull())
               .withColumn("set_e1rm_lb", F.when(not_drop, e1rm("weight_lb", "reps")))
               .withColumn("set_e1rm_kg", F.when(not_drop, e1rm("weight_kg", "reps"))))
    return working.groupBy(*extra_group_cols, *group_cols).agg(
        F.max("set_e1rm_lb").alias("working_e1rm_lb"),
        F.max("set_e1rm_kg").alias("working_e1rm_kg"),
        F.max(F.when(not_drop, F.col("weight_lb"))).alias("weight_lb"),
        F.max(F.when(not_drop, F.col("weight_kg"))).alias("weight_kg"),
        F.max(F.when(not_drop, F.col("reps"))).alias("reps"),
        F.bool_or("is_dropset").alias("has_intensity_technique"),
        F.bool_or("supports_load_metrics").alias("supports_load_metrics"),
        F.bool_or("has_estimated_load").alias("has_estimated_load"))


def histogram(df: DataFrame, value: ColumnOrName, name: str = "bucket") -> DataFrame:
    """Value histogram: ``group by x, count(*)``."""
    return df.groupBy(as_col(value).alias(name)).agg(F.count(F.lit(1)).cast("long").alias("n"))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Distinct values, sorted (A12, D1 filter lists)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def argmax_row(df: DataFrame, order_by: Sequence[ColumnOrName]) -> DataFrame:
    """The single row with the greatest ``order_by`` tuple (O5), via a global max of a struct
    (partial per task, so nothing is sorted globally)."""
    ords = [as_col(o).alias(f"__o{i}") for i, o in enumerate(order_by)]
    best = df.agg(F.max(F.struct(*ords, F.struct(*[F.col(c) for c in df.columns]).alias("__r"))).alias("__b"))
    return best.where(F.col("__b").isNotNull()).select(*[F.col(f"__b.__r.{c}").alias(c) for c in df.columns])
