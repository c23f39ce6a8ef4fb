"""Join operators.

Broadcast is used only behind a proven bound: ``broadcast_if_bounded`` counts the candidate
side (one number per task). Anything larger is left to Spark: the static
``autoBroadcastJoinThreshold`` estimate and AQE's runtime switch, which measure real
sizes, and AQE skew-join splitting for hot keys on the shuffle path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repsmith.functions._util import as_col, ColumnOrName

DEFAULT_BROADCAST_ROWS = 100_000


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (a distributed count)."""
    return df.count() <= max_rows


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when its row count is proven small, else ``df`` unchanged."""
    return F.broadcast(df) if has_at_most(df, max_rows) else df


def range_join(left: DataFrame, ranges: DataFrame, value: ColumnOrName, start: str, end: str,
               how: str = "left", max_broadcast_rows: int = 100, bucket: str | None = None,
               per_range: dict[str, tuple[str, str | None]] | None = None) -> DataFrame:
    """Interval join: ``value BETWEEN start AND end`` (both ends inclusive).

    A handful of ranges (proven by a bounded count), such as training eras, -> broadcast and
    compared row by row, no shuffle of ``left``. More -> the sweep over slices of
    :mod:`repsmith.operators.interval_sweep`. With ``bucket`` (month, year) each range is
    exploded into the calendar periods it covers instead (clamped to the span of ``left``'s
    values), equi-joined on the period, then filtered by the exact bounds. Overlapping ranges
    duplicate rows, as the SQL join would. ``how`` is inner, left, left_semi or left_anti:
    unmatched ranges are not asked for here, and exploded ranges could not give them.

    With ``per_range`` (name -> ("count", None), ("min", column) or ("max", column); ``how`` inner) the
    result is not the pairs but the matched ranges with these aggregates of their rows of ``left``. Ranges
    that overlap have pairs that grow with the square of the data; the aggregates are taken without them.
    """
    if per_range is not None:
        if how != "inner":
            raise ValueError("aggregates per range come with how='inner'")
        from repsmith.operators.interval_sweep import sweep_aggregate
        return sweep_aggregate(left, ranges, as_col(value), start, end, per_range)
    if how not in ("inner", "left", "left_outer", "leftouter", "left_semi", "left_anti"):
        raise ValueError(f"range_join does not support how={how!r}")
    v = as_col(value)
    if has_at_most(ranges, max_broadcast_rows):
        r = F.broadcast(ranges)
        return left.join(r, (v >= r[start]) & (v <= r[end]), how)
    if bucket is None:
        from repsmith.operators.interval_sweep import sweep_join
        return sweep_join(left, ranges, v, start, end, how)
    lo = left.agg(F.min(v).cast("date")).scalar()        # scalar subqueries: the data's span
    hi = left.agg(F.max(v).cast("date")).scalar()
    unit = {"month": "MM", "year": "year"}[bucket]
    step = F.expr(f"INTERVAL 1 {bucket.upper()}")
    r = (ranges.where((F.col(end).cast("date") >= lo) & (F.col(start).cast("date") <= hi))
         .withColumn("__b", F.explode(F.sequence(
             F.trunc(F.greatest(F.col(start).cast("date"), lo), unit),
             F.trunc(F.least(F.col(end).cast("date"), hi), unit), step))))
    l = left.withColumn("__b", F.trunc(v.cast("date"), unit))
    out = l.join(r, (l["__b"] == r["__b"]) & (v >= r[start]) & (v <= r[end]), how)
    return out.drop("__b")


def dimension_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column, how: str = "left",
                   max_broadcast_rows: int | None = None) -> DataFrame:
    """Fact-to-dimension join. With ``max_broadcast_rows`` the dimension is broadcast only
    when proven that small; otherwise the planner and AQE pick the strategy."""
    d = broadcast_if_bounded(dim, max_broadcast_rows) if max_broadcast_rows else dim
    return fact.join(d, on, how)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where a null key matches a null key (``IS NOT DISTINCT FROM``),
    as group keys behave. The key columns appear once (coalesced for outer joins)."""
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        e = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = e if cond is None else cond & e
    j = left.join(r, cond, how)
    if how in ("full", "full_outer", "outer", "fullouter", "right", "right_outer", "rightouter"):
        for k in keys:
            j = j.withColumn(k, F.coalesce(F.col(k), F.col(f"__r_{k}")))
    return j.drop(*[f"__r_{k}" for k in keys])


def null_safe_key(c: ColumnOrName, fill: str = "") -> Column:
    """``coalesce(k, '')`` join key so null keys pair with null keys (still a hash-join key)."""
    return F.coalesce(as_col(c).cast("string"), F.lit(fill))


def unmatched(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    """Anti join: rows of ``left`` with no partner in ``right``."""
    return left.join(right, on, "left_anti")


def matched(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    """Semi join (``IN (subquery)``): rows of ``left`` with a partner, never duplicated."""
    return left.join(right, on, "left_semi")


def zero_filled(left: DataFrame, rollup: DataFrame, on: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Left join a rollup and turn missing counts into 0."""
    out = left.join(rollup, on, "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0).cast(rollup.schema[c].dataType)))
    return out
