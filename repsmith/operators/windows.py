"""Window operators, rewritten so no window partition grows with the data.

A window sorts each partition inside one task. Partitioning by exercise (or with no
key at all) puts a hot exercise -- possibly a third of all rows -- into one task.
Both day-ordered windows used here only need one value per (key, day), so they run
over a per-day table whose size is bounded by the calendar, and the per-row answer is
joined back:

* gap since previous exposure: lag over distinct days; within a day only the first
  row (smallest id) gets the gap, the rest get 0 -- identical to ``lag`` over
  ``ORDER BY day, id``.
* trailing range max over ``[day - lo, day - hi]`` with ``hi >= 1``: the frame never
  includes the current day, so the max of per-day maxima equals the row-level answer.
* trailing quantile: counts per (key, day, value range) added up over the day frame and
  refined where the wanted ranks lie (exact), or per-day mergeable KLL sketches merged
  over it (approximate).

The ``*_direct`` functions are the plain row-level windows, kept as test references.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repsmith.functions._util import as_col, ColumnOrName


def day_number(d: ColumnOrName) -> Column:
    """Days since 1970-01-01 (for ``rangeBetween`` on dates)."""
    return F.unix_date(as_col(d).cast("date"))


def _join_back(df: DataFrame, per_day: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on ``on`` with null-safe equality (a null key is its own group, as in a window)."""
    r = per_day.select(*[F.col(c).alias(f"__r_{c}") for c in on],
                       *[c for c in per_day.columns if c not in on])
    cond = None
    for c in on:
        e = df[c].eqNullSafe(r[f"__r_{c}"])
        cond = e if cond is None else cond & e
    return df.join(r, cond, "left").drop(*[f"__r_{c}" for c in on])


def gap_since_previous(df: DataFrame, keys: Sequence[str], date_col: str, id_col: str, out: str) -> DataFrame:
    """``datediff(date, lag(date) over (partition by keys order by date, id))``.

    First row of a key -> null; a second row on the same day -> 0. Runs as a lag over
    the per-(key, day) table joined back on (key, day). ``keys`` may be empty (one
    global sequence; the day table is then bounded by the number of calendar days).
    """
    keys = list(keys)
    return attach_gap(df, previous_day_table(df, keys, date_col, id_col), keys, date_col, id_col, out)


def previous_day_table(df: DataFrame, keys: Sequence[str], date_col: str, id_col: str) -> DataFrame:
    """Per (key, day): the smallest id that day and the previous day with rows -- everything
    ``gap_since_previous`` needs, in a table bounded by the calendar."""
    days = df.groupBy(*keys, date_col).agg(F.min(id_col).alias("__first_id"))
    return days.withColumn("__prev", F.lag(date_col).over(Window.partitionBy(*keys).orderBy(date_col)))


def attach_gap(df: DataFrame, day_table: DataFrame, keys: Sequence[str], date_col: str, id_col: str,
               out: str) -> DataFrame:
    """Apply a :func:`previous_day_table` to rows that carry (keys, date, id) -- the rows need
    not be the ones the table was built from (e.g. sessions get their workout's gap)."""
    joined = _join_back(df, day_table, [*keys, date_col])
    gap = F.when(F.col(id_col) == F.col("__first_id"),
                 F.datediff(F.col(date_col), F.col("__prev"))).otherwise(F.lit(0))
    return joined.withColumn(out, gap.cast("long")).drop("__first_id", "__prev")


def gap_since_previous_direct(df: DataFrame, keys: Sequence[str], date_col: str, id_col: str, out: str) -> DataFrame:
    """Plain ``lag`` form of :func:`gap_since_previous` (reference for tests)."""
    w = Window.partitionBy(*keys).orderBy(date_col, id_col)
    return df.withColumn(out, F.datediff(F.col(date_col), F.lag(date_col).over(w)).cast("long"))


def trailing_range_max(df: DataFrame, keys: Sequence[str], date_col: str, values: dict[str, str],
                       lo: int = 90, hi: int = 1) -> DataFrame:
    """For each row, max of ``values`` over rows of the same key whose date lies in
    ``[date - lo, date - hi]`` (both ends inclusive; ``hi >= 1`` excludes the same day).

    ``values`` maps input column -> output column. Computed on the per-(key, day) maxima,
    then joined back.
    """
    if hi < 1:
        raise ValueError("the per-day rewrite needs a frame that excludes the current day (hi >= 1)")
    keys = list(keys)
    daily = df.groupBy(*keys, date_col).agg(*[F.max(c).alias(f"__d_{c}") for c in values])
    w = Window.partitionBy(*keys).orderBy(day_number(date_col)).rangeBetween(-lo, -hi)
    daily = daily.select(*keys, date_col, *[F.max(f"__d_{c}").over(w).alias(o) for c, o in values.items()])
    return _join_back(df, daily, [*keys, date_col])


def day_level_features(df: DataFrame, keys: Sequence[str], date_col: str, id_col: str, gap_out: str,
                       values: dict[str, str], lo: int = 90, hi: int = 1, many_keys: bool = False) -> DataFrame:
    """:func:`gap_since_previous` and :func:`trailing_range_max` in one pass: one per-(key, day)
    aggregate, one window over it (lag + range max), one join back. ``many_keys``: keys with few rows
    a day each (a person's exercise), whose rows are dealt by key once, for aggregate and window."""
    days = day_level_table(df, keys, date_col, id_col, values, lo, hi, many_keys)
    return attach_day_level(df, days, keys, date_col, id_col, gap_out)


def day_level_table(df: DataFrame, keys: Sequence[str], date_col: str, id_col: str, values: dict[str, str],
                    lo: int = 90, hi: int = 1, many_keys: bool = False) -> DataFrame:
    """Per (key, day) what :func:`day_level_features` needs: a table bounded by the keys and the calendar."""
    if hi < 1:
        raise ValueError("the per-day rewrite needs a frame that excludes the current day (hi >= 1)")
    keys = list(keys)
    dealt = df.select(*keys, date_col, id_col, *values).repartition(*keys) if many_keys else df
    days = dealt.groupBy(*keys, date_col).agg(F.min(id_col).alias("__first_id"),
                                              *[F.max(c).alias(f"__d_{c}") for c in values])
    w_lag = Window.partitionBy(*keys).orderBy(date_col)
    w_rng = Window.partitionBy(*keys).orderBy(day_number(date_col)).rangeBetween(-lo, -hi)
    return days.select(*keys, date_col, "__first_id", F.lag(date_col).over(w_lag).alias("__prev"),
                       *[F.max(f"__d_{c}").over(w_rng).alias(o) for c, o in values.items()])


def attach_day_level(df: DataFrame, days: DataFrame, keys: Sequence[str], date_col: str, id_col: str, gap_out: str) -> DataFrame:
    """Apply a :func:`day_level_table` to rows that carry (keys, date, id), which may be some of those it was built from."""
    joined = _join_back(df, days, [*keys, date_col])
    gap = F.when(F.col(id_col) == F.col("__first_id"),
                 F.datediff(F.col(date_col), F.col("__prev"))).otherwise(F.lit(0))
    return joined.withColumn(gap_out, gap.cast("long")).drop("__first_id", "__prev")


def trailing_range_max_direct(df: DataFrame, keys: Sequence[str], date_col: str, values: dict[str, str],
                              lo: int = 90, hi: int = 1) -> DataFrame:
    """Row-level window form of :func:`trailing_range_max` (reference for tests)."""
    w = Window.partitionBy(*keys).orderBy(day_number(date_col)).rangeBetween(-lo, -hi)
    for c, o in values.items():
        df = df.withColumn(o, F.max(c).over(w))
    return df


def trailing_range_percentile(df: DataFrame, keys: Sequence[str], date_col: str, value: str, out: str,
                              q: float = 0.5, lo: int = 90, hi: int = 1) -> DataFrame:
    """Exact trailing percentile (robust baseline, G6) over ``[date - lo, date - hi]``.

    Per (key, day) by rank selection on mergeable counts, joined back to the rows; no window holds
    the rows of a key. Rows without a date have no frame: null."""
    keys = list(keys)
    from repsmith.operators.order_statistics import trailing_quantile
    dated = df.where(F.col(date_col).isNotNull())
    daily = trailing_quantile(dated, keys, day_number(date_col), value, q, lo, hi).withColumnRenamed("__q", out)
    return _join_back(df.withColumn("__t", day_number(date_col)), daily, [*keys, "__t"]).drop("__t")


def trailing_range_quantile_sketch(df: DataFrame, keys: Sequence[str], date_col: str, value: str, out: str,
                                   q: float = 0.5, lo: int = 90, hi: int = 1, k: int | None = None) -> DataFrame:
    """Approximate trailing quantile that stays bounded under skew.

    One mergeable KLL sketch per (key, day) -- built with partial aggregation -- is merged
    over the ``[day - lo, day - hi]`` range frame of the per-day table, so no task holds a
    hot key's rows and the window runs over days, not rows. Rank error ~1.65% at the
    default ``k`` (200); larger ``k`` is more exact. Empty frames give null.
    """
    agg = F.kll_sketch_agg_double(F.col(value).cast("double"), k) if k else F.kll_sketch_agg_double(F.col(value).cast("double"))
    daily = df.groupBy(*keys, date_col).agg(agg.alias("__sk"))
    w = Window.partitionBy(*keys).orderBy(day_number(date_col)).rangeBetween(-lo, -hi)
    merged = F.kll_merge_agg_double(F.col("__sk"), k) if k else F.kll_merge_agg_double(F.col("__sk"))
    daily = daily.select(*keys, date_col, F.when(F.count("__sk").over(w) > 0, F.kll_sketch_get_quantile_double(
        merged.over(w), F.lit(float(q)))).alias(out))
    return _join_back(df, daily, [*keys, date_col])


def relative_performance(current: ColumnOrName, baseline: ColumnOrName) -> Column:
    """``current / baseline`` when the baseline is positive, else null (ANSI-safe)."""
    b = as_col(baseline)
    return F.when(b > 0, as_col(current) / b).otherwise(F.lit(None).cast("double"))


def pr_flag(current: ColumnOrName, baseline: ColumnOrName, require_value: bool = False) -> Column:
    """True when there is no baseline or the current value beats it; else false.

    Like the SQL it mirrors, a session with no value and no baseline is a PR;
    ``require_value=True`` makes a null current value never a PR.
    """
    c, b = as_col(current), as_col(baseline)
    expr = F.when(b.isNull(), F.lit(True)).when(c > b, F.lit(True)).otherwise(F.lit(False))
    if require_value:
        expr = F.when(c.isNull(), F.lit(False)).otherwise(expr)
    return expr
