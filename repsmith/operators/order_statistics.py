"""Exact quantiles by distributed rank selection.

``percentile`` keeps every distinct value of a group in one buffer, and a row window sorts a whole
key in one task. Here values are first counted per (group, value), dealt by both, so a group with a
third of all rows is spread over all tasks. A monotone integer of the value, ``order_key``, then
splits them into ranges: counts per (group, coarse range) tell which ranges hold the wanted ranks,
only these are counted again by finer range, and only in the finer ranges that hold a rank are
single values looked at. A window thus runs over ranges or over the distinct values of one fine
range (a 2**-20th of an octave), never over the rows of a group.

The same walk serves the trailing form: counts per (key, day, range) add up over the days of a
frame, so the frame's ranks are found without its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repsmith.functions._util import as_col, ColumnOrName
from repsmith.operators.joins import join_null_safe
from repsmith.session import written

#: Ranges per octave: 2**FINE_BITS fine ones, 2**(FINE_BITS - COARSE_SHIFT) coarse ones.
FINE_BITS, COARSE_SHIFT = 20, 14
_BIAS = 1100 << FINE_BITS  # above the negated exponent of the smallest double


def order_key(value: ColumnOrName) -> Column:
    """A long that never falls as the double rises: floor(log2 |v| * 2**FINE_BITS), signed. Java's log
    is semi-monotone, which is all that is needed. Zero is 0; infinities and NaN (greatest) are outermost."""
    v = as_col(value)
    size = F.floor(F.log2(F.abs(v)) * (1 << FINE_BITS)).cast("long") + _BIAS
    infinite = float("inf")
    return (F.when(F.isnan(v), F.lit(1 << 62)).when(v == infinite, F.lit(1 << 61)).when(v == -infinite, F.lit(-(1 << 61)))
            .when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size).cast("long"))


def value_counts(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """``groups``, __v (double), __n rows, and the value's ranges __f (fine) and __c (coarse). Written, as
    every walk reads them: ``df`` runs once."""
    counts = df.select(*groups, F.col(value).cast("double").alias("__v")).groupBy(*groups, "__v").agg(F.count(F.lit(1)).alias("__n"))
    return written(counts, "counts").withColumn("__f", order_key("__v")).withColumn("__c", F.shiftright("__f", COARSE_SHIFT))


def _wanted(total: str, qs: Sequence[float]) -> Column:
    """Ranks (from 0) on both sides of each quantile's position: elements 2k and 2k + 1 for the k-th."""
    ranks = []
    for k, q in enumerate(qs):
        at = F.lit(float(q)) * (F.col(total) - 1)
        ranks += [F.struct(F.lit(2 * k).alias("i"), F.floor(at).alias("r")), F.struct(F.lit(2 * k + 1).alias("i"), F.ceil(at).alias("r"))]
    return F.array(*ranks)


def _walk(counts: DataFrame, part: Sequence[str], digit: str) -> DataFrame:
    """Of each part's ranges (``digit``, ascending, __n rows each) those that hold a rank of __w, with the
    ranks counted from the range's own start."""
    before = Window.partitionBy(*part).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
    d = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    held = F.filter("__w", lambda x: (x["r"] >= F.col("__before")) & (x["r"] < F.col("__before") + F.col("__n")))
    own = F.transform(held, lambda x: F.struct(x["i"].alias("i"), (x["r"] - F.col("__before")).alias("r")))
    return d.withColumn("__w", own).where(F.size("__w") > 0).drop("__before", "__n")


def _interpolated(found: DataFrame, keys: Sequence[str], total: str, qs: Sequence[float]) -> DataFrame:
    """``keys`` and __q: the quantiles in order, linear between the two ranks around each position."""
    each = found.select(*keys, total, "__v", F.explode("__w.i").alias("__i"))
    sides = each.groupBy(*keys).agg(F.max(total).alias(total), *[F.max(F.when(F.col("__i") == i, F.col("__v"))).alias(f"__s{i}") for i in range(2 * len(qs))])
    out = []
    for k, q in enumerate(qs):
        low, high, at = F.col(f"__s{2 * k}"), F.col(f"__s{2 * k + 1}"), F.lit(float(q)) * (F.col(total) - 1)
        out.append(F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high))
    return sides.select(*keys, F.array(*out).alias("__q"))


def distribution(df: DataFrame, groups: Sequence[str], value: str, qs: Sequence[float]) -> DataFrame:
    """Per group of ``groups`` (null is a group): n, mean_value, min_value, max_value and ``quantiles``
    (array, exact, linear interpolation) of the non-null values."""
    out = list(groups)
    groups = out or ["__all"]
    valued = df.where(F.col(value).isNotNull())
    counts = value_counts(valued if out else valued.withColumn("__all", F.lit(0)), groups, value)
    coarse = counts.groupBy(*groups, "__c").agg(F.sum("__n").alias("__n"), F.sum(F.col("__v") * F.col("__n")).alias("__sum"),
                                                F.min("__v").alias("__min"), F.max("__v").alias("__max"))
    whole = Window.partitionBy(*groups)
    coarse = coarse.select(*groups, "__c", "__n", *[f(c).over(whole).alias(o) for f, c, o in (
        (F.sum, "__n", "__total"), (F.sum, "__sum", "__gsum"), (F.min, "__min", "min_value"), (F.max, "__max", "max_value"))])
    first = _walk(coarse.withColumn("__w", _wanted("__total", qs)), groups, "__c")
    facts = [*groups, "__total", "__gsum", "min_value", "max_value"]
    in_first = [*groups, "__c"]
    fine = join_null_safe(counts, first.select(*in_first), in_first, "inner").groupBy(*in_first, "__f").agg(F.sum("__n").alias("__n"))
    second = _walk(join_null_safe(fine, first.select(*in_first, "__w"), in_first, "inner"), in_first, "__f")
    in_second = [*groups, "__f"]
    last = _walk(join_null_safe(counts.drop("__c"), second.select(*in_second, "__w"), in_second, "inner"), in_second, "__v")
    totals = first.select(*facts).dropDuplicates(groups)
    found = join_null_safe(last.select(*groups, "__v", "__w"), totals.select(*groups, "__total"), groups, "inner")
    q = join_null_safe(totals, _interpolated(found, groups, "__total", qs), groups, "inner")
    return q.select(*out, F.col("__total").cast("long").alias("n"), (F.col("__gsum") / F.col("__total")).alias("mean_value"),
                      "min_value", "max_value", F.col("__q").alias("quantiles"))


def _frames(found: DataFrame, lo: int, hi: int) -> DataFrame:
    """Each target day once per bin of ``lo - hi + 1`` days that its frame touches (two at most)."""
    width = lo - hi + 1
    return found.withColumn("__bin", F.explode(F.sequence(F.floor((F.col("__t") - lo) / width), F.floor((F.col("__t") - hi) / width))))


def trailing_quantile(df: DataFrame, keys: Sequence[str], day: ColumnOrName, value: str, q: float = 0.5, lo: int = 90, hi: int = 1) -> DataFrame:
    """``keys``, __t (day number) and __q: per (key, day) of ``df`` the exact quantile of the key's values
    on the days [t - lo, t - hi]; null where the frame has none.

    Three walks: over the frame's counts per coarse range (a table of days times ranges per key, whatever
    the number of rows), over the fine ranges of those that hold a rank, over the values of those. A
    frame's count is the difference of two running counts; what a walk finds (a few ranges per target) is
    written, as the next step reads it twice."""
    out = list(keys)
    keys = out or ["__all"]
    width = lo - hi + 1
    rows = (df if out else df.withColumn("__all", F.lit(0))).select(*keys, as_col(day).alias("__day"), F.col(value).cast("double").alias("__v"))
    counts = value_counts(rows, [*keys, "__day"], "__v").withColumn("__bin", F.floor(F.col("__day") / width))
    days = counts.groupBy(*keys, "__day").agg(F.max("__c").alias("__any"))  # days without a value have frames too
    valued = counts.where(F.col("__v").isNotNull())
    by_range = valued.groupBy(*keys, "__day", "__c").agg(F.sum("__n").alias("__n"))
    ranges = by_range.select(*keys, "__c").distinct()
    grid = join_null_safe(join_null_safe(days.drop("__any"), ranges, keys, "inner"), by_range, [*keys, "__day", "__c"], "left")
    days_of = Window.partitionBy(*keys, "__c").orderBy("__day")
    up_to = lambda back: F.coalesce(F.sum("__n").over(days_of.rangeBetween(Window.unboundedPreceding, -back)), F.lit(0))
    held = grid.select(*keys, F.col("__day").alias("__t"), "__c", (up_to(hi) - up_to(lo + 1)).alias("__n")).where(F.col("__n") > 0)
    target = [*keys, "__t"]
    held = held.withColumn("__total", F.sum("__n").over(Window.partitionBy(*target))).withColumn("__w", _wanted("__total", [q]))
    first = written(_walk(held, target, "__c"), "first")

    def inside(stored: DataFrame, found: DataFrame, on: list[str], also: list[str]) -> DataFrame:
        """Counts of the frames' days in the ranges found, per target, range and ``also``."""
        near = join_null_safe(stored, _frames(found.select(*target, *on), lo, hi), [*keys, *on, "__bin"], "inner")
        near = near.where((F.col("__day") >= F.col("__t") - lo) & (F.col("__day") <= F.col("__t") - hi))
        return near.groupBy(*target, *on, *also).agg(F.sum("__n").alias("__n"))

    fine_days = valued.groupBy(*keys, "__day", "__bin", "__c", "__f").agg(F.sum("__n").alias("__n"))
    in_first, in_second = [*target, "__c"], [*target, "__f"]
    second = written(_walk(join_null_safe(inside(fine_days, first, ["__c"], ["__f"]), first.select(*in_first, "__total", "__w"), in_first, "inner"), in_first, "__f"), "second")
    last = _walk(join_null_safe(inside(valued, second, ["__f"], ["__v"]), second.select(*in_second, "__total", "__w"), in_second, "inner"), in_second, "__v")
    found = _interpolated(last, target, "__total", [q]).select(*target, F.col("__q")[0].alias("__q"))
    every = days.select(*keys, F.col("__day").alias("__t"))
    return join_null_safe(every, found, target, "left").select(*out, "__t", "__q")
