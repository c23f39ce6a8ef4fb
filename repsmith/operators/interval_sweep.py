"""Interval join by slices of a common order.

Points, range starts and range ends are put in one order and cut into slices with about as many of
them each, so a hot month becomes many slices and an empty decade one. A point belongs to one slice;
a range stands in the slice it starts in, is carried open across every border up to the one it ends
in, and meets the points of each by an equi-join on the slice, with the exact bounds checked there.
A range that spans a slice matches all its points, so what is carried is bounded by the result; what
is compared in vain are the ranges that start or end in the point's own slice, about 2 R / SLICES.

Only the SLICES - 1 borders reach the driver and the rows' expressions, whatever the input's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICES, PER_SLICE, FAN = 1024, 256, 32


def _axis(columns: list[tuple[DataFrame, Column]]):
    """A function that maps the given columns' types to one numeric axis, never out of order."""
    kinds = [type(d.select(c).schema[0].dataType) for d, c in columns]
    if all(k is T.DateType for k in kinds):
        return lambda c: F.unix_date(c).cast("double")
    if all(issubclass(k, (T.DatetimeType,)) for k in kinds):
        return lambda c: F.unix_micros(c.cast("timestamp")).cast("double")
    return lambda c: c.cast("double")


def _long_axis(columns: list[tuple[DataFrame, Column]]):
    """As :func:`_axis`, but whole numbers, each step one: days or microseconds since 1970, or the integer."""
    kinds = [type(d.select(c).schema[0].dataType) for d, c in columns]
    if all(k is T.DateType for k in kinds):
        return lambda c: F.unix_date(c).cast("long")
    if all(issubclass(k, (T.DatetimeType,)) for k in kinds):
        return lambda c: F.unix_micros(c.cast("timestamp"))
    if all(issubclass(k, (T.IntegralType,)) for k in kinds):
        return lambda c: c.cast("long")
    raise ValueError(f"aggregates per range need dates, timestamps or integers, not {kinds}")


def borders_of(left: DataFrame, value: Column, ranges: DataFrame, start: str, end: str) -> tuple[list[float], object]:
    """(ascending borders between slices, the axis): quantiles of all points, starts and ends together."""
    axis = _axis([(left, value), (ranges, F.col(start)), (ranges, F.col(end))])
    spots = left.select(axis(value).alias("x")).unionByName(ranges.select(F.explode(F.array(axis(F.col(start)), axis(F.col(end)))).alias("x"))).where("x IS NOT NULL")
    every = [i / SLICES for i in range(1, SLICES)]
    r = spots.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("x", every, 20 * SLICES).alias("q")).first()
    if not r["n"]:
        return [], axis
    step = max(1, SLICES // max(1, r["n"] // PER_SLICE))
    return sorted(set(r["q"][step - 1::step])), axis


def slice_of(x: Column, borders: list[float]) -> Column:
    """How many borders are at most x: counted among every FAN-th, then within one run of FAN."""
    if not borders:
        return F.when(x.isNotNull(), F.lit(0))
    runs = [borders[i:i + FAN] for i in range(0, len(borders), FAN)]
    heads = F.array(*[F.lit(r[0]) for r in runs])
    table = F.array(*[F.array(*[F.lit(b) for b in r]) for r in runs])
    run = F.size(F.filter(heads, lambda b: b <= x))
    inside = F.size(F.filter(F.get(table, run - 1), lambda b: b <= x))
    return F.when(x.isNull(), F.lit(None)).when(run == 0, F.lit(0)).otherwise((run - 1) * FAN + inside).cast("int")


def sweep_join(left: DataFrame, ranges: DataFrame, value: Column, start: str, end: str, how: str) -> DataFrame:
    """``value BETWEEN start AND end``; ``how`` is inner, left, left_semi or left_anti. A null value or
    bound matches nothing; rows of ``left`` without a value are spread over slices of their own."""
    borders, axis = borders_of(left, value, ranges, start, end)
    points = left.withColumn("__slice", F.coalesce(slice_of(axis(value), borders), -1 - F.spark_partition_id()))
    first, last = slice_of(axis(F.col(start)), borders), slice_of(axis(F.col(end)), borders)
    carried = ranges.where(F.col(start) <= F.col(end)).withColumn("__in", F.explode(F.sequence(first, last)))
    bounds = (F.col("__slice") == F.col("__in")) & (value >= carried[start]) & (value <= carried[end])
    return points.join(carried, bounds, how).drop("__slice", "__in")


def _bin_of(x: Column, level: Column) -> Column:
    return F.call_function("shiftright", x, level)


def sweep_aggregate(points: DataFrame, ranges: DataFrame, value: Column, start: str, end: str, aggregates: dict[str, tuple[str, str | None]]) -> DataFrame:
    """``ranges`` with, of the points with ``value BETWEEN start AND end``, the ``aggregates`` (name ->
    ("count", None), ("min", column) or ("max", column)); ranges without a point do not come out. No pair
    of a point and a range is made, so ranges that overlap cost no more than others.

    A range of a length from 2**k to 2**(k + 1) - 1 reaches from one bin of 2**k into the next or the one
    after it: its points are the tail of the first bin, the head of the last, and a whole bin that may lie
    between. Tails and heads are running aggregates over points and bounds in order; a bin is cut by the
    slices of :func:`borders_of`, each summed up alone, so no task holds a hot bin. Points come once per
    power k that some range has (64 at most), and equal instants and equal ranges are taken once."""
    x = _long_axis([(points, value), (ranges, F.col(start)), (ranges, F.col(end))])
    borders, axis = borders_of(points, value, ranges, start, end)
    partial = {"count": lambda c: F.count(F.lit(1)), "min": F.min, "max": F.max}
    total = {"count": F.sum, "min": F.min, "max": F.max}
    aggregates = {**aggregates, "__n": ("count", None)}  # tells a range without a point
    names = list(aggregates)
    merge = lambda over=None: [(total[aggregates[n][0]](n) if over is None else total[aggregates[n][0]](n).over(over)).alias(n) for n in names]
    at = points.where(value.isNotNull()).groupBy(value.alias("__value")).agg(*[partial[f](c).alias(n) for n, (f, c) in aggregates.items()])
    at = at.select(x(F.col("__value")).alias("__x"), slice_of(axis(F.col("__value")), borders).alias("__slice"), *names)
    s, e = x(F.col(start)), x(F.col(end))
    each = ranges.where(F.col(start) <= F.col(end)).select(start, end).distinct().select(
        start, end, s.alias("__s"), e.alias("__e"), (F.length(F.bin(F.greatest(e - s, F.lit(1)))) - 1).cast("int").alias("__k"))
    levels = sorted(r["__k"] for r in each.select("__k").distinct().collect())  # at most 64 numbers
    nothing = [F.lit(None).cast(at.schema[n].dataType).alias(n) for n in names]
    bins = ["__k", "__bin"]

    def bound(c: str, source: str, kind: int) -> DataFrame:
        return each.select("__k", _bin_of(F.col(c), F.col("__k")).alias("__bin"), slice_of(axis(F.col(source)), borders).alias("__slice"),
                           F.col(c).alias("__x"), F.lit(kind).alias("__kind"), start, end, *nothing)

    of_points = at.withColumn("__k", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>"))).select(
        "__k", _bin_of(F.col("__x"), F.col("__k")).alias("__bin"), "__slice", "__x", F.lit(0).alias("__kind"),
        *[F.lit(None).cast(each.schema[c].dataType).alias(c) for c in (start, end)], *names)
    wide = each.where(_bin_of(F.col("__e"), F.col("__k")) > _bin_of(F.col("__s"), F.col("__k")))  # a single instant has no head of its own
    rows = of_points.unionByName(bound("__s", start, 1)).unionByName(bound("__e", end, 2).join(wide.select(start, end), [start, end], "left_semi"))
    cut = Window.partitionBy(*bins, "__slice")
    up_to = lambda order: cut.orderBy(order, "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tail, head = up_to(F.col("__x").desc()), up_to(F.col("__x"))
    inside = rows.select(*bins, "__slice", "__kind", start, end, F.struct(*merge(tail)).alias("__tail"), F.struct(*merge(head)).alias("__head")).where("__kind > 0")
    inside = inside.select(start, end, F.when(F.col("__kind") == 1, F.col("__tail")).otherwise(F.col("__head")).alias("__o")).select(start, end, "__o.*")
    slices = rows.groupBy(*bins, "__slice").agg(*merge())
    by_slice = Window.partitionBy(*bins).orderBy("__slice")
    after, before = by_slice.rowsBetween(1, Window.unboundedFollowing), by_slice.rowsBetween(Window.unboundedPreceding, -1)
    beside = slices.select(*bins, "__slice", F.struct(F.lit(1).alias("__kind"), *merge(after)).alias("__after"), F.struct(F.lit(2).alias("__kind"), *merge(before)).alias("__before"))
    of_slices = beside.select(*bins, "__slice", F.explode(F.array("__after", "__before")).alias("__o")).select(*bins, "__slice", "__o.*")
    outside = rows.where("__kind > 0").select(*bins, "__slice", "__kind", start, end).join(of_slices, [*bins, "__slice", "__kind"])
    whole = slices.groupBy(*bins).agg(*merge())
    between = each.where(_bin_of(F.col("__e"), F.col("__k")) - _bin_of(F.col("__s"), F.col("__k")) == 2).select(
        "__k", (_bin_of(F.col("__s"), F.col("__k")) + 1).alias("__bin"), start, end).join(whole, bins)
    parts = inside.unionByName(outside.select(start, end, *names)).unionByName(between.select(start, end, *names))
    found = parts.groupBy(start, end).agg(*merge()).where(F.col("__n") > 0).drop("__n")
    return ranges.join(found, [start, end], "inner")
