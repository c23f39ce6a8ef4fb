"""Data-quality checks and reconciliation.

Every check returns the *offending* rows (empty = pass) as a DataFrame, so a check is
just another distributed query; ``summarize`` folds any number of them into one
(check, n_failing) frame without collecting rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repsmith.functions._util import as_col, ColumnOrName
from repsmith.functions.scalars import LB_PER_KG, near_step
from repsmith.operators.joins import join_null_safe


def check_unique(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    cols = [cols] if isinstance(cols, str) else list(cols)
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).cast("long").alias("n_rows"))
            .where(F.col("n_rows") > 1))


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: (column_name, n_null), from a single aggregation pass."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in cols])
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in cols]))
    return agg.select(stacked.alias("s")).select("s.column_name", "s.n_null")


def check_accepted_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is outside ``values`` (nulls pass, as a not_null check covers them)."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(*values))


def check_relationships(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    p = parent.select(F.col(parent_col).alias("__pk")).distinct()
    return (child.where(F.col(child_col).isNotNull())
            .join(p, F.col(child_col) == F.col("__pk"), "left_anti"))


def check_range(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Rows outside ``[lo, hi]`` (e.g. workout duration 0..480 min)."""
    return df.where((F.col(col) < lo) | (F.col(col) > hi))


def check_columns_differ(df: DataFrame, a: ColumnOrName, b: ColumnOrName) -> DataFrame:
    """Rows where ``a = b`` although they must differ (local time equal to UTC wall time)."""
    return df.where(as_col(a) == as_col(b))


def reconcile(expected: DataFrame, actual: DataFrame, keys: Sequence[str] | str,
              values: Sequence[str]) -> DataFrame:
    """Keys whose values differ between two independently computed frames (full outer
    join; a key missing on one side counts as a difference). Null-safe comparison."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    e = expected.select(*keys, *[F.col(v).alias(f"expected_{v}") for v in values])
    a = actual.select(*keys, *[F.col(v).alias(f"actual_{v}") for v in values])
    j = join_null_safe(e, a, keys, "full_outer")
    same = None
    for v in values:
        s = F.col(f"expected_{v}").eqNullSafe(F.col(f"actual_{v}"))
        same = s if same is None else same & s
    return j.where(~same)


CHECKSUM_RANGES = 1024


def _checksums(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Order-free sums of row hashes: count, xor and the sums of both halves (31 and 32 bits)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.bit_xor("__h").alias("x"), F.sum(F.col("__h").bitwiseAND(F.lit((1 << 31) - 1))).alias("lo"),
                               F.sum(F.shiftrightunsigned("__h", 32)).alias("hi"))


def _differing(expected: DataFrame, actual: DataFrame, by: Sequence[str]) -> DataFrame:
    """Ranges whose checksums differ; a range on one side only differs."""
    e, a = _checksums(expected, by), _checksums(actual, by)
    j = e.select(*by, F.struct("n", "x", "lo", "hi").alias("__e")).join(a.select(*by, F.struct("n", "x", "lo", "hi").alias("__a")), list(by), "full_outer")
    return j.where(~F.col("__e").eqNullSafe(F.col("__a"))).select(*by)


def reconcile_by_checksum(expected: DataFrame, actual: DataFrame, keys: Sequence[str] | str, values: Sequence[str]) -> DataFrame:
    """:func:`reconcile`, comparing checksums of key ranges first and descending only where they differ.

    A range is a part of the keys' hash space: CHECKSUM_RANGES of them, then as many within each that
    differs. The sums combine map-side, so frames that agree exchange one row per range and task, and the
    full outer join sees the keys of differing ranges alone. Frames are read up to three times, so pass
    tables or cheap plans. Sides of unlike types only descend more often; rows are compared as there."""
    keys = [keys] if isinstance(keys, str) else list(keys)

    def tagged(df: DataFrame) -> DataFrame:
        plain = [F.col(c).cast("long") if isinstance(df.schema[c].dataType, T.IntegralType) else F.col(c) for c in [*keys, *values]]
        k = F.xxhash64(*plain[:len(keys)])
        return df.select(*keys, *values, F.xxhash64(*plain).alias("__h"), F.pmod(k, F.lit(CHECKSUM_RANGES)).alias("__r1"),
                         F.pmod(F.shiftrightunsigned(k, 32), F.lit(CHECKSUM_RANGES)).alias("__r2"))

    e, a = tagged(expected), tagged(actual)
    first = F.broadcast(_differing(e, a, ["__r1"]))  # at most CHECKSUM_RANGES rows
    e1, a1 = e.join(first, "__r1", "left_semi"), a.join(first, "__r1", "left_semi")
    second = F.broadcast(_differing(e1, a1, ["__r1", "__r2"]))  # at most CHECKSUM_RANGES ** 2 pairs of numbers
    near = [d.join(second, ["__r1", "__r2"], "left_semi").select(*keys, *values) for d in (e1, a1)]
    return reconcile(*near, keys, values)


def compare_counts(expected: DataFrame, actual: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Two histograms side by side (full outer join on the bucket): key, expected_n,
    actual_n, matches. A bucket present on one side only counts 0 on the other (R4, R5)."""
    keys = [key] if isinstance(key, str) else list(key)
    e = expected.select(*keys, F.col("n").cast("long").alias("expected_n"))
    a = actual.select(*keys, F.col("n").cast("long").alias("actual_n"))
    j = join_null_safe(e, a, keys, "full_outer")
    j = j.withColumn("expected_n", F.coalesce("expected_n", F.lit(0).cast("long"))) \
         .withColumn("actual_n", F.coalesce("actual_n", F.lit(0).cast("long")))
    return j.withColumn("matches", F.col("expected_n") == F.col("actual_n"))


def count_checks(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(check, expected, actual, matches) for named pairs of 1-row, 1-column frames."""
    out = None
    for name, (e, a) in pairs.items():
        ee = e.select(F.col(e.columns[0]).cast("long").alias("expected"))
        actual = a.select(F.col(a.columns[0]).cast("long")).scalar()
        part = ee.select(F.lit(name).alias("check"), "expected", actual.alias("actual")) \
            .withColumn("matches", F.col("expected").eqNullSafe(F.col("actual")))
        out = part if out is None else out.unionByName(part)
    return out


def unit_provenance(weights_lb: DataFrame, col: str = "weight_lb") -> DataFrame:
    """Classify each distinct weight: on a 0.25 lb step (entered in pounds), else on a
    0.5 kg step (entered in kilograms), else unexplained (R8)."""
    w = F.col(col)
    cls = (F.when(near_step(w, 0.25), F.lit("lb_native"))
           .when(near_step(w / F.lit(LB_PER_KG), 0.5), F.lit("kg_native"))
           .otherwise(F.lit("unexplained")))
    return (weights_lb.where(w.isNotNull()).select(w).distinct()
            .groupBy(cls.alias("provenance")).agg(F.count(F.lit(1)).cast("long").alias("n_weights")))


def summarize(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, n_failing) for each named check, as one unioned frame."""
    out = None
    for name, df in checks.items():
        part = df.agg(F.count(F.lit(1)).cast("long").alias("n_failing")).select(F.lit(name).alias("check"), "n_failing")
        out = part if out is None else out.unionByName(part)
    return out
