"""Table inventory: name, row count, column count per table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table, ordered by name; each count is its own distributed aggregate
    (Parquet answers it from footers), unioned into one frame."""
    out = None
    for name in sorted(tables):
        df = tables[name]
        part = df.agg(F.count(F.lit(1)).cast("long").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"))
        out = part if out is None else out.unionByName(part)
    return out
