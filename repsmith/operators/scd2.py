"""SCD type 2 history kept up by merging one snapshot at a time.

Three tables beside each other, all dealt by a hash bucket of the key: the open version of every
key, the closed versions, and a log of all observations. A snapshot newer than all before it
meets the open versions alone: keys whose content differs close one and open another, unchanged ones
cost nothing but the comparison, and of open and closed versions only the buckets of changed keys are
written. A late snapshot (or one that was stopped halfway and comes again) rebuilds the versions of
its own keys from their observations, and of nothing else.

The result is that of ``snapshot_scd2`` over all snapshots at once: consecutive observations of equal
content are one version, and a key that is missing from a snapshot keeps its version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repsmith.operators.cdc import snapshot_scd2
from repsmith.operators.incremental import BUCKET, BatchLedger, KeyedTable, bucket_of
from repsmith.operators.joins import join_null_safe
from repsmith.session import staged


class Scd2Table:
    """Versions of ``key`` by ``valid_from``; content is ``value_cols``."""

    def __init__(self, spark: SparkSession, path: str, key: str, valid_from: str, value_cols: Sequence[str], n_buckets: int = 64):
        self.spark, self.base, self.key, self.at, self.values = spark, path.rstrip("/"), key, valid_from, list(value_cols)
        self.open = KeyedTable(spark, f"{self.base}/open", key, n_buckets)
        self.closed = KeyedTable(spark, f"{self.base}/closed", key, n_buckets)
        self.log = KeyedTable(spark, f"{self.base}/log", key, n_buckets)
        self.started, self.merged = BatchLedger(spark, f"{self.base}/started", "s", keep=1 << 62), BatchLedger(spark, f"{self.base}/merged", "s", keep=1 << 62)
        self.marks = f"{self.base}/marks"

    def read(self) -> DataFrame:
        """All versions with valid_to and is_current."""
        live = self.open.read().withColumn("valid_to", F.lit(None).cast(self.open.read().schema[self.at].dataType))
        return self.closed.read().unionByName(live).withColumn("is_current", F.col("valid_to").isNull())

    def _append(self, table: KeyedTable, df: DataFrame) -> None:
        """Rows added to their buckets; no file that is there is read or written."""
        if not table.exists():
            table.overwrite(df)
            return
        rows = df.withColumn("__marker", F.lit(False)).withColumn(BUCKET, bucket_of([F.col(self.key)], table.n_buckets))
        rows.write.mode("append").partitionBy(BUCKET).parquet(table.path)

    def _newest(self):
        """The latest observation merged so far: one row per snapshot, one value."""
        try:
            return self.spark.read.parquet(self.marks).agg(F.max("at").alias("m")).first()["m"]
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise

    def merge(self, snapshot: DataFrame, snapshot_id: int) -> str:
        """Merge a snapshot (key, valid_from, value columns): "known" where it has been merged before and
        nothing is written, "appended" in order, "rebuilt" for a late one. Rows of one key and instant
        that differ in content are ordered by content hash, as the log has no other order."""
        if self.merged.applied(snapshot_id):
            return "known"
        again = self.started.applied(snapshot_id)
        cols = [self.key, self.at, *self.values]
        with staged(snapshot.select(*cols).distinct().withColumn("h", F.md5(F.to_json(F.struct(*self.values)))), "snapshot") as rows:
            span = rows.agg(F.min(self.at).alias("a"), F.max(self.at).alias("b"), F.count(F.lit(1)).alias("n"), F.count_distinct(F.struct(self.key)).alias("k")).first()
            newest = self._newest()
            in_order = not again and span["n"] == span["k"] and (newest is None or (span["a"] is not None and span["a"] > newest))
            self.started.add(snapshot_id)
            self._append(self.log, rows.drop("h"))
            done = self._in_order(rows) if in_order else self._rebuild(rows)
        rows_mark = self.spark.createDataFrame([(snapshot_id,)], "id long").withColumn("at", F.lit(span["b"]))
        if span["b"] is not None:
            rows_mark.write.mode("append").parquet(self.marks)
        self.merged.add(snapshot_id)
        return done

    def _in_order(self, rows: DataFrame) -> str:
        cols = [self.key, self.at, *self.values]
        if not self.open.exists():
            self.closed.overwrite(rows.select(*cols).withColumn("valid_to", F.col(self.at)).where("false"))
            self.open.overwrite(rows.select(*cols))
            return "appended"
        known = self.open.read_buckets(self.open.buckets(rows)).withColumn("h", F.md5(F.to_json(F.struct(*self.values))))
        old = known.select(self.key, *[F.col(c).alias(f"__o_{c}") for c in [self.at, *self.values, "h"]], F.lit(True).alias("__has"))
        with staged(join_null_safe(rows, old, [self.key], "left").where(F.col("__has").isNull() | (F.col("h") != F.col("__o_h"))), "changed") as changed:
            ended = changed.where("__has").select(self.key, *[F.col(f"__o_{c}").alias(c) for c in [self.at, *self.values]], F.col(self.at).alias("valid_to"))
            self._append(self.closed, ended)
            self.open.replace_keys(changed.select(*cols))
        return "appended"

    def _rebuild(self, rows: DataFrame) -> str:
        cols = [self.key, self.at, *self.values]
        keys = rows.select(self.key).distinct()
        seen = join_null_safe(self.log.read_buckets(self.log.buckets(keys)), keys, [self.key], "left_semi").distinct()
        ordered = seen.withColumn("__tie", F.md5(F.to_json(F.struct(*self.values))))
        with staged(snapshot_scd2(ordered, self.key, self.at, self.values, tiebreak=["__tie"]).drop("__tie"), "versions") as versions:
            if not self.open.exists():
                self.closed.overwrite(versions.where("false").select(*cols, "valid_to"))
                self.open.overwrite(versions.where("false").select(*cols))
            self.closed.replace_keys(versions.where("NOT is_current").select(*cols, "valid_to"), keys)
            self.open.replace_keys(versions.where("is_current").select(*cols), keys)
        return "rebuilt"
