"""Incremental maintenance.

``key_replace`` is the logical delete+insert by key. ``KeyedTable`` persists it without
a table format that has MERGE: rows are stored partitioned by a hash bucket of the
key, and an increment reads and rewrites only the buckets its changed keys hash to, with
dynamic partition overwrite. The new content of those buckets is staged in the
session's shared checkpoint folder first, so the write never reads the files it
replaces and a lost executor recomputes from the staged files, not from a half-written
table; they are removed after the write. Each rewritten bucket carries one marker row, so a bucket whose rows were all
deleted is still overwritten (dynamic overwrite leaves partitions it does not write).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from repsmith.functions._util import as_col, ColumnOrName
from repsmith.operators.joins import join_null_safe
from repsmith.session import path_exists, remove_tree, staged

BUCKET = "__bucket"
MARKER = "__marker"
#: With ``deltas``: the increment a row came with, after how many increments touched buckets are
#: rewritten, and up to how many replaced keys go to every task (more are joined as Spark sees fit).
BATCH, REWRITE_EVERY, BROADCAST_KEYS = "__batch", 16, 2_000_000


def key_replace(target: DataFrame, delta: DataFrame, keys: Sequence[str] | str,
                changed_keys: DataFrame | None = None) -> DataFrame:
    """Drop every target row whose key is in ``changed_keys`` (default: keys present in
    ``delta``), then append ``delta``. Pass the full changed-key list -- including deleted
    and emptied entities -- so they leave the target too."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    ck = changed_keys if changed_keys is not None else delta.select(*keys)
    return target.join(ck.select(*keys).distinct(), keys, "left_anti").unionByName(delta)


def delta_since(source: DataFrame, target: DataFrame, ts: str, target_ts: str | None = None,
                default: str = "1970-01-01 00:00:00") -> DataFrame:
    """Rows of ``source`` with ``ts >= coalesce(max(target_ts), default)`` (inclusive).

    The boundary is a scalar subquery (one aggregate, evaluated once and inlined into the
    filter), so nothing is collected to the driver and no join is planned.
    """
    mark = target.agg(F.coalesce(F.max(F.col(target_ts or ts).cast("timestamp")),
                                 F.lit(default).cast("timestamp")).alias("__mark"))
    return source.where(F.col(ts).cast("timestamp") >= mark.scalar())


def bucket_of(keys: Sequence[ColumnOrName], n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[as_col(k) for k in keys]), F.lit(n_buckets)).cast("int")


def buckets_for(table_bytes: int, target_bucket_bytes: int = 1 << 30, minimum: int = 16) -> int:
    """Bucket count so one bucket holds about ``target_bucket_bytes`` (an increment rewrites
    whole buckets, so this bounds the write amplification): 100 TB at 1 GiB -> 102,400
    buckets. Rounded up to a power of two so the count can later be doubled by splitting."""
    n = max(minimum, -(-table_bytes // target_bucket_bytes))
    return 1 << (n - 1).bit_length()


class KeyedTable:
    """A Parquet table replaced by key, one hash bucket at a time.

    Size ``n_buckets`` with :func:`buckets_for` from the expected table size: an increment
    rewrites every bucket one of its changed keys hashes to, so the cost of an increment is
    (touched buckets) x (bucket size).

    With ``deltas`` an increment only appends, to the buckets of its keys: the new rows, and a marker row
    for each replaced key. Reading drops the rows of a key that came before its newest marker. Every
    REWRITE_EVERY-th increment rewrites the buckets it touches, so what reading has to drop stays small.
    For increments whose keys are few but hash to all buckets; one write, so a stopped one shows nothing."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] | str, n_buckets: int = 64, deltas: bool = False):
        self.deltas = deltas
        self.spark, self.path = spark, path
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.n_buckets = n_buckets

    def _bucket(self) -> Column:
        return bucket_of([F.col(k) for k in self.keys], self.n_buckets)

    def _raw(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def exists(self) -> bool:
        try:
            self.spark.read.parquet(self.path).schema
            return True
        except AnalysisException:
            return False

    def read(self) -> DataFrame:
        return self._current(self._raw())

    def _current(self, raw: DataFrame) -> DataFrame:
        rows = raw.where(~F.col(MARKER)).drop(MARKER, BUCKET)
        if not self.deltas:
            return rows
        replaced = raw.where(F.col(MARKER) & (F.col(BATCH) > 0)).groupBy(*self.keys).agg(F.max(BATCH).alias("__newest"))
        n = replaced.count()
        if not n:
            return rows.drop(BATCH)
        replaced = replaced.select(*[F.col(k).alias(f"__r_{k}") for k in self.keys], "__newest")
        older = rows[BATCH] < replaced["__newest"]
        for k in self.keys:
            older = older & rows[k].eqNullSafe(replaced[f"__r_{k}"])
        return rows.join(F.broadcast(replaced) if n <= BROADCAST_KEYS else replaced, older, "left_anti").drop(BATCH)

    def overwrite(self, df: DataFrame) -> None:
        """Full rebuild (first load or full refresh). One marker row carries the schema, so an
        empty table can be read."""
        rows = self._tagged(df, 0)
        marker = self.spark.range(1).select(*[(F.lit(True) if f.name == MARKER else F.lit(0 if f.name in (BUCKET, BATCH) else None)).cast(f.dataType).alias(f.name)
                                              for f in rows.schema.fields])
        self._write(rows.unionByName(marker), "overwrite")

    def _tagged(self, df: DataFrame, batch: int) -> DataFrame:
        rows = df.withColumn(MARKER, F.lit(False)).withColumn(BUCKET, self._bucket())
        return rows.withColumn(BATCH, F.lit(batch)) if self.deltas else rows

    def _write(self, rows: DataFrame, mode: str) -> None:
        rows.write.mode(mode).partitionBy(BUCKET).option("compression", "zstd").parquet(self.path)

    def buckets(self, keys: DataFrame) -> list[int]:
        """The buckets that ``keys`` hash to: at most ``n_buckets`` numbers."""
        return sorted(r["b"] for r in keys.select(self._bucket().alias("b")).distinct().collect())

    def read_buckets(self, buckets: Sequence[int]) -> DataFrame:
        """:meth:`read`, but of the given buckets; the other partitions' files are not listed in the scan."""
        return self._current(self._raw().where(F.col(BUCKET).isin(*buckets) if buckets else F.lit(False)))

    def replace_keys(self, delta: DataFrame, changed_keys: DataFrame | None = None) -> None:
        """Delete+insert by key: ``changed_keys`` (plus the delta's own keys) leave, ``delta`` enters.
        The first increment into a table that does not exist yet creates it; one without a key
        writes nothing."""
        if not self.exists():
            self.overwrite(delta)
            return
        ck = delta.select(*self.keys)
        if changed_keys is not None:
            ck = ck.unionByName(changed_keys.select(*self.keys))
        ck = ck.distinct()
        touched = self.buckets(ck)
        if not touched:
            return
        batch = 0
        if self.deltas:
            batch = self._raw().where(MARKER).agg(F.max(BATCH).alias("b")).first()["b"] + 1
            if batch % REWRITE_EVERY:
                rows = self._tagged(delta, batch)
                gone = self._tagged(ck, batch).withColumn(MARKER, F.lit(True))
                self._write(rows.unionByName(gone, allowMissingColumns=True), "append")
                return
        kept = join_null_safe(self.read_buckets(touched), ck, self.keys, "left_anti")
        rows = self._tagged(kept.unionByName(delta), batch)
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in kept.schema.fields]
        markers = self.spark.range(self.n_buckets).where(F.col("id").isin(*touched)).select(
            *empty, F.lit(True).alias(MARKER), F.col("id").cast("int").alias(BUCKET), *([F.lit(batch).alias(BATCH)] if self.deltas else []))
        with staged(rows.unionByName(markers), "buckets") as content:
            (content.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
             .partitionBy(BUCKET).parquet(self.path))


class BatchLedger:
    """Which micro-batches of a stream have been applied: one committed marker folder per batch.

    Of a stream only the newest batch can come again, so markers of batches more than ``keep``
    behind are removed and the folder does not grow with the stream's life."""

    def __init__(self, spark: SparkSession, path: str, stream: str, keep: int = 100):
        self.spark, self.base, self.keep = spark, f"{path.rstrip('/')}/stream={stream}", keep

    def _batch(self, batch: int) -> str:
        return f"{self.base}/batch={batch}"

    def applied(self, batch: int) -> bool:
        return path_exists(self.spark, f"{self._batch(batch)}/_SUCCESS")

    def add(self, batch: int) -> None:
        self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(self._batch(batch))
        if batch >= self.keep and path_exists(self.spark, self._batch(batch - self.keep)):
            remove_tree(self.spark, self._batch(batch - self.keep))
