"""Record versions, change detection and change-feed operators.

Latest-per-key is an *aggregation* over (key, ordering columns, row hash), not a
``row_number`` window: aggregation combines map-side, so a key holding a third of all
versions is reduced to one narrow row per map task before the shuffle. Wide rows
(documents) are fetched afterwards by the winners' hashes, and never sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repsmith.operators.joins import join_null_safe
from repsmith.operators.membership import with_membership
from repsmith.functions._util import as_col, ColumnOrName
from repsmith.functions.scalars import bump_millisecond, iso_utc_text

_ORD = "__ord"
_ROW = "__row"


def _any_null(keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = F.col(k).isNull()
        cond = c if cond is None else cond | c
    return cond


def _fixed_width(df: DataFrame, cols: Sequence[str]) -> bool:
    return all(isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType, T.DatetimeType)) for c in cols)


def latest_by_key(df: DataFrame, keys: Sequence[str] | str, order_by: Sequence[ColumnOrName],
                  keep_null_keys: bool = False) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` tuple (newest first).

    ``order_by`` is compared lexicographically, larger = newer; negate a column for an
    ascending tiebreak. Give a total order (event time, then position, then a hash) so
    the winner is the one meant; among equals a hash of the row decides, and of equal
    rows one stays. Rows with a null key are dropped, or all kept with ``keep_null_keys``
    (a null key identifies nothing, so nothing can supersede them). Output has the input's
    columns in the input's order.

    Where all columns are numbers, times or flags one aggregation carries them along. Other
    rows may be documents: phase one aggregates (key, order, 128-bit row hash) alone; phase
    two reads the rows again, drops by a broadcast map of the winners' hashes what is surely
    no winner, and hash-joins the rest, which leaves one row per key and chance hits.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not keys or _fixed_width(df, [c for c in df.columns if c not in keys]):
        return _latest_one_pass(df, keys, order_by, keep_null_keys)
    return _latest_two_phase(df, keys, order_by, keep_null_keys)


def _latest_one_pass(df: DataFrame, keys: list[str], order_by: Sequence[ColumnOrName], keep_null_keys: bool) -> DataFrame:
    cols = df.columns
    payload = [c for c in cols if c not in keys]
    ords = [as_col(o).alias(f"{_ORD}{i}") for i, o in enumerate(order_by)]
    keyed = df.where(~_any_null(keys)) if keys else df
    best = (keyed.groupBy(*keys)
            .agg(F.max(F.struct(*ords, F.struct(*[F.col(c) for c in payload]).alias(_ROW))).alias("__best"))
            .select(*keys, *[F.col(f"__best.{_ROW}.{c}").alias(c) for c in payload])
            .select(*cols))
    if keep_null_keys and keys:
        nulls = df.where(_any_null(keys))
        best = best.unionByName(nulls)
    return best


def _latest_two_phase(df: DataFrame, keys: list[str], order_by: Sequence[ColumnOrName], keep_null_keys: bool) -> DataFrame:
    cols = df.columns
    row = [F.col(c) for c in cols]
    ords = [as_col(o).alias(f"{_ORD}{i}") for i, o in enumerate(order_by)]
    tagged = df.select("*", *ords, F.xxhash64(*row).alias("__h1"), F.xxhash64(F.lit(1), *row).alias("__h2"))
    order = [*[f"{_ORD}{i}" for i in range(len(ords))], "__h1", "__h2"]
    best = tagged.where(~_any_null(keys)).groupBy(*keys).agg(F.max(F.struct(*order)).alias("__best"))
    winners = best.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[F.col(f"__best.{o}").alias(f"__w{o}") for o in order])
    winners = winners.withColumn("__winner", F.xxhash64(*[c for c in winners.columns]))
    null_key = _any_null(keys)
    # A null key meets no winner; its hash of the row spreads such rows over all tasks.
    rows = tagged.withColumn("__id", F.when(null_key, F.xxhash64("__h1", "__h2")).otherwise(F.xxhash64(*keys, *order)))
    maybe = with_membership(rows, "__id", winners, "__winner", "__maybe")
    maybe = maybe.where(F.col("__maybe") | null_key if keep_null_keys else F.col("__maybe")).drop("__maybe")
    same = F.col("__id") == F.col("__winner")
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"__k{i}"))
    for o in order:
        same = same & F.col(o).eqNullSafe(F.col(f"__w{o}"))
    # Winners are the side that is hashed: unique keys without payload, so a partition of them is small.
    hit = maybe.join(winners.hint("shuffle_hash"), same, "left" if keep_null_keys else "left_semi")
    if keep_null_keys:
        hit = hit.where(F.col("__winner").isNotNull() | null_key).withColumn("__each", F.when(null_key, F.monotonically_increasing_id()))
        return hit.select(*cols, "__id", "__each").dropDuplicates().select(*cols)
    return hit.select(*cols, "__id").dropDuplicates().select(*cols)


def dedupe_last_wins(df: DataFrame, keys: Sequence[str] | str, seq: Sequence[ColumnOrName]) -> DataFrame:
    """Within one pass, keep the last occurrence of each key (``seq`` = delivery order,
    e.g. page then position); rows with a null key are all kept."""
    return latest_by_key(df, keys, seq, keep_null_keys=True)


def duplicates_dropped(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """How many keyed rows a dedupe would drop (1-row frame, for the run log)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    keyed = df.where(~_any_null(keys))
    return keyed.agg((F.count(F.lit(1)) - F.count_distinct(*[F.col(k) for k in keys])).cast("long").alias("dropped"))


def changed_only(incoming: DataFrame, stored: DataFrame | None, id_col: str = "record_id",
                 hash_col: str = "record_hash", stored_order: Sequence[ColumnOrName] | None = None) -> DataFrame:
    """Keep incoming rows that are new or whose content hash differs from the latest stored
    version of the same id. No stored table -> everything. Null ids never match, so they
    are always kept (same as a dict lookup that misses)."""
    if stored is None:
        return incoming
    latest = stored.where(F.col(id_col).isNotNull())
    if stored_order is not None:
        # An id, a hash and what orders them: no documents, so one pass carries them along.
        latest = _latest_one_pass(latest.select(id_col, hash_col, *[as_col(o).alias(f"__so{i}") for i, o in enumerate(stored_order)]),
                                  [id_col], [F.col(f"__so{i}") for i in range(len(stored_order))], False)
    latest = latest.select(id_col, hash_col)
    return incoming.join(latest, [id_col, hash_col], "left_anti")


def split_feed(feed: DataFrame, type_col: str = "type", deleted_value: str = "deleted") -> tuple[DataFrame, DataFrame]:
    """Change feed -> (updated, deleted). Both lazy filters over one scan."""
    t = F.col(type_col)
    return feed.where(t != F.lit(deleted_value)), feed.where(t == F.lit(deleted_value))


def feed_counts(feed: DataFrame, op: Column) -> DataFrame:
    """Events per operation (``op`` maps a row to 'updated' / 'deleted')."""
    return feed.groupBy(op.alias("op")).agg(F.count(F.lit(1)).cast("long").alias("n_events"))


def soft_delete_flags(entities: DataFrame, feed: DataFrame, key: str, feed_key: str, is_delete: Column,
                      event_order: Sequence[ColumnOrName], deleted_at: ColumnOrName) -> DataFrame:
    """Flag entities whose *latest* feed event is a delete; a later update un-deletes.

    Adds ``is_deleted`` and ``deleted_at`` to ``entities`` (left join: entities with no
    event are live).
    """
    ev = feed.select(F.col(feed_key).alias("__k"), is_delete.alias("__del"), as_col(deleted_at).alias("__dat"),
                     *[as_col(o).alias(f"__eo{i}") for i, o in enumerate(event_order)])
    last = latest_by_key(ev, "__k", [F.col(f"__eo{i}") for i in range(len(event_order))])
    dels = last.where(F.col("__del")).select(F.col("__k"), F.col("__dat").alias("deleted_at"))
    out = entities.join(dels, entities[key] == dels["__k"], "left").drop("__k")
    return out.withColumn("is_deleted", F.col("deleted_at").isNotNull())


def high_water_mark(feed: DataFrame, ts: ColumnOrName, group_cols: Sequence[ColumnOrName] = (),
                    default: str = "1970-01-01 00:00:00") -> DataFrame:
    """Resume point: max event time (nulls skipped, empty -> epoch) plus 1 ms, as an
    instant and as ISO-Z text. Compares instants, never text."""
    agg = F.coalesce(F.max(as_col(ts).cast("timestamp")), F.lit(default).cast("timestamp"))
    g = feed.groupBy(*group_cols) if group_cols else feed.groupBy()
    out = g.agg(agg.alias("__hw"), F.count(F.lit(1)).cast("long").alias("n_events"))
    return (out.withColumn("high_water", bump_millisecond(F.col("__hw")).cast("timestamp_ntz"))
            .withColumn("high_water_iso", iso_utc_text(bump_millisecond(F.col("__hw"))))
            .drop("__hw"))


def snapshot_scd2_direct(snapshots: DataFrame, key: str, valid_from: str, value_cols: Sequence[str],
                         tiebreak: Sequence[str] = ()) -> DataFrame:
    """Per-key window form of :func:`snapshot_scd2` (reference for tests)."""
    order = [F.col(valid_from)] + [F.col(t) for t in tiebreak]
    w = Window.partitionBy(key).orderBy(*order)
    h = F.md5(F.to_json(F.struct(*[F.col(c) for c in value_cols])))
    changed = (snapshots.withColumn("__h", h)
               .withColumn("__prev", F.lag("__h").over(w))
               .where(F.col("__prev").isNull() | (F.col("__prev") != F.col("__h"))))
    return (changed.withColumn("valid_to", F.lead(valid_from).over(w))
            .withColumn("is_current", F.col("valid_to").isNull())
            .drop("__h", "__prev"))


def snapshot_scd2(snapshots: DataFrame, key: str, valid_from: str, value_cols: Sequence[str],
                  tiebreak: Sequence[str] = (), bucket: str = "day") -> DataFrame:
    """History of a current-state source (SCD type 2) from a series of snapshots.

    Consecutive snapshots with unchanged content collapse into one version;
    ``valid_to`` is the next version's ``valid_from`` (null for the current one).

    Two-level, so a key with a huge history is never sorted in one task: the row windows
    are partitioned by (key, time bucket), and the state carried across bucket boundaries
    (the previous bucket's last content, the next bucket's first change) comes from
    per-(key, bucket) summary tables windowed per key, which are bounded by the number
    of buckets, not rows.
    """
    order = [F.col(valid_from)] + [F.col(t) for t in tiebreak]
    b = F.date_trunc(bucket, F.col(valid_from).cast("timestamp"))
    h = F.md5(F.to_json(F.struct(*[F.col(c) for c in value_cols])))
    df = snapshots.withColumn("__b", b).withColumn("__h", h)
    w_in = Window.partitionBy(key, "__b").orderBy(*order)
    df = df.withColumn("__prev_in", F.lag("__h").over(w_in)).withColumn("__rn", F.row_number().over(w_in))
    # last content of each (key, bucket); the previous non-empty bucket's last content per key
    last = df.groupBy(key, "__b").agg(F.max(F.struct(*order, F.col("__h").alias("h"))).alias("__last"))
    last = last.select(key, "__b", F.lag(F.col("__last.h")).over(Window.partitionBy(key).orderBy("__b"))
                       .alias("__prev_bucket_h"))
    df = join_null_safe(df, last, [key, "__b"], "left")
    prev = F.when(F.col("__rn") == 1, F.col("__prev_bucket_h")).otherwise(F.col("__prev_in"))
    changed = (df.withColumn("__prev", prev)
               .where(F.col("__prev").isNull() | (F.col("__prev") != F.col("__h")))
               .drop("__prev_in", "__prev_bucket_h", "__prev", "__rn"))
    # valid_to: next change in the bucket, else the first change of the next bucket with one
    changed = changed.withColumn("__next_in", F.lead(valid_from).over(w_in))
    first = changed.groupBy(key, "__b").agg(F.min(F.struct(*order)).alias("__first"))
    first = first.select(key, "__b", F.lead(F.col(f"__first.{valid_from}")).over(
        Window.partitionBy(key).orderBy("__b")).alias("__next_bucket"))
    out = join_null_safe(changed, first, [key, "__b"], "left")
    valid_to = F.coalesce(F.col("__next_in"), F.col("__next_bucket"))
    return (out.withColumn("valid_to", valid_to)
            .withColumn("is_current", F.col("valid_to").isNull())
            .drop("__b", "__h", "__next_in", "__next_bucket"))
