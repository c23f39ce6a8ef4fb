"""Ingest compositions over landed records.

Network paging itself is not built (no Spark core); these functions take the records a
fetch produced -- already a DataFrame of raw JSON text (``record``) with its delivery
order (``page``, ``pos``) -- and decide what to land.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repsmith.functions.versions import own_time
from repsmith.functions.json import content_hash, json_text, record_id
from repsmith.functions.scalars import bump_millisecond, iso_utc_text
from repsmith.operators.cdc import changed_only, dedupe_last_wins, latest_by_key
from repsmith.operators.incremental import key_replace


def identify(records: DataFrame, record_col: str = "record") -> DataFrame:
    """Add ``record_id`` (C1) and ``record_hash``."""
    return records.withColumn("record_id", record_id(record_col)).withColumn("record_hash", content_hash(record_col))


def snapshot_to_land(records: DataFrame, stored_bronze: DataFrame | None,
                     seq: Sequence[str] = ("page", "pos"), identified: bool = False) -> DataFrame:
    """Static snapshot ingest (C9): dedupe within the pass (last occurrence by ``seq``
    wins), then keep only new or changed records versus the latest stored version. ``identified``:
    the records are those of :func:`identify` already."""
    r = dedupe_last_wins(records if identified else identify(records), "record_id", [F.col(c) for c in seq])
    if stored_bronze is None:
        return r
    return changed_only(r, _versions(stored_bronze), stored_order=[F.col(c) for c in ("ingested_at", "own_time", "record_hash")])


def _versions(stored_bronze: DataFrame) -> DataFrame:
    """Stored versions without their documents, with what orders them (no own time where only ids are stored)."""
    own = own_time() if "record" in stored_bronze.columns else F.lit(None).cast("timestamp")
    return stored_bronze.select("record_id", "record_hash", "ingested_at", own.alias("own_time"))


def backfill_check(records: DataFrame, source_count: DataFrame) -> DataFrame:
    """Full backfill (C10): landed count against the source's own count (1 row; a
    mismatch is reported, not raised)."""
    n = records.agg(F.count(F.lit(1)).cast("long").alias("landed"))
    return n.select("landed", source_count.select(F.col("n").cast("long")).scalar().alias("source_count")) \
        .withColumn("counts_match", F.col("landed") == F.col("source_count"))


def feed_entities(feed_records: DataFrame, seq: Sequence[str] = ("page", "pos")) -> DataFrame:
    """The entities that ``updated`` events wrap, one per event, identified, with their ``own_time``."""
    upd = feed_records.where(json_text("record", "$.type") == F.lit("updated")).select(
        F.get_json_object("record", "$.workout").alias("record"), *seq)
    return identify(upd).withColumn("own_time", own_time())


def latest_entities(entities: DataFrame, seq: Sequence[str] = ("page", "pos")) -> DataFrame:
    """Of :func:`feed_entities` the latest per entity: the latest ``updated_at`` wins, then ``seq``."""
    return dedupe_last_wins(entities, "record_id", [F.col("own_time"), *[F.col(c) for c in seq]]).drop("own_time")


def entities_from_feed(feed_records: DataFrame, seq: Sequence[str] = ("page", "pos")) -> DataFrame:
    """Feed -> entity refresh (C7): ``updated`` events wrap the full entity; unwrap it,
    dedupe (the latest ``updated_at`` per entity wins, then ``seq``), and return entity
    records ready to land."""
    return latest_entities(feed_entities(feed_records, seq), seq)


def feed_high_water(feed_records: DataFrame, default: str = "1970-01-01 00:00:00") -> DataFrame:
    """Resume mark after a feed pass (C8, S10): max of the event's ``workout.updated_at``
    or ``deleted_at`` (instants, nulls skipped) + 1 ms, as instant and ISO-Z text."""
    ts = F.coalesce(json_text("record", "$.workout.updated_at"), json_text("record", "$.deleted_at")).cast("timestamp")
    hw = feed_records.agg(F.coalesce(F.max(ts), F.lit(default).cast("timestamp")).alias("__hw"))
    return hw.select(bump_millisecond("__hw").alias("high_water"), iso_utc_text(bump_millisecond("__hw")).alias("high_water_iso"))


def upsert_state(state: DataFrame, updates: DataFrame, key: str = "dataset") -> DataFrame:
    """Insert-or-update of a small keyed state table (S9): anti join + union."""
    return key_replace(state, updates, key)


def missing_from_snapshot(stored_bronze: DataFrame, snapshot_ids: DataFrame, id_col: str = "record_id") -> DataFrame:
    """Scheduled full reconcile (G16, B18): stored live ids absent from a full source
    snapshot -- deletes the change feed missed."""
    latest = latest_by_key(_versions(stored_bronze), "record_id",
                           [F.col(c) for c in ("ingested_at", "own_time", "record_hash")]).select("record_id", "ingested_at", "record_hash")
    return latest.join(snapshot_ids.select(F.col(id_col).alias("record_id")), "record_id", "left_anti")
