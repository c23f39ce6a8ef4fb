"""Change feed as a Structured Streaming job.

The landed ``workout_events`` log is a file source; the stream's checkpoint replaces
the reference's high-water mark (exact offsets, no +1 ms bump needed). Each
micro-batch is applied with ``foreachBatch``:

1. latest event per workout inside the batch (deterministic tiebreak, T3/B6);
2. ``updated`` events carry the full workout document: flatten it to set rows;
3. the set fact is replaced by key (delete+insert) for every workout the batch touched,
   including deleted ones and ones edited down to zero sets (B3, B4).

A table beside the target keeps the last event applied per workout, deletions included, and a
batch's event is applied only where it is newer, so the result does not depend on how the
files fall into batches (T2-T5).

Of target and state only the buckets that the batch's workouts hash to are read and written.
A ledger of applied batches makes a replay a no-op; a batch that stopped halfway replaces the same
keys with the same rows, so the sink is exactly-once in effect (T6). The target is a
:class:`~repsmith.operators.incremental.KeyedTable`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from repsmith.functions.json import json_text
from repsmith.functions.versions import own_time
from repsmith.operators.cdc import latest_by_key
from repsmith.operators.incremental import BatchLedger, KeyedTable
from repsmith.session import checkpoint_dir, staged
from repsmith.sources.landing import ENVELOPE


def latest_events(batch: DataFrame) -> DataFrame:
    """Latest event per workout in a batch: by landing time, then the event's own clock,
    then content hash."""
    ev = batch.select(
        F.col("_record_id").alias("workout_id"),
        F.col("_ingested_at").cast("timestamp").alias("ingested_at"),
        json_text("record", "$.type").alias("event_type"),
        own_time().alias("event_time"),
        F.col("_record_hash").alias("record_hash"),
        F.get_json_object("record", "$.workout").alias("workout"))
    return latest_by_key(ev, "workout_id", [F.col("ingested_at"), F.col("event_time"), F.col("record_hash")])


def apply_batch(batch: DataFrame, target: KeyedTable, to_rows: Callable[[DataFrame], DataFrame],
                batch_id: int | None = None, stream: str = "default") -> bool:
    """Delete+insert the batch's workouts into ``target``; false where the ledger has the batch already.

    ``to_rows`` maps a frame of (workout_id, workout JSON) to target rows (e.g. the set flattening).
    The state of last events is written after the target, the ledger after both: a replay in between
    applies the same events again. Without ``batch_id`` there is no ledger entry."""
    base = target.path.rstrip("/")
    ledger = BatchLedger(target.spark, base + "__batches", stream)
    if batch_id is not None and ledger.applied(batch_id):
        return False
    state = KeyedTable(target.spark, base + "__last_events", "workout_id", target.n_buckets)
    with staged(latest_events(batch), "events") as events:
        last = events
        if state.exists():
            order = lambda: F.struct("ingested_at", "event_time", "record_hash")
            known = state.read_buckets(state.buckets(events)).select("workout_id", order().alias("__applied"))
            last = events.join(known, "workout_id", "left").where(F.col("__applied").isNull() | (order() > F.col("__applied"))).drop("__applied")
        with staged(last, "news") as news:
            updated = news.where(F.col("event_type") != F.lit("deleted")).select("workout_id", "workout")
            target.replace_keys(to_rows(updated), news.select("workout_id"))
            state.replace_keys(news.drop("workout"))
    if batch_id is not None:
        ledger.add(batch_id)
    return True


def start(spark: SparkSession, events_path: str, checkpoint: str | None, target: KeyedTable,
          to_rows: Callable[[DataFrame], DataFrame], available_now: bool = True) -> StreamingQuery:
    """Run the feed: file source over the landed events, ``foreachBatch`` apply. The stream
    checkpoint defaults to ``<spark.checkpoint.dir>/changefeed`` (a shared folder). Batch numbers
    belong to the checkpoint, so it names the stream in the ledger."""
    if checkpoint is None:
        checkpoint = f"{checkpoint_dir(spark).rstrip('/')}/changefeed"
    stream = (spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1000)
              .option("recursiveFileLookup", True).json(events_path))
    writer = (stream.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, epoch: apply_batch(df, target, to_rows, epoch, hashlib.md5(checkpoint.encode()).hexdigest())))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def dedupe_stream(stream: DataFrame, key: str, event_time: str, delay: str = "1 hour") -> DataFrame:
    """Streaming duplicate removal within a watermark (T7). A row later than ``delay`` behind the newest
    event time is dropped, a first copy too: choose it above the longest lateness of the source."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key, "_record_hash"])
