"""Latest state per key as a stateful Structured Streaming aggregation.

``groupBy(key).agg(max(struct(order..., payload...)))`` keeps one row per key in the
checkpointed state store; in ``update`` mode each micro-batch emits only the keys it
changed, and ``foreachBatch`` replaces exactly those keys in a
:class:`~repsmith.operators.incremental.KeyedTable`. Nothing goes through the driver,
and a restart resumes from the checkpoint (offsets + state).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from repsmith.operators.incremental import KeyedTable
from repsmith.session import checkpoint_dir


def latest_state_stream(stream: DataFrame, key: str, order_by: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Streaming frame of (key, best) where ``best`` is the newest row's struct."""
    return stream.groupBy(key).agg(F.max(F.struct(*[F.col(c) for c in [*order_by, *payload]])).alias("__best"))


def run_latest_state(spark: SparkSession, source_dir: str, file_glob: str, schema: StructType, key: str,
                     order_by: Sequence[str], payload: Sequence[str], target: KeyedTable,
                     checkpoint: str, max_files_per_trigger: int = 1000) -> None:
    """Drain the file source once (``availableNow``) into ``target``."""
    src = (spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
           .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir))
    cols = [*order_by, *payload]

    def apply(batch: DataFrame, _epoch: int) -> None:
        rows = batch.select(key, *[F.col(f"__best.{c}").alias(c) for c in cols])
        target.replace_keys(rows)

    q = (latest_state_stream(src, key, order_by, payload).writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint).foreachBatch(apply).trigger(availableNow=True).start())
    q.awaitTermination()


def latest_state_table(spark: SparkSession, sf_dir: str, table: str, key: str, order_by: Sequence[str],
                       payload: Sequence[str], n_buckets: int = 16) -> DataFrame:
    """Run the stream over ``sf_dir/<table>.parquet`` into a fresh keyed table under the
    session's shared checkpoint folder and return that table."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/latest_state/{table}-{uuid.uuid4().hex}"
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet").schema
    target = KeyedTable(spark, f"{base}/table", key, n_buckets=n_buckets)
    run_latest_state(spark, sf_dir, f"{table}.parquet", schema, key, order_by, payload, target, f"{base}/checkpoint")
    return target.read().select(key, *order_by, *payload)
