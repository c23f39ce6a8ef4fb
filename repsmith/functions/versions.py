"""One time order for versions and events, in batch and stream."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from repsmith.functions.json import json_text
from repsmith.functions.scalars import utc_instant


def own_time(record: str = "record") -> Column:
    """When a record says it changed: its (or its wrapped workout's) ``updated_at``, or ``deleted_at``."""
    return F.coalesce(*[utc_instant(json_text(record, p)) for p in ("$.updated_at", "$.workout.updated_at", "$.deleted_at")])


def version_order(record: str = "record") -> list[Column]:
    """Landing time, then the record's own time (all of one run land together), then content hash."""
    return [F.col("ingested_at"), own_time(record), F.col("record_hash")]
