"""One ingest run over all datasets.

A run picks the mode itself: small datasets are pulled whole and landed where changed; the workouts
are pulled whole when asked to or when no mark is stored, and by the change feed since the mark
otherwise. Every dataset is landed before the mark moves, so a run that stops in between is simply
run again: what it landed already is landed once more and collapses to the same latest versions.

The fetch is a ``Source``; it gives raw records as DataFrames, so nothing passes through the driver
but the counts of the summary and the mark.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repsmith.functions.json import json_text
from repsmith.functions.scalars import bump_millisecond, iso_utc_text, utc_instant
from repsmith.operators.cdc import dedupe_last_wins
from repsmith.operators.incremental import KeyedTable
from repsmith.plans import ingest
from repsmith.session import staged
from repsmith.sources import landing

STATIC = ("exercise_templates", "routines", "routine_folders")
SEQ, STAMP = ("page", "pos"), "__stamp"
SUMMARY = "run_id string, dataset string, mode string, n_records long, expected long, counts_match boolean, high_water string, elapsed_s double"


class Source(NamedTuple):
    """``fetch(dataset, since)``: raw records (record, page, pos), of the change feed those after the
    instant ``since`` (ISO text); ``count()``: the source's own number of workouts (n)."""

    fetch: Callable[[str, str | None], DataFrame]
    count: Callable[[], DataFrame] | None = None


def read_pages(pages: DataFrame, lists: Sequence[str] = (), page: str = "page", size: str = "n_records", total: str = "page_count") -> DataFrame:
    """The pages that paging reaches, per list of ``lists``: from page 1 on, up to the first that has no
    record, that the number of pages reported with it makes the last (none reported: one), or that has no
    successor. One aggregate and a join on the page number per list; page rows only, never records."""
    keys = list(lists)
    k = [F.col(c) for c in keys]
    after = pages.select(*[c.alias(f"__k{i}") for i, c in enumerate(k)], (F.col(page) - 1).alias("__before")).distinct()
    same = pages[page] == after["__before"]
    for i, c in enumerate(keys):
        same = same & pages[c].eqNullSafe(after[f"__k{i}"])
    marked = pages.join(after, same, "left")
    last = (F.col(size) == 0) | (F.coalesce(F.col(total), F.lit(1)) <= F.col(page)) | F.col("__before").isNull()
    stop = marked.groupBy(*keys).agg(F.min(F.when(last, F.col(page))).alias("__stop"), F.min(page).alias("__first")).where("__first = 1")
    renamed = stop.select(*[F.col(c).alias(f"__s{i}") for i, c in enumerate(keys)], "__stop")
    near = pages[page] <= renamed["__stop"]
    for i, c in enumerate(keys):
        near = near & pages[c].eqNullSafe(renamed[f"__s{i}"])
    return pages.join(renamed, near, "left_semi")


def _mark(records: DataFrame, stamps: Column) -> str | None:
    """The latest stamp plus a millisecond as ISO text; null without one. One value per run."""
    return records.agg(iso_utc_text(bump_millisecond(F.max(utc_instant(stamps)))).alias("m")).first()["m"]


def high_water(state: KeyedTable, dataset: str = "workouts") -> str | None:
    if not state.exists():
        return None
    row = state.read().where(F.col("dataset") == dataset).select("high_water").first()
    return row["high_water"] if row else None


def run(spark: SparkSession, source: Source, base: str, run_id: str, at: Column | None = None, full_refresh: bool = False,
        datasets: Sequence[str] = ("workouts", *STATIC)) -> DataFrame:
    """Ingest ``datasets`` into ``base`` and return the run's summary: dataset, mode (snapshot, full or
    incremental), records that arrived, for a full pull the source's own count and whether it agrees (a
    difference is reported, not raised), the mark stored, and seconds taken."""
    state = KeyedTable(spark, f"{base.rstrip('/')}/_state", "dataset", n_buckets=1)
    stored = lambda d: landing.bronze(landing.read_landed(spark, base, d))
    rows = []

    def land(records: DataFrame, dataset: str) -> None:
        landing.land(records, base, dataset, run_id, at, identified=True)

    def done(dataset: str, mode: str, n: int, t0: float, expected: int | None = None, mark: str | None = None) -> None:
        rows.append((run_id, dataset, mode, n, expected, None if expected is None else expected == n, mark, time.perf_counter() - t0))

    for dataset in [d for d in STATIC if d in datasets]:
        t0 = time.perf_counter()
        with staged(ingest.identify(source.fetch(dataset, None)), "fetched") as fetched:
            with staged(ingest.snapshot_to_land(fetched, stored(dataset), identified=True), "fresh") as fresh:
                n = fresh.count()
                if n:
                    land(fresh, dataset)
        done(dataset, "snapshot", n, t0)
    if "workouts" in datasets:
        t0 = time.perf_counter()
        since = high_water(state)
        mode = "full" if full_refresh or since is None else "incremental"
        # Documents are read once each, where they arrive: what is asked of them is staged beside them.
        stamp = ("$.updated_at", "$.start_time") if mode == "full" else ("$.workout.updated_at", "$.deleted_at")
        arrived = source.fetch("workouts" if mode == "full" else "workout_events", since if mode == "incremental" else None)
        arrived = ingest.identify(arrived).withColumn(STAMP, F.coalesce(*[json_text("record", p) for p in stamp]))
        with staged(arrived, "fetched") as fetched:
            if mode == "full":
                whole = dedupe_last_wins(fetched.drop(STAMP), "record_id", [F.col(c) for c in SEQ])
                with staged(whole, "whole") as records:
                    n = records.count()
                    land(records, "workouts")
                expected = source.count().first()["n"] if source.count else None
                mark = _mark(fetched, F.col(STAMP)) or "1970-01-01T00:00:00.001000Z"
            else:
                n, expected = fetched.count(), None
                mark = since
                if n:
                    land(fetched, "workout_events")
                    with staged(ingest.feed_entities(fetched, SEQ), "entities") as entities:
                        land(ingest.latest_entities(entities, SEQ), "workouts")
                    mark = _mark(fetched, F.col(STAMP)) or since
            if mark != since:
                state.replace_keys(spark.createDataFrame([("workouts", mark, run_id)], "dataset string, high_water string, run_id string"))
        done("workouts" if mode == "full" else "workout_events", mode, n, t0, expected, mark)
    return spark.createDataFrame(rows, SUMMARY)
