"""Versions and events of one run, across batches; empty first loads; keys and ranges at the edges."""

import json
import datetime as dt

import pytest
from pyspark.sql import functions as F

from repsmith.functions.scalars import round_half_away
from repsmith.operators.analysis import flag_periods
from repsmith.operators.cdc import snapshot_scd2, snapshot_scd2_direct
from repsmith.operators.incremental import KeyedTable
from repsmith.operators.joins import range_join
from repsmith.plans.staging import latest
from repsmith.streaming.changefeed import apply_batch

RUN = dt.datetime(2024, 1, 5)


def test_later_version_of_one_run_wins(spark):
    rows = [(f"w{i}", RUN, f"{h:04d}", json.dumps({"id": f"w{i}", "v": v, "updated_at": f"2024-01-01T0{v}:00:00Z"}))
            for i in range(8) for v, h in ((1, (i * 7919 + 5) % 9973), (2, (i * 104729 + 3) % 9973))]
    got = latest(spark.createDataFrame(rows, "record_id string, ingested_at timestamp, record_hash string, record string")).collect()
    assert [json.loads(r.record)["v"] for r in got] == [2] * 8


def event(i, kind, hour):
    body = {"type": kind, "deleted_at": f"2024-01-01T{hour:02d}:00:00Z"} if kind == "deleted" else \
        {"type": kind, "workout": {"id": f"w{i}", "updated_at": f"2024-01-01T{hour:02d}:00:00Z", "h": hour}}
    return (f"w{i}", RUN, f"{(i * 31 + hour * 17) % 97:03d}", json.dumps(body))


ENVELOPE = "_record_id string, _ingested_at timestamp, _record_hash string, record string"
def TO_ROWS(df):
    return df.select("workout_id", F.get_json_object("workout", "$.h").alias("h"))


@pytest.mark.parametrize("cut", [0, 3, 5])
def test_feed_result_does_not_depend_on_batches(spark, scratch, cut):
    events = [event(1, "updated", 5), event(2, "deleted", 6), event(3, "updated", 2), event(1, "updated", 3), event(2, "updated", 4), event(3, "deleted", 1)]
    target = KeyedTable(spark, f"{scratch}/t{cut}", "workout_id", 4)
    for part in (events[:cut], events[cut:]):
        if part:
            apply_batch(spark.createDataFrame(part, ENVELOPE), target, TO_ROWS)
            apply_batch(spark.createDataFrame(part, ENVELOPE), target, TO_ROWS)  # a replay changes nothing
    assert sorted((r.workout_id, r.h) for r in target.read().collect()) == [("w1", "5"), ("w3", "2")]


def test_delete_only_first_load(spark, scratch):
    target = KeyedTable(spark, f"{scratch}/d", "workout_id", 4)
    apply_batch(spark.createDataFrame([event(1, "deleted", 5)], ENVELOPE), target, TO_ROWS)
    assert target.read().count() == 0 and target.read().columns == ["workout_id", "h"]


def test_scd2_with_a_null_key(spark):
    rows = [(None, dt.date(2024, 1, d), "a") for d in (1, 3)] + [("k", dt.date(2024, 1, d), v) for d, v in ((1, "a"), (2, "a"), (4, "b"))]
    df = spark.createDataFrame(rows, "key string, day date, v string")
    two, direct = snapshot_scd2(df, "key", "day", ["v"]), snapshot_scd2_direct(df, "key", "day", ["v"])
    assert sorted(map(str, two.select(*direct.columns).collect())) == sorted(map(str, direct.collect()))
    assert two.where("key is null and is_current").count() == 1


def test_range_join_rejects_outer_ranges_on_both_paths(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),)], "d date")
    ranges = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 2))], "s date, e date")
    for limit in (0, 10):
        with pytest.raises(ValueError):
            range_join(df, ranges, "d", "s", "e", "right", max_broadcast_rows=limit)
        assert range_join(df, ranges, "d", "s", "e", "inner", max_broadcast_rows=limit).count() == 1


def test_rounding_of_large_values(spark):
    df = spark.createDataFrame([(1e17,), (-1e17,), (2e10,), (1.005,), (None,)], "x double")
    assert [r[0] for r in df.select(round_half_away("x", 2)).collect()] == [1e17, -1e17, 2e10, 1.0, None]
    assert df.where("x = 2e10").select(round_half_away("x", 9)).first()[0] == 2e10


def test_any_number_of_periods(spark):
    day = dt.date(2000, 1, 1)
    periods = [(day + dt.timedelta(i), day + dt.timedelta(i + 1)) for i in range(0, 24000, 2)] + [(dt.date(1, 1, 1), dt.date(1990, 1, 1))]
    df = spark.createDataFrame([(1, day), (2, day + dt.timedelta(23999)), (3, day - dt.timedelta(1)), (4, None), (2, day + dt.timedelta(23999))], "i int, d date")
    got = flag_periods(df, "d", spark.createDataFrame(periods, "start_date date, end_date date"))
    assert sorted((r.i, r.is_disrupted) for r in got.collect()) == [(1, True), (2, True), (2, True), (3, False), (4, False)]
