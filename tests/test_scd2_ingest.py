import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from repsmith.operators.cdc import snapshot_scd2
from repsmith.operators.incremental import KeyedTable
from repsmith.operators.scd2 import Scd2Table
from repsmith.plans import ingest_run
from repsmith.sources import landing as L

SCHEMA = "k string, t timestamp, v string, w int"
DAY0 = dt.datetime(2024, 1, 1)


def snapshots(seed, days=5, keys=40):
    rnd = random.Random(seed)
    now, out = {}, []
    for d in range(days):
        for k in range(keys):
            if k not in now or rnd.random() < 0.15:
                now[k] = (rnd.choice("abc"), rnd.choice([None, 1]))
        out.append([(f"k{k}" if k else None, DAY0 + dt.timedelta(days=d), *now[k]) for k in range(keys) if rnd.random() < 0.9])
    return out


def canon(df):
    return sorted((str(r.k), r.t, r.v, str(r.w), str(r.valid_to), r.is_current) for r in df.collect())


def rebuilt(spark, parts):
    return canon(snapshot_scd2(spark.createDataFrame([r for p in parts for r in p], SCHEMA), "k", "t", ["v", "w"]))


def stamps(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if "__bucket=" in d}


def test_day_by_day_equals_the_rebuild(spark, scratch):
    days = snapshots(1)
    table = Scd2Table(spark, f"{scratch}/s", "k", "t", ["v", "w"], n_buckets=4)
    order, merged = [0, 1, 3, 2, 4], []
    for i in order:
        merged.append(days[i])
        assert table.merge(spark.createDataFrame(days[i], SCHEMA), i) == ("rebuilt" if i == 2 else "appended")
        assert canon(table.read()) == rebuilt(spark, merged), i
    before = stamps(scratch)
    assert table.merge(spark.createDataFrame(days[3], SCHEMA), 3) == "known" and stamps(scratch) == before


def test_unchanged_keys_cost_no_write(spark, scratch):
    table = Scd2Table(spark, f"{scratch}/s", "k", "t", ["v", "w"], n_buckets=8)
    rows = [(f"k{i}", DAY0, "a", 1) for i in range(30)]
    table.merge(spark.createDataFrame(rows, SCHEMA), 0)
    before = stamps(table.open.path) | stamps(table.closed.path)
    table.merge(spark.createDataFrame([(k, DAY0 + dt.timedelta(1), "b" if k == "k7" else v, w) for k, _, v, w in rows], SCHEMA), 1)
    after = stamps(table.open.path) | stamps(table.closed.path)
    bucket = str(table.open.buckets(spark.createDataFrame([("k7",)], "k string"))[0])
    changed = {p.split("__bucket=")[1].split("/")[0] for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
    assert changed == {bucket}


def test_a_merge_that_stopped_halfway(spark, scratch, monkeypatch):
    days = snapshots(2, days=3, keys=12)
    table = Scd2Table(spark, f"{scratch}/s", "k", "t", ["v", "w"], n_buckets=2)
    table.merge(spark.createDataFrame(days[0], SCHEMA), 0)
    real = KeyedTable.replace_keys

    def broken(self, *a):
        raise RuntimeError("lost")

    monkeypatch.setattr(KeyedTable, "replace_keys", broken)  # closed versions are written, open ones not
    with pytest.raises(RuntimeError):
        table.merge(spark.createDataFrame(days[1], SCHEMA), 1)
    monkeypatch.setattr(KeyedTable, "replace_keys", real)
    assert table.merge(spark.createDataFrame(days[1], SCHEMA), 1) == "rebuilt"
    assert table.merge(spark.createDataFrame(days[2], SCHEMA), 2) == "appended"
    assert canon(table.read()) == rebuilt(spark, days)


def instant(text):
    return dt.datetime.fromisoformat(text.replace("Z", "+00:00"))


def source(spark, workouts, feed, statics=(), count=None):
    def frame(records):
        return spark.createDataFrame([(json.dumps(r), 1, i) for i, r in enumerate(records)], "record string, page int, pos int")
    asked = []

    def fetch(dataset, since):
        asked.append((dataset, since))
        return frame({"workouts": workouts, "workout_events": [e for e in feed if since is None or instant(e.get("deleted_at") or e["workout"]["updated_at"]) >= instant(since)]}.get(dataset, statics))
    return ingest_run.Source(fetch, (lambda: spark.range(1).select(F.lit(count).cast("long").alias("n"))) if count is not None else None), asked


def summary(df):
    assert all(r.elapsed_s >= 0 for r in df.collect())
    return [tuple(r) for r in df.drop("elapsed_s").collect()]


def test_the_mode_follows_the_mark(spark, scratch):
    full = [{"id": "w1", "updated_at": "2024-01-01T00:00:00Z"}, {"id": "w1", "updated_at": "2024-01-02T00:00:00Z"}, {"id": "w2", "start_time": "2024-01-03T10:00:00+02:00"}]
    src, asked = source(spark, full, [], count=3)
    assert summary(ingest_run.run(spark, src, scratch, "r1", datasets=["workouts"])) == [("r1", "workouts", "full", 2, 3, False, "2024-01-03T08:00:00.001000Z")]
    assert asked == [("workouts", None)]
    feed = [{"type": "updated", "workout": {"id": "w1", "updated_at": "2024-02-01T00:00:00Z"}}, {"type": "deleted", "id": "w2", "deleted_at": "2024-02-03T00:00:00Z"},
            {"type": "updated", "workout": {"id": "w0", "updated_at": "2023-01-01T00:00:00Z"}}]
    src, asked = source(spark, [], feed)
    assert summary(ingest_run.run(spark, src, scratch, "r2", datasets=["workouts"])) == [("r2", "workout_events", "incremental", 2, None, None, "2024-02-03T00:00:00.001000Z")]
    assert asked == [("workout_events", "2024-01-03T08:00:00.001000Z")]
    assert sorted(r.record_id for r in L.bronze(L.read_landed(spark, scratch, "workouts")).where("run_id = 'r2'").collect()) == ["w1"]
    src, _ = source(spark, [], feed)
    assert summary(ingest_run.run(spark, src, scratch, "r3", datasets=["workouts"])) == [("r3", "workout_events", "incremental", 0, None, None, "2024-02-03T00:00:00.001000Z")]
    assert L.read_landed(spark, scratch, "workout_events").count() == 2
    src, asked = source(spark, full, feed, count=2)
    assert summary(ingest_run.run(spark, src, scratch, "r4", datasets=["workouts"], full_refresh=True))[0][2:6] == ("full", 2, 2, True) and asked == [("workouts", None)]


def test_static_datasets_land_changes_and_an_empty_account(spark, scratch):
    src, _ = source(spark, [], [], statics=[{"id": "t1", "x": 1}, {"id": "t2", "x": 1}], count=0)
    out = summary(ingest_run.run(spark, src, scratch, "r1", datasets=["routines", "workouts"]))
    assert [r[1:6] for r in out] == [("routines", "snapshot", 2, None, None), ("workouts", "full", 0, 0, True)] and out[1][6] == "1970-01-01T00:00:00.001000Z"
    src, _ = source(spark, [], [], statics=[{"id": "t1", "x": 1}, {"id": "t2", "x": 2}])
    assert summary(ingest_run.run(spark, src, scratch, "r2", datasets=["routines"]))[0][3] == 1


def test_a_run_that_stops_before_the_mark(spark, scratch, monkeypatch):
    src, _ = source(spark, [{"id": "w1", "updated_at": "2024-01-01T00:00:00Z"}], [], count=1)
    real = KeyedTable.replace_keys
    monkeypatch.setattr(KeyedTable, "replace_keys", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        ingest_run.run(spark, src, scratch, "r1", datasets=["workouts"])
    monkeypatch.setattr(KeyedTable, "replace_keys", real)
    assert summary(ingest_run.run(spark, src, scratch, "r2", datasets=["workouts"]))[0][2] == "full"  # no mark, so whole again


def test_paging_stops(spark):
    rows = [("a", 1, 5, 3), ("a", 2, 5, 3), ("a", 3, 5, 3), ("a", 4, 5, 3),      # the third says it is the last
            ("b", 1, 5, 9), ("b", 2, 0, 9), ("b", 3, 5, 9),                      # an empty page ends it
            ("c", 1, 5, None), ("c", 2, 5, None),                                # none reported: one page
            ("d", 1, 5, 9), ("d", 3, 5, 9),                                      # nothing after a gap
            ("e", 2, 5, 9), (None, 1, 2, 2), (None, 2, 2, 2)]
    pages = spark.createDataFrame(rows, "list string, page long, n_records long, page_count long")
    got = sorted((str(r.list), r.page) for r in ingest_run.read_pages(pages, ["list"]).collect())
    assert got == [("None", 1), ("None", 2), ("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2), ("c", 1), ("d", 1)]
    assert [r.page for r in ingest_run.read_pages(pages.where("list = 'b'").drop("list")).orderBy("page").collect()] == [1, 2]


def test_documents_are_hashed_once_each(spark, scratch, monkeypatch):
    """The identity of a document is a column of the staged records: nothing behind the fetch makes it again."""
    calls = []
    real_hash = ingest_run.ingest.content_hash
    for module in (ingest_run.ingest, L):
        monkeypatch.setattr(module, "content_hash", lambda r, real=real_hash: calls.append(r) or real(r))
    feed = [{"type": "updated", "workout": {"id": "w1", "updated_at": f"2024-02-0{i}T00:00:00Z"}} for i in (2, 3, 1)]
    src, _ = source(spark, [{"id": "w1", "updated_at": "2024-01-01T00:00:00Z"}, {"id": "w1", "updated_at": "2023-01-01T00:00:00Z"}], feed, statics=[{"id": "t1"}], count=1)
    assert [r[2:4] for r in summary(ingest_run.run(spark, src, scratch, "r1", datasets=["routines", "workouts"]))] == [("snapshot", 1), ("full", 1)]
    assert len(calls) == 2  # one per fetch
    assert [r[2:4] for r in summary(ingest_run.run(spark, src, scratch, "r2", datasets=["routines", "workouts"]))] == [("snapshot", 0), ("incremental", 3)]
    assert len(calls) == 5  # one per fetch, and one of the entities that the feed wraps
    landed = L.read_landed(spark, scratch, "workouts").where("_run_id = 'r2'").collect()
    assert [json.loads(r.record)["updated_at"] for r in landed] == ["2024-02-03T00:00:00Z"]
    plain = L.envelope(spark.createDataFrame([(landed[0].record,)], "record string"), "workouts", "r2").first()
    assert (landed[0]._record_id, landed[0]._record_hash) == (plain._record_id, plain._record_hash)
