"""The change feed reads and writes only the buckets a batch touches, and a replay writes nothing."""

import json
import os

from pyspark.sql import functions as F

from repsmith.operators.incremental import BatchLedger, KeyedTable
from repsmith.session import checkpoint_dir, staged
from repsmith.sources.landing import ENVELOPE
from repsmith.streaming.changefeed import apply_batch


def event(i, at, kind="updated"):
    doc = {"type": kind, "id": i, "deleted_at": at} if kind == "deleted" else {"type": kind, "workout": {"id": i, "title": at, "updated_at": at}}
    row = {"_record_id": i, "_ingested_at": at, "_record_hash": at, "record": json.dumps(doc)}
    return tuple(row.get(f.name) for f in ENVELOPE.fields) if not isinstance(ENVELOPE, str) else row


def batch(spark, rows):
    return spark.createDataFrame([r if isinstance(r, tuple) else r for r in rows], ENVELOPE)


def to_rows(updated):
    return updated.select("workout_id", F.get_json_object("workout", "$.title").alias("title"))


def stamps(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if not f.startswith(".")}


def bucket_files(path):
    return {k: v for k, v in stamps(path).items() if "__bucket=" in k}


def touched(before, after):
    changed = {k for k in before.keys() | after.keys() if before.get(k) != after.get(k)}
    return {k.split("__bucket=")[1].split("/")[0] for k in changed}


def test_only_touched_buckets_and_no_op_replay(spark, scratch):
    target = KeyedTable(spark, f"{scratch}/fct", "workout_id", n_buckets=16)
    first = batch(spark, [event(f"w{i}", "2024-01-01T00:00:00Z") for i in range(60)])
    assert apply_batch(first, target, to_rows, 0)
    state = f"{scratch}/fct__last_events"
    before, known = bucket_files(target.path), bucket_files(state)
    second = batch(spark, [event("w1", "2024-02-01T00:00:00Z"), event("w2", "2024-02-01T00:00:00Z", "deleted"), event("w3", "2023-01-01T00:00:00Z")])
    assert apply_batch(second, target, to_rows, 1)
    own = set(map(str, target.buckets(spark.createDataFrame([("w1",), ("w2",)], "workout_id string"))))
    assert touched(before, bucket_files(target.path)) == own and touched(known, bucket_files(state)) == own
    got = {r.workout_id: r.title for r in target.read().collect()}
    assert len(got) == 59 and got["w1"] == "2024-02-01T00:00:00Z" and got["w3"] == "2024-01-01T00:00:00Z" and "w2" not in got
    before = stamps(scratch)
    assert not apply_batch(second, target, to_rows, 1)
    assert stamps(scratch) == before
    # Other streams count their batches on their own.
    assert apply_batch(second, target, to_rows, 1, "other")
    assert {r.workout_id: r.title for r in target.read().collect()} == got


def test_a_scan_of_buckets_lists_their_files_alone(spark, scratch):
    t = KeyedTable(spark, f"{scratch}/t", "k", n_buckets=8)
    t.overwrite(spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")))
    some = t.buckets(spark.createDataFrame([(3,), (4,)], "k long"))
    df = t.read_buckets(some)
    plan = df._jdf.queryExecution().executedPlan()
    assert "__bucket" in plan.toString().split("PartitionFilters: [")[1].split("]")[0]
    df.collect()
    while plan.children().size():
        plan = plan.children().apply(0)
    read = plan.metrics().apply("numPartitions").value()
    assert 0 < len(some) <= 2 and read == len(some)
    assert {3, 4} <= {r.k for r in df.collect()} and t.read_buckets([]).count() == 0


def test_an_increment_without_keys_writes_nothing(spark, scratch):
    t = KeyedTable(spark, f"{scratch}/t", "k", n_buckets=4)
    t.overwrite(spark.range(20).select(F.col("id").alias("k")))
    before = stamps(scratch)
    t.replace_keys(spark.range(0).select(F.col("id").alias("k")))
    assert stamps(scratch) == before


def test_staged_files_go(spark):
    base = checkpoint_dir(spark)
    with staged(spark.range(5), "probe") as df:
        assert df.count() == 5 and any(n.startswith("staged-probe-") for n in os.listdir(base))
    assert not any(n.startswith("staged-") for n in os.listdir(base))


def test_ledger_forgets_old_batches(spark, scratch):
    ledger = BatchLedger(spark, f"{scratch}/l", "s", keep=2)
    for i in range(4):
        assert not ledger.applied(i)
        ledger.add(i)
    assert [ledger.applied(i) for i in range(4)] == [False, False, True, True]
