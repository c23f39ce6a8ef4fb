import datetime as dt

from pyspark.sql import functions as F

from repsmith.functions import scalars as X
from repsmith.functions import json as J


def one(spark, expr, data=None, schema="x double"):
    df = spark.createDataFrame(data or [(None,)], schema)
    return [r[0] for r in df.select(expr.alias("v")).collect()]


def test_round_half_away_binary(spark):
    vals = one(spark, X.round_half_away("x", 2), [(1.005,), (2.675,), (-2.5,), (None,), (0.125,)])
    assert vals == [1.0, 2.68, -2.5, None, 0.13]  # same as the SQL engine's round()
    assert one(spark, X.round_half_away("x", 0), [(-2.5,), (2.5,)]) == [-3.0, 3.0]


def test_e1rm_gate_and_double_literals(spark):
    rows = [(100.0, 12), (100.0, 13), (100.0, 0), (None, 5), (100.0, None), (100.0, 1)]
    got = one(spark, X.e1rm("w", "r"), rows, "w double, r int")
    assert got[0] == 100.0 * (36.0 / (37.0 - 12))
    assert got[1:5] == [None, None, None, None]
    assert got[5] == 100.0


def test_weights_recover_typed_pounds(spark):
    got = one(spark, X.weight_lb("x"), [(90 / 2.20462,), (40.82336184920758,)])
    assert got == [90.0, 90.0]
    assert one(spark, X.weight_kg_canonical("x"), [(40.82336184920758,)]) == [40.823]


def test_local_time_dst_and_parts(spark):
    rows = [(dt.datetime(2024, 3, 10, 7, 30),), (dt.datetime(2023, 11, 5, 6, 30),), (dt.datetime(2024, 3, 2, 0, 30),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz").select(X.to_local("ts").alias("l"))
    loc = [r[0] for r in df.collect()]
    assert loc == [dt.datetime(2024, 3, 10, 3, 30), dt.datetime(2023, 11, 5, 1, 30), dt.datetime(2024, 3, 1, 19, 30)]
    parts = df.select(X.day_name("l"), X.iso_day_of_week("l"), X.is_weekend("l"),
                      X.part_of_day(X.local_hour("l"))).collect()
    assert tuple(parts[0]) == ("Sunday", 7, True, "night")
    assert tuple(parts[2]) == ("Friday", 5, False, "evening")


def test_part_of_day_null_hour(spark):
    assert one(spark, X.part_of_day(F.col("x")), [(None,)], "x int") == ["evening"]
    assert one(spark, X.part_of_day(F.col("x"), match_reference=False), [(None,)], "x int") == [None]


def test_minutes_count_boundaries(spark):
    rows = [(dt.datetime(2024, 1, 1, 10, 0, 59), dt.datetime(2024, 1, 1, 10, 1, 1))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert df.select(X.minutes_between("a", "b")).collect()[0][0] == 1


def test_lenient_casts_and_blank(spark):
    got = one(spark, X.lenient_int("s"), [("5.0",), ("5.7",), ("4.5",), ("abc",), (None,)], "s string")
    assert got == [5, 6, 5, None, None]
    assert one(spark, X.nullif_blank("s"), [("  ",), (" a ",), ("",)], "s string") == [None, "a", None]


def test_positional_key_null_propagates(spark):
    df = spark.createDataFrame([("w", 1, 2), ("w", None, 2)], "a string, b int, c int")
    assert [r[0] for r in df.select(X.positional_key("a", "b", "c")).collect()] == ["w-1-2", None]


def test_record_identity_and_hash(spark):
    rows = [('{"id": "a", "t": 1}',), ('{"t": 1, "id": "a"}',), ('{"type": "updated", "workout": {"id": 7}}',),
            ('{"title": "x"}',), ('{"id": 123}',)]
    df = spark.createDataFrame(rows, "r string").select(J.record_id("r").alias("id"), J.content_hash("r").alias("h"))
    got = df.collect()
    assert [g.id for g in got] == ["a", "a", "7", None, "123"]
    assert got[0].h == got[1].h and got[0].h != got[2].h


def test_near_step_and_rest_bucket(spark):
    assert one(spark, X.near_step("x", 0.25), [(90.0,), (90.1,), (44.09,)]) == [True, False, False]
    assert one(spark, X.rest_bucket("x"), [(0,), (6,), (7,), (30,), (None,)], "x int") == ["0", "6", "7+", "7+", None]
