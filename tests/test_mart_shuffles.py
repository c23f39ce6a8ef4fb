"""Bytes that the wide tables and the session fact shuffle per set, with no dimension small enough to broadcast."""

import pytest

import __spark_entry__ as E
from plan_rows import shuffled_bytes

SF = "/root/testdata/sf0.01"
NO_BROADCAST = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name, limit", [("obt_wide", 260), ("obt_wide_by_athlete", 260), ("exercise_session_fact_by_athlete", 170)])
def test_bytes_shuffled_per_set(spark, name, limit):
    for c in NO_BROADCAST:
        spark.conf.set(c, "-1")
    try:
        n = shuffled_bytes(E.queries()[name](spark, SF))
    finally:
        for c in NO_BROADCAST:
            spark.conf.unset(c)
    assert n / spark.read.parquet(f"{SF}/lineitem.parquet").count() < limit
