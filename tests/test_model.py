"""Dimensions, lookups, bridges and star joins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import model


def test_date_dimension(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2021, 1, 3, 10), dt.date(2021, 1, 5)), (dt.datetime(2021, 1, 3, 23), None),
         (None, dt.date(1957, 10, 4))],
        "a timestamp, b date",
    )
    dim = model.date_dimension(df, ["a", "b"]).orderBy("date_id").collect()
    assert [r.full_date for r in dim] == [dt.date(1957, 10, 4), dt.date(2021, 1, 3), dt.date(2021, 1, 5)]
    assert [r.date_id for r in dim] == [1, 2, 3]
    assert dim[1].week == 53 and dim[0].decade == "1950s"


def test_lookup_null_safe_and_miss(spark):
    dim = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, "v", "s")], "launch_id int, veh string, site string")
    fact = spark.createDataFrame([(10, None, "x"), (11, None, None), (12, "v", "s"), (13, "q", "q")], "m int, veh string, site string")
    out = model.lookup_key(fact, dim, ["veh", "site"], ["veh", "site"], "launch_id", null_safe=True)
    got = {r.m: r.launch_id for r in out.collect()}
    assert got == {10: 1, 11: 2, 12: 3, 13: None}


def test_lookup_duplicate_key_raises(spark):
    dim = spark.createDataFrame([(1, "NASA", "USA"), (2, "NASA", "US")], "agency_id int, agency_name string, c string")
    fact = spark.createDataFrame([("NASA",)], "agency string")
    with pytest.raises(model.DuplicateKeyError):
        model.lookup_key(fact, dim, ["agency"], ["agency_name"], "agency_id")


def test_distinct_dimension_ids(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("a", None), (None, "z"), ("b", "x")], "n string, s string")
    dim = model.distinct_dimension(df, ["n", "s"], "id", required=["n"]).orderBy("id").collect()
    assert [(r.id, r.n, r.s) for r in dim] == [(1, "a", None), (2, "b", "x")]


def test_bridge(spark):
    df = spark.createDataFrame([("M2", "A,  B,,C"), ("M1", "A, A"), ("M3", None), ("M4", " , ")], "mission_id string, crew string")
    rows = model.bridge(df, "mission_id", "crew", "crew_member").orderBy("id").collect()
    assert [(r.id, r.mission_id, r.crew_member) for r in rows] == [
        (1, "M1", "A"), (2, "M1", "A"), (3, "M2", "A"), (4, "M2", "B"), (5, "M2", "C")
    ]


def test_star_join_role_playing(spark):
    dd = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, dt.date(2020, 1, 2))], "date_id int, full_date date")
    fact = spark.createDataFrame([("m1", 1, 2), ("m2", 2, None)], "mission_id string, l int, e int")
    out = model.star_join(
        fact, ["mission_id"],
        [model.DimJoin(dd, "l", "date_id", {"launch_date": "full_date"}),
         model.DimJoin(dd, "e", "date_id", {"end_date": "full_date"})],
        order_by=[F.col("launch_date").asc_nulls_last()],
    ).collect()
    assert [(r.mission_id, r.launch_date, r.end_date) for r in out] == [
        ("m1", dt.date(2020, 1, 1), dt.date(2020, 1, 2)), ("m2", dt.date(2020, 1, 2), None)
    ]


def test_set_ops(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "x int")
    b = spark.createDataFrame([(2,), (3,)], "x int")
    assert sorted(r.x for r in model.union_distinct([a, b]).collect()) == [1, 2, 3]
    assert [r.x for r in model.set_difference(a, b).collect()] == [1]
