"""Filters (F1-F7) and quality checks (Q1-Q11)."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import filters, quality


def test_founding_filter_and_rejects(spark):
    rows = [(1, "NASA", dt.date(1958, 1, 1)), (2, "NASA", dt.date(1957, 12, 31)), (3, "Other", dt.date(2000, 1, 1)),
            (4, "NASA", None), (5, None, dt.date(2000, 1, 1)), (6, "JAXA", dt.date(2010, 5, 5))]
    df = spark.createDataFrame(rows, "id int, agency string, launch_date date")
    kept, rej = filters.reference_date_filter(df, "agency", "launch_date", {"NASA": 1958, "JAXA": 2003}, with_rejects=True)
    assert sorted(r.id for r in kept.collect()) == [1, 6]
    assert {r.id: r.reject_reason for r in rej.collect()} == {
        2: "before_reference", 3: "unknown_key", 4: "null_date", 5: "unknown_key"
    }
    assert kept.count() + rej.count() == df.count()


def test_order_violations(spark):
    df = spark.createDataFrame([(1, 5, 3), (2, 5, None), (3, 5, 7)], "id int, s int, e int")
    assert [r.id for r in filters.order_violations(df, "s", "e").collect()] == [1]
    assert sorted(r.id for r in filters.order_violations(df, "s", "e", drop=True).collect()) == [2, 3]


def test_simple_filters(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "a", 6000.0), (4, None, 10.0)], "id int, t string, d double")
    assert [r.id for r in filters.where_in(df, "t", ["a"]).orderBy("id").collect()] == [1, 3]
    assert [r.id for r in filters.not_null_below(df, "d", 5000).orderBy("id").collect()] == [1, 4]
    assert [r.id for r in filters.drop_nulls(df).orderBy("id").collect()] == [1, 3]
    assert [r.id for r in filters.where_expr(df, "id > 2").orderBy("id").collect()] == [3, 4]


def test_pk_fk(spark):
    child = spark.createDataFrame([(1, 10), (1, 11), (2, None), (3, 99)], "id int, fk int")
    parent = spark.createDataFrame([(10,), (11,)], "pk int")
    assert [(r.id, r.n_rows) for r in quality.pk_violations(child, ["id"]).collect()] == [(1, 2)]
    assert [r.id for r in quality.fk_violations(child, "fk", parent, "pk").collect()] == [3]


def test_duplicates_like_pandas(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id int, name string")
    r = quality.duplicate_counts(df, ["name", "id"]).collect()[0]
    assert (r.dup_name, r.dup_id) == (2, 0)
    rows = quality.duplicate_rows(df, "name", 10, tie_break=["id"]).collect()
    assert [r.id for r in rows] == [1, 2, 3, 4]


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, 1.0, "y"), (4, 2.0, "z")], "a int, b double, c string")
    rows = [(r.column_name, r.null_count, r.null_pct) for r in quality.null_profile(df).collect()]
    assert rows == [("b", 2, 50.0), ("c", 1, 25.0)]


def test_domain_and_counters(spark):
    df = spark.createDataFrame([("Success",), ("Lost",), (None,), ("Lost",), ("Failed",)], "status string")
    rows = quality.domain_violations(df, {"status": ["Success", "Failed", None]}).collect()
    assert [(r.column_name, r.value, r.n_rows) for r in rows] == [("status", "Lost", 2)]
    c = quality.counters(df, {"missing": F.col("status").isNull(), "ok": F.col("status") == "Success"}).collect()[0]
    assert (c.missing, c.ok) == (1, 1)


def test_constraints(spark):
    df = spark.createDataFrame([(1, 5, "abcdef", 1234.5), (None, 13, "ab", 12.34)], "k int, m int, s string, d double")
    v = {(r.rule, r.column_name): r.n_violations for r in quality.check_violations(df, ["k"], {"m": (1, 12)}).collect()}
    assert v == {("not_null", "k"): 1, ("range", "m"): 1}
    w = {(r.rule, r.column_name): r.n_violations
         for r in quality.length_violations(df, {"s": 5}, {"d": (5, 2)}).collect()}
    assert w == {("max_length", "s"): 1, ("precision", "d"): 1}


def test_health_check(spark):
    full = spark.createDataFrame([(1,)], "x int")
    empty = spark.createDataFrame([], "x int")
    missing = lambda: spark.read.parquet("/nonexistent/tessera/table")
    rows = {r.table_name: (r.n_rows, r.status)
            for r in quality.health_check({"a": full, "b": empty, "c": missing}).collect()}
    assert rows == {"a": (1, "ok"), "b": (0, "empty"), "c": (None, "failed")}


def test_unresolved_keys(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    r = quality.unresolved_keys(df, ["a", "b"]).collect()[0]
    assert (r.unresolved_a, r.unresolved_b) == (1, 2)
