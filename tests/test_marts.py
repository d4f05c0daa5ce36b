"""Summary marts and profiles, with the reference's group rules."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import marts

ROWS = [
    ("NASA", "USA", "Government", "Success", "Crewed", 1.0, 10),
    ("NASA", "USA", "Government", "Failed", "Uncrewed", 3.0, 20),
    ("NASA", "USA", "Private", "Success", "Uncrewed", None, None),
    ("ESA", "EU", None, "Ongoing", "Uncrewed", None, 5),
    (None, "EU", "Government", "Success", "Crewed", 2.0, 1),
]
SCHEMA = "agency string, country string, type string, status string, crew string, cost double, dur int"


def test_status_summary_keeps_null_groups(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = {r.agency: r for r in marts.status_summary(
        df, ["agency"], "status", {"successes": "Success", "failures": "Failed"}, "Success", "cost",
        extra_counts={"crewed": F.col("crew") == "Crewed"},
    ).collect()}
    assert set(out) == {"NASA", "ESA", None}
    n = out["NASA"]
    assert (n.total_missions, n.successes, n.failures, n.crewed, n.success_rate_pct) == (3, 2, 1, 1, 66.67)
    assert n.avg_cost_usd_billion == 2.0 and n.total_cost_usd_billion == 4.0
    assert out["ESA"].avg_cost_usd_billion is None


def test_group_profile_rules(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    prof = {r.agency: r for r in marts.group_profile(
        df, "agency", "status", {"successful_missions": "Success"}, "Success", "cost", "dur", "type", min_total=0
    ).collect()}
    assert set(prof) == {"NASA", "ESA"}  # NULL group dropped
    assert prof["ESA"].total_cost_billion == 0.0  # all-NULL sum is 0
    assert prof["ESA"].type == "Unknown"  # no mode
    assert prof["NASA"].type == "Government"
    assert prof["NASA"].success_rate == "66.67%"
    assert prof["ESA"].cost_per_success is None
    assert prof["NASA"].cost_per_success == 2.0


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("h", None)], "g string, v string")
    got = {r.g: r.m for r in marts.mode_by_group(df, ["g"], "v", "m", default="Unknown").collect()}
    assert got == {"g": "a", "h": "Unknown"}


def test_rate_profile_denominator_counts_null_status(spark):
    df = spark.createDataFrame([("X", "Success"), ("X", None), ("X", "Failed"), ("X", "Success")], "c string, s string")
    r = marts.rate_profile(df, ["c"], "s", {"success_rate": "Success"}, None).collect()[0]
    assert r.success_rate == 50.0


def test_value_counts_and_share(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "v string")
    assert [(r.v, r["count"]) for r in marts.value_counts(df, "v").collect()] == [("a", 2), ("b", 1)]
    assert {r.v: r.share for r in marts.value_share(df, "v").collect()} == {"a": "66.67%", "b": "33.33%"}
    half = spark.createDataFrame([("a",), ("b",), ("b",), ("b",)], "v string")
    assert {r.v: r.share for r in marts.value_share(half, "v").collect()} == {"a": "25.0%", "b": "75.0%"}
    med = marts.group_median(spark.createDataFrame([("x", 1.0), ("x", 3.0), ("y", None)], "g string, v double"), "g", "v")
    assert [(r.g, r.median) for r in med.collect()] == [("x", 2.0), ("y", None)]
    multi = {(r.column_name, r.value): r["count"] for r in marts.value_counts_multi(df, ["v"]).collect()}
    assert multi == {("v", "a"): 2, ("v", "b"): 1, ("v", None): 1}


def test_pivot_and_contingency(spark):
    df = spark.createDataFrame([("Mars", "1960s"), ("Mars", "1960s"), ("Moon", "1970s"), (None, "1970s")], "c string, d string")
    rows = {r.c: (r["1960s"], r["1970s"]) for r in marts.pivot_counts(df, "c", "d", ["1960s", "1970s"]).collect()}
    assert rows == {"Mars": (2, 0), "Moon": (0, 1)}
    cont = {(r.c, r.d): r.observed for r in marts.contingency(df, "c", "d").collect()}
    assert cont == {("Mars", "1960s"): 2, ("Moon", "1970s"): 1}


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, 3.0, 10.0, None], "t": ["a", "b", "a", None, "c"]})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "x double, t string")
    got = {r.column_name: r for r in marts.describe_all(df).collect()}
    want = pdf.describe(include="all")
    assert got["x"]["count"] == 4 and got["x"].mean == pytest.approx(want["x"]["mean"])
    assert got["x"].std == pytest.approx(want["x"]["std"]) and got["x"].q75 == pytest.approx(want["x"]["75%"])
    assert (got["t"]["count"], got["t"].unique, got["t"].top, got["t"].freq) == (4, 3, "a", 2)
    pct = {r.column_name: r for r in marts.describe_percentiles(df, ["x"]).collect()}["x"]
    assert pct.p90 == pytest.approx(7.9) and pct.p25 == pytest.approx(1.75)


def test_schema_report_and_row_by_key(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    rows = [(r.column_name, r.dtype, r.non_null) for r in marts.schema_report(df).orderBy("position").collect()]
    assert rows == [("a", "int", 2), ("b", "string", 1)]
    assert marts.row_by_key(df, F.col("a") > 0, [F.col("a")]).collect()[0].a == 1


def test_share_kpis(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    r = marts.share_kpis(df, "agency", "NASA", "status", "Success", "cost",
                         {"gov": F.col("type") == "Government"}, min_total=0).collect()[0]
    assert r.key_share_pct == pytest.approx(60.0)
    assert r.key_spend_share_pct == pytest.approx(100.0)
    assert r.gov == pytest.approx(200.0 / 3)


def test_profile_rollup_mean_equals_direct_avg(spark):
    import random
    from decimal import Decimal

    rnd = random.Random(11)
    rows = [(f"g{rnd.randint(0, 6)}", rnd.choice(["a", "b", None]), "Success",
             Decimal(rnd.randint(0, 10 ** 7)) / 100 if rnd.random() > 0.1 else None, rnd.randint(-5, 500))
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, t string, s string, c decimal(12,2), d int")
    prof = {r.g: r for r in marts.group_profile(df, "g", "s", {}, "Success", "c", "d", "t", min_total=0).collect()}
    direct = {r.g: r for r in df.groupBy("g").agg(
        F.round(F.avg("c"), 2).cast("double").alias("ac"), F.round(F.avg("d"), 2).alias("ad"),
        F.sum("c").cast("double").alias("sc")).collect()}
    assert set(prof) == set(direct)
    for g in prof:
        assert prof[g].avg_cost_billion == direct[g].ac
        assert prof[g].avg_duration_days == direct[g].ad
        assert prof[g].total_cost_billion == direct[g].sc


def test_opt_in_variants(spark):
    from tessera.functions import text as X
    from tessera.operators import stats

    df = spark.createDataFrame([(i % 7, "a" if i % 2 else None, f" v{i % 3} ") for i in range(700)], "k int, t string, s string")
    ov = marts.overview(df, ["k"], approx_distinct=True).collect()[0]
    assert ov.distinct_k == 7 and ov.total_rows == 700
    multi = {(r.column_name, r.value) for r in marts.value_counts_multi(df, ["t"], dropna=True).collect()}
    assert multi == {("t", "a")}
    pts = stats.point_feed(df, ["k"], fraction=0.5, seed=1).count()
    assert 250 < pts < 450
    only_s = X.clean_text_columns(df, ["s"]).collect()
    assert {r.s for r in only_s} == {"v0", "v1", "v2"} and {r.t for r in only_s} == {"a", None}
