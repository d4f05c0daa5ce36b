"""NaN is missing, failures are reported, and a failed refresh keeps the old tables."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import marts, quality, stats
from tessera.functions.pvalues import chi2_upper_p
from tessera.sources import sink

ROWS = [("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", float("nan")), ("b", 4.0), ("b", 6.0), ("b", None), ("b", float("nan"))]


@pytest.fixture()
def frames(spark):
    df = spark.createDataFrame(ROWS, "g string, v double")
    return df, df.filter(~F.isnan("v"))


@pytest.mark.parametrize("run", [
    lambda d: stats.welch_t(d, "g", "v", "a", "b"),
    lambda d: stats.box_stats(d, "g", "v"),
    lambda d: stats.kde(d, "g", "v", gridsize=5),
    lambda d: stats.histogram(d, "v", bins=4),
    lambda d: stats.histogram(d, "v", bins=4, group_col="g"),
    lambda d: marts.group_median(d, "g", "v"),
    lambda d: marts.describe_percentiles(d, ["v"]),
])
def test_nan_counts_as_missing(frames, run):
    with_nan, without = frames
    assert sorted(map(str, run(with_nan).collect())) == sorted(map(str, run(without).collect()))


def test_nan_is_in_the_null_profile(frames):
    assert [tuple(r) for r in quality.null_profile(frames[0]).collect()] == [("v", 3, 37.5)]


def test_no_degrees_of_freedom(spark):
    assert spark.range(1).select(chi2_upper_p(F.lit(0.0), F.lit(0)).alias("p")).first().p == 1.0


def test_health_check_reports_a_table_that_fails_while_read(spark):
    broken = spark.range(3).select(F.raise_error(F.lit("gone")).alias("x")).filter("x is null")
    got = {r.table_name: r.status for r in quality.health_check({"good": spark.range(2), "none": spark.range(0), "bad": broken}).collect()}
    assert got == {"good": "ok", "none": "empty", "bad": "failed"}


def test_failed_refresh_keeps_old_tables(spark, scratch):
    sink.refresh_tables({"x": spark.range(2), "y": spark.range(3)}, scratch, order=["x", "y"])
    with pytest.raises(Exception, match="gone"):  # the second table's write dies
        sink.refresh_tables({"x": spark.range(20), "y": spark.range(30).filter(F.raise_error(F.lit("gone")).isNull())}, scratch, order=["x", "y"])
    assert {n: d.count() for n, d in sink.read_tables(spark, scratch, ["x", "y"]).items()} == {"x": 2, "y": 3}


def test_refresh_switches_all_tables_at_once(spark, scratch, monkeypatch):
    """Whatever is killed before the commit, readers see one whole version."""
    names = ["x", "y", "z"]
    make = lambda n: {t: spark.range(n) for t in names}
    with pytest.raises(FileNotFoundError):
        sink.read_tables(spark, scratch, names)
    sink.refresh_tables(make(2), scratch, order=names)
    old = sink.table_paths(spark, scratch, names)

    class Killed(BaseException):
        pass

    for lost in range(4):  # killed behind each table's write, and before the commit
        fs, jvm = sink._fs(spark, scratch)

        class Dying:
            def __getattr__(self, name):
                if name in ("delete", "create"):  # a killed run cleans nothing up
                    raise Killed()
                return getattr(fs, name)

        tables = make(5)
        if lost < 3:
            tables[names[lost]] = tables[names[lost]].filter(F.raise_error(F.lit("killed")).isNull())
        monkeypatch.setattr(sink, "_fs", lambda *_: (Dying(), jvm))
        with pytest.raises(Killed):
            sink.refresh_tables(tables, scratch, order=names)
        monkeypatch.undo()
        assert sink.table_paths(spark, scratch, names) == old
        assert {n: d.count() for n, d in sink.read_tables(spark, scratch, names).items()} == dict.fromkeys(names, 2)
    sink.refresh_tables(make(7), scratch, order=names)
    assert {n: d.count() for n, d in sink.read_tables(spark, scratch, names).items()} == dict.fromkeys(names, 7)
    assert spark.read.parquet(old["x"]).count() == 2  # readers of the former version go on
    sink.refresh_tables(make(8), scratch, order=names)
    assert len(sink.versions(spark, scratch)) == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(old["x"]).count()


def test_observed_counters_cost_no_scan(spark, scratch):
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    df = spark.range(50).mapInArrow(seen, "id long")
    staged, counts = quality.observed_counters(df, {"all": F.lit(True), "even": F.col("id") % 2 == 0, "none": F.lit(None).cast("boolean")})
    assert counts.collect() == [(50, 25, 0)] and staged.count() == 50 and runs.value == 50


def test_overall_health(spark):
    schema = "table_name string, n_rows bigint, status string"
    ask = lambda rows: quality.overall_health(spark.createDataFrame(rows, schema)).collect()[0]
    assert tuple(ask([("a", 1, "ok"), ("b", 0, "empty"), ("c", None, "failed")])) == (3, 1, 1, False)
    assert tuple(ask([("a", 1, "ok")])) == (1, 0, 0, True) and ask([]).healthy


def test_conform_refuses_what_does_not_fit(spark):
    from pyspark.sql import types as T

    from tessera.sources import schema

    declared = T.StructType([T.StructField("n", T.ShortType()), T.StructField("d", T.DateType())])
    good = spark.createDataFrame([(7, "2001-02-03", 1), (None, None, 2)], "n int, d string, other int")
    assert schema.conform(good, declared).dtypes == [("n", "smallint"), ("d", "date")] and schema.conform(good, declared).count() == 2
    bad = spark.createDataFrame([(70_000, "2001-02-03"), (1, "2001-02-30"), (2, None)], "n int, d string")
    with pytest.raises(Exception, match="does not fit"):
        schema.conform(bad, declared).collect()
    assert [tuple(r) for r in schema.refusals(bad, declared).collect()] == [("n", "smallint", 3, 1), ("d", "date", 2, 1)]
    with pytest.raises(ValueError, match="missing column"):
        schema.conform(spark.range(1), declared)
