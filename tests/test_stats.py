"""Tests and distributions against closed forms and brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.pvalues import chi2_upper_p, student_t_two_sided_p
from tessera.operators import stats

FIXTURE = [("A", "S")] * 2 + [("A", "F")] + [("B", "F")] * 3 + [("B", "S")]


def test_p_value_integrals(spark):
    df = spark.createDataFrame([(4.7199, 2.0, 1.215278, 1.0), (12.7062, 1.0, 156.52, 32.0), (0.0, 5.5, 0.0, 3.0)],
                               "t double, v double, x double, k double")
    rows = df.select(student_t_two_sided_p("t", "v").alias("pt"), chi2_upper_p("x", "k").alias("pc")).collect()
    # closed forms: v = 2 -> 1 - |t| / sqrt(t^2 + 2); v = 1 -> 1 - 2 atan(|t|) / pi
    assert rows[0].pt == pytest.approx(1 - 4.7199 / math.sqrt(4.7199 ** 2 + 2), rel=1e-10)
    assert rows[1].pt == pytest.approx(1 - 2 * math.atan(12.7062) / math.pi, rel=1e-10)
    assert rows[1].pt == pytest.approx(0.05, rel=1e-4)
    assert rows[2].pt == pytest.approx(1.0)
    # closed forms: k = 1 -> erfc(sqrt(x/2)); even k -> exp(-x/2) sum_{i<k/2} (x/2)^i / i!
    assert rows[0].pc == pytest.approx(math.erfc(math.sqrt(1.215278 / 2)), rel=1e-10)
    even = math.exp(-156.52 / 2) * sum((156.52 / 2) ** i / math.factorial(i) for i in range(16))
    assert rows[1].pc == pytest.approx(even, rel=1e-6)
    assert rows[2].pc == pytest.approx(1.0)


def _chi2_brute(pairs, correction):
    rows = sorted({a for a, _ in pairs})
    cols = sorted({b for _, b in pairs})
    obs = np.array([[sum(1 for p in pairs if p == (r, c)) for c in cols] for r in rows], dtype=float)
    n = obs.sum()
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / n
    dof = (len(rows) - 1) * (len(cols) - 1)
    if correction and dof == 1:
        diff = exp - obs
        obs = obs + np.minimum(0.5, np.abs(diff)) * np.sign(diff)
    return ((obs - exp) ** 2 / exp).sum(), dof


def test_chi_square_fixture(spark):
    df = spark.createDataFrame(FIXTURE, "a string, b string")
    r = stats.chi_square(df, "a", "b", correction=False).collect()[0]
    assert r.statistic == pytest.approx(1.2152777778, rel=1e-9)
    assert r.dof == 1 and r.n == 7
    assert r.p_value == pytest.approx(0.2702893848, rel=1e-8)
    assert r.verdict == "independent"
    y = stats.chi_square(df, "a", "b", correction=True).collect()[0]
    assert y.statistic == pytest.approx(_chi2_brute(FIXTURE, True)[0], rel=1e-12)


def test_chi_square_sparse_grid(spark):
    rnd = random.Random(5)
    pairs = [(f"r{rnd.randint(0, 6)}", f"c{rnd.randint(0, 4)}") for _ in range(300)]
    pairs = [p for p in pairs if p != ("r0", "c0") and p != ("r3", "c2")]  # unobserved cells
    df = spark.createDataFrame(pairs + [(None, "c1")], "a string, b string")
    r = stats.chi_square(df, "a", "b").collect()[0]
    want, dof = _chi2_brute(pairs, True)
    assert r.statistic == pytest.approx(want, rel=1e-10) and r.dof == dof


def test_welch_t(spark):
    rnd = random.Random(1)
    a = [rnd.gauss(10, 2) for _ in range(40)]
    b = [rnd.gauss(11, 5) for _ in range(25)]
    df = spark.createDataFrame([("a", v) for v in a] + [("b", v) for v in b] + [("a", None)], "g string, v double")
    r = stats.welch_t(df, "g", "v", "a", "b").collect()[0]
    va, vb = np.var(a, ddof=1) / len(a), np.var(b, ddof=1) / len(b)
    t = (np.mean(a) - np.mean(b)) / math.sqrt(va + vb)
    dof = (va + vb) ** 2 / (va ** 2 / (len(a) - 1) + vb ** 2 / (len(b) - 1))
    assert r.t_statistic == pytest.approx(t, rel=1e-9) and r.dof == pytest.approx(dof, rel=1e-9)
    assert 0 < r.p_value < 1


def test_pearson(spark):
    rnd = random.Random(2)
    xs = [rnd.random() for _ in range(200)]
    ys = [x * 0.5 + rnd.gauss(0, 0.3) for x in xs]
    df = spark.createDataFrame(list(zip(xs, ys)) + [(None, 1.0)], "x double, y double")
    r = stats.pearson(df, "x", "y").collect()[0]
    assert r.n == 200 and r.r == pytest.approx(np.corrcoef(xs, ys)[0, 1], rel=1e-9)
    const = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "x double, y double")
    assert stats.pearson(const, "x", "y").collect()[0].r is None


def test_trend_line(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (4.0, 9.0)], "x double, y double")
    fit, line = stats.trend_line(df, "x", "y")
    f = fit.collect()[0]
    assert (f.slope, f.intercept) == (pytest.approx(2.0), pytest.approx(1.0))
    pts = line.orderBy("i").collect()
    assert len(pts) == 100 and pts[0].x == 1.0 and pts[-1].x == 4.0 and pts[-1].y == pytest.approx(9.0)


def test_box_stats(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 100.0]
    df = spark.createDataFrame([("g", v) for v in vals], "g string, v double")
    r = stats.box_stats(df, "g", "v").collect()[0]
    q1, med, q3 = np.quantile(vals, [0.25, 0.5, 0.75])
    assert (r.q1, r.median, r.q3) == (pytest.approx(q1), pytest.approx(med), pytest.approx(q3))
    assert r.whisker_low == 1.0 and r.whisker_high == 6.0 and r.n_outliers == 1


def test_kde_matches_numpy(spark):
    vals = [1.0, 2.0, 2.0, 3.5, 7.0]
    df = spark.createDataFrame([("g", v) for v in vals] + [("one", 1.0)], "g string, v double")
    rows = stats.kde(df, "g", "v").orderBy("i").collect()
    assert {r.g for r in rows} == {"g"} and len(rows) == 100
    arr = np.array(vals)
    h = arr.std(ddof=1) * len(arr) ** -0.2
    grid = np.linspace(arr.min() - 2 * h, arr.max() + 2 * h, 100)
    dens = np.exp(-0.5 * ((grid[:, None] - arr[None, :]) / h) ** 2).sum(1) / (len(arr) * h * math.sqrt(2 * math.pi))
    assert [r.density for r in rows] == pytest.approx(list(dens), rel=1e-9)
    assert [r.x for r in rows] == pytest.approx(list(grid), rel=1e-12)


def test_histogram_fixture(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (10.0,), (None,)], "v double")
    rows = stats.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [2, 1, 0, 0, 1]
    assert [r.bin_start for r in rows] == [0.0, 2.0, 4.0, 6.0, 8.0] and rows[-1].bin_end == 10.0
    const = spark.createDataFrame([("a", 3.0), ("a", 3.0), ("b", 1.0), ("b", 2.0)], "g string, v double")
    by = stats.histogram(const, "v", 4, group_col="g").where("count > 0").collect()
    assert {(r.g, r.bin, r["count"]) for r in by} == {("a", 2, 2), ("b", 0, 1), ("b", 3, 1)}
    counts = np.histogram([0.0, 1.0, 2.0, 10.0], bins=5)[0]
    assert list(counts) == [2, 1, 0, 0, 1]


def test_point_feed(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "g string, v double")
    assert stats.point_feed(df, ["g", "v"], F.col("g") == "a").count() == 1


def test_histogram_matches_numpy_on_edges(spark):
    """Values on or next to interior edges land where numpy puts them."""
    rnd = random.Random(9)
    vals = [0.1 * k for k in range(0, 101)] + [rnd.uniform(0, 10) for _ in range(300)] + [0.3, 0.7, 2.9, 9.9]
    for bins in (7, 10, 40, 50):
        df = spark.createDataFrame([(v,) for v in vals], "v double")
        got = [r["count"] for r in stats.histogram(df, "v", bins).orderBy("bin").collect()]
        assert got == list(np.histogram(vals, bins=bins)[0]), bins


def test_p_values_against_closed_forms_on_random_inputs(spark):
    """Student t (v = 1, 2, 4) and chi-square (even k) against their closed forms."""
    rnd = random.Random(4)

    def t_closed(t, v):
        a = abs(t)
        if v == 1:
            return 1 - 2 * math.atan(a) / math.pi
        if v == 2:
            return 1 - a / math.sqrt(a * a + 2)
        # v == 4: with theta = atan(|t| / 2), p = 1 - sin(theta) (3 - sin(theta)^2) / 2
        s = math.sin(math.atan(a / math.sqrt(v)))
        return 1 - s * (3 - s * s) / 2

    def chi_closed(x, k):
        return math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(k // 2))

    rows = [(rnd.uniform(-8, 8), float(rnd.choice([1, 2, 4])), rnd.uniform(0, 60), float(2 * rnd.randint(1, 10)))
            for _ in range(60)]
    df = spark.createDataFrame(rows, "t double, v double, x double, k double")
    got = df.select("t", "v", "x", "k", student_t_two_sided_p("t", "v").alias("pt"), chi2_upper_p("x", "k").alias("pc")).collect()
    for r in got:
        assert r.pt == pytest.approx(t_closed(r.t, int(r.v)), rel=1e-7, abs=1e-12), (r.t, r.v)
        assert r.pc == pytest.approx(chi_closed(r.x, int(r.k)), rel=1e-7, abs=1e-12), (r.x, r.k)


def test_expected_counts_full_table(spark):
    """Cells without rows are in the table, observed 0 times."""
    df = spark.createDataFrame([("a", "x")] * 3 + [("a", "y")] + [("b", "x")] * 2 + [("b", None)], "r string, c string")
    got = {(r.r, r.c): (r.observed, r.expected) for r in stats.expected_counts(df, "r", "c").collect()}
    assert got == {("a", "x"): (3, 20 / 6), ("a", "y"): (1, 4 / 6), ("b", "x"): (2, 10 / 6), ("b", "y"): (0, 2 / 6)}
    with pytest.raises(ValueError, match="at most"):
        stats.expected_counts(df, "r", "c", max_columns=1)
