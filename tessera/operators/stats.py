"""Hypothesis tests and distribution summaries.

Statistics are built from aggregates (counts, means, variances, co-moments)
that Spark combines map-side; p-values are expressions on the one-row
results (:mod:`tessera.functions.pvalues`). No raw rows leave the executors.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import present
from ..functions.pvalues import chi2_upper_p, student_t_two_sided_p, verdict
from .lookup import lookup, staged_lookup
from .quantiles import counted_values
from .staging import stage_table


# ---------------------------------------------------------------- T1

def chi_square(
    df: DataFrame,
    row_col: str,
    col_col: str,
    correction: bool = True,
    alpha: float = 0.05,
) -> DataFrame:
    """T1 + T9: chi-square test of independence of two categorical columns.

    Returns one row: ``statistic``, ``dof``, ``p_value``, ``n``, ``verdict``.
    Rows with a NULL on either side are dropped (like a crosstab).

    The full r x c grid is never built: with observed cells only,

        chi2 = sum_observed (o - e)^2 / e + sum_unobserved e,
        sum_unobserved e = sum_i R_i (N - S_i) / N,

    where S_i is the sum of the column totals of the cells observed in row i
    (integer arithmetic, exact). With ``correction`` and one degree of
    freedom (2 x 2) Yates' correction applies; in a 2 x 2 table |o - e| is the
    same D in every cell, so the corrected statistic is
    (D - min(0.5, D))^2 * N * (sum 1/R_i)(sum 1/C_j).
    """
    base = df.where(F.col(row_col).isNotNull() & F.col(col_col).isNotNull())
    # Internal names are underscore-prefixed: Spark resolves names case-insensitively.
    # The cells are staged: everything else is computed from them, so the input is read once.
    cells = stage_table(base.groupBy(row_col, col_col).agg(F.count(F.lit(1)).alias("_o")), "cells")
    rows = cells.groupBy(row_col).agg(F.sum("_o").alias("_R"))
    cols = cells.groupBy(col_col).agg(F.sum("_o").alias("_C"))
    n = cells.select(F.sum("_o")).scalar()
    full = cells.join(rows, row_col).join(cols, col_col)
    full = full.withColumn("_e", F.col("_R").cast("double") * F.col("_C").cast("double") / n.cast("double"))
    fs = full.select(F.struct(
        F.sum((F.col("_o") - F.col("_e")) ** 2 / F.col("_e")).alias("obs"),
        F.max(F.abs(F.col("_o") - F.col("_e"))).alias("d"),
    )).scalar()
    per_row = full.groupBy(row_col, "_R").agg(F.sum("_C").alias("_S")).withColumn(
        "_u", F.col("_R").cast("double") * (n - F.col("_S")).cast("double") / n.cast("double")
    )
    unobserved_part = per_row.select(F.sum("_u")).scalar()
    rs = rows.select(F.struct(F.count(F.lit(1)).alias("k"), F.sum(1.0 / F.col("_R").cast("double")).alias("inv"))).scalar()
    cs = cols.select(F.struct(F.count(F.lit(1)).alias("k"), F.sum(1.0 / F.col("_C").cast("double")).alias("inv"))).scalar()
    observed_part, d_any = fs.getField("obs"), fs.getField("d")
    r, inv_r = rs.getField("k"), rs.getField("inv")
    c, inv_c = cs.getField("k"), cs.getField("inv")

    dof = ((r - 1) * (c - 1)).cast("bigint")
    plain = observed_part + unobserved_part
    if correction:
        yates = (d_any - F.least(F.lit(0.5), d_any)) ** 2 * n.cast("double") * inv_r * inv_c
        stat = F.when(dof == 1, yates).otherwise(plain)
    else:
        stat = plain
    one = df.sparkSession.range(1)
    out = one.select(stat.alias("statistic"), dof.alias("dof"), n.cast("bigint").alias("n"))
    out = out.withColumn("p_value", chi2_upper_p(F.col("statistic"), F.col("dof")))
    return out.withColumn("verdict", verdict(F.col("p_value"), alpha, "associated", "independent"))


def expected_counts(df: DataFrame, row_col: str, col_col: str, max_columns: int = 10_000) -> DataFrame:
    """Observed and expected count of every cell of the full table (long form).

    Cells without rows are observed 0 times. Each row total meets the list of
    column totals, so ``col_col`` may have ``max_columns`` values at most;
    more raise an error instead of leaving cells out.
    """
    base = df.where(F.col(row_col).isNotNull() & F.col(col_col).isNotNull())
    cells = stage_table(base.groupBy(row_col, col_col).agg(F.count(F.lit(1)).alias("observed")), "cells")
    rows = cells.groupBy(row_col).agg(F.sum("observed").alias("_R"))
    cols = cells.groupBy(col_col).agg(F.sum("observed").alias("_C"))
    n = cells.select(F.sum("observed")).scalar()
    if (found := cols.count()) > max_columns:
        raise ValueError(f"{col_col} has {found} values; expected_counts takes {max_columns} at most")
    listed = cols.select(F.collect_list(F.struct(col_col, "_C"))).scalar()
    full = rows.withColumn("_c", F.explode(listed)).select(row_col, "_R", f"_c.{col_col}", "_c._C")
    return full.join(cells, [row_col, col_col], "left").na.fill(0, ["observed"]).select(
        row_col, col_col, "observed",
        (F.col("_R").cast("double") * F.col("_C").cast("double") / n.cast("double")).alias("expected"),
    )


# ---------------------------------------------------------------- T2

def welch_t(df: DataFrame, group_col: str, value_col: str, a: str, b: str, alpha: float = 0.05) -> DataFrame:
    """T2 + T9: Welch's unequal-variance t-test of sample ``a`` vs ``b`` (NULLs omitted).

    One conditional aggregate gives n, mean and sample variance of both
    samples; t and the Welch-Satterthwaite degrees of freedom follow.
    """
    v = present(value_col)
    ina, inb = F.col(group_col) == F.lit(a), F.col(group_col) == F.lit(b)
    s = df.agg(
        F.count(F.when(ina, v)).alias("n_a"), F.avg(F.when(ina, v)).alias("mean_a"), F.var_samp(F.when(ina, v)).alias("var_a"),
        F.count(F.when(inb, v)).alias("n_b"), F.avg(F.when(inb, v)).alias("mean_b"), F.var_samp(F.when(inb, v)).alias("var_b"),
    )
    qa = F.col("var_a") / F.col("n_a")
    qb = F.col("var_b") / F.col("n_b")
    se = F.sqrt(qa + qb)
    s = s.withColumn("t_statistic", F.try_divide(F.col("mean_a") - F.col("mean_b"), se))
    s = s.withColumn(
        "dof", F.try_divide((qa + qb) ** 2, qa ** 2 / (F.col("n_a") - 1) + qb ** 2 / (F.col("n_b") - 1))
    )
    s = s.withColumn("p_value", student_t_two_sided_p(F.col("t_statistic"), F.col("dof")))
    return s.withColumn("verdict", verdict(F.col("p_value"), alpha, "different", "not different"))


# ---------------------------------------------------------------- T3

def pearson(df: DataFrame, x: str, y: str, alpha: float = 0.05) -> DataFrame:
    """T3 + T9: Pearson r on complete pairs with its two-sided p-value.

    ``r = covar_samp / (stddev_x stddev_y)`` from Spark's stable co-moment
    aggregates; a constant column gives NULL instead of a division error.
    """
    pairs = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).na.drop()
    s = pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.try_divide(F.covar_samp("_x", "_y"), F.stddev_samp("_x") * F.stddev_samp("_y")).alias("r"),
    )
    r = F.col("r")
    t = F.when(F.abs(r) >= 1.0, F.lit(float("inf"))).otherwise(
        r * F.sqrt((F.col("n") - 2).cast("double") / (1.0 - r * r))
    )
    s = s.withColumn("p_value", F.when(F.col("n") > 2, student_t_two_sided_p(t, F.col("n") - 2)))
    direction = F.when(r > 0, "positive").otherwise("negative")
    return s.withColumn(
        "verdict",
        F.when(F.col("p_value").isNotNull(), F.concat(verdict(F.col("p_value"), alpha), F.lit(" "), direction)),
    )


# ---------------------------------------------------------------- T4

def trend_line(df: DataFrame, x: str, y: str, points: int = 100) -> tuple[DataFrame, DataFrame]:
    """T4: least-squares line ``y = slope x + intercept`` and ``points`` evaluated points.

    Returns ``(fit, line)``: ``fit`` has slope, intercept, x_min, x_max; ``line``
    has ``i``, ``x``, ``y`` on an even grid from x_min to x_max (100 rows by
    default, generated from the one-row fit).
    """
    fit = df.agg(
        F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")).alias("slope"),
        F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")).alias("intercept"),
        F.min(F.col(x).cast("double")).alias("x_min"),
        F.max(F.col(x).cast("double")).alias("x_max"),
    )
    step = (F.col("x_max") - F.col("x_min")) / F.lit(float(points - 1))
    grid = fit.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    xs = F.when(F.col("i") == points - 1, F.col("x_max")).otherwise(F.col("x_min") + F.col("i") * step)
    line = grid.select("i", xs.alias("x"), "slope", "intercept")
    line = line.select("i", "x", (F.col("slope") * F.col("x") + F.col("intercept")).alias("y"))
    return fit, line


# ---------------------------------------------------------------- T5

def box_stats(df: DataFrame, group_col: str, value_col: str, whisker: float = 1.5) -> DataFrame:
    """T5: per group q1, median, q3, whiskers (extreme data within ``whisker`` IQR), outlier count.

    Quartiles come from the exact quantile operator; the whiskers and the
    outlier count are one more aggregate over its staged counted values, which
    look the fences up map-side, not another pass over the input.
    """
    base = df.where(F.col(group_col).isNotNull() & present(value_col).isNotNull())
    counted = counted_values(base, [group_col], value_col)
    q = counted.quantiles([0.25, 0.5, 0.75], ["q1", "median", "q3"])
    iqr = F.col("q3") - F.col("q1")
    fences = staged_lookup(q.select(
        group_col, "q1", "median", "q3", "n",
        (F.col("q1") - whisker * iqr).alias("_lo"), (F.col("q3") + whisker * iqr).alias("_hi"),
    ), "fences")
    v = F.col("_v")
    inside = (v >= F.col("_lo")) & (v <= F.col("_hi"))
    return lookup(counted.rows, fences, [group_col]).groupBy(group_col).agg(
        *[F.first(c).alias(c) for c in ("q1", "median", "q3", "n")],
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.sum(F.when(~inside, F.col("_c")).otherwise(0)).cast("bigint").alias("n_outliers"),
    )


# ---------------------------------------------------------------- T6

def kde(
    df: DataFrame,
    group_col: str,
    value_col: str,
    gridsize: int = 100,
    cut: float = 2.0,
    bw_adjust: float = 1.0,
) -> DataFrame:
    """Gaussian kernel density per group on an even grid (violin statistics).

    Scott's bandwidth ``h = std * n^(-1/5) * bw_adjust``; the grid spans
    ``[min - cut h, max + cut h]`` in ``gridsize`` points. The grids (one row per
    group) are looked up map-side, and every task folds its rows into one array of
    ``gridsize`` sums per group, so the shuffle carries groups x tasks arrays,
    whatever the number of rows. Groups with fewer than two values or zero spread
    have no density.
    """
    base = df.where(F.col(group_col).isNotNull() & present(value_col).isNotNull()).select(
        group_col, present(value_col).alias("_v")
    )
    params = base.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("_n"), F.stddev_samp("_v").alias("_sd"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx")
    ).where((F.col("_n") > 1) & (F.col("_sd") > 0))
    params = params.withColumn("bandwidth", F.col("_sd") * F.pow(F.col("_n").cast("double"), -0.2) * bw_adjust)
    params = params.withColumn("_lo", F.col("_mn") - cut * F.col("bandwidth")).withColumn(
        "_step", (F.col("_mx") + cut * F.col("bandwidth") - F.col("_lo")) / F.lit(float(gridsize - 1))
    )
    grid = staged_lookup(params.select(group_col, "_n", "bandwidth", "_lo", "_step"), "grid")
    # In units of the bandwidth, grid point i lies at _u - i * _d from the row's value.
    units = lookup(base, grid, [group_col]).select(
        group_col, "_n", "bandwidth", "_lo", "_step", ((F.col("_lo") - F.col("_v")) / F.col("bandwidth")).alias("_u"),
        (F.col("_step") / F.col("bandwidth")).alias("_d"),
    )
    kernels = [f"sum(exp(-0.5D * (_u + {i} * _d) * (_u + {i} * _d))) AS _s{i}" for i in range(gridsize)]
    kept = [f"first({c}) AS {c}" for c in ("_n", "bandwidth", "_lo", "_step")]
    sums = units.groupBy(group_col).agg(*map(F.expr, [*kept, *kernels]))
    norm = F.col("_n").cast("double") * F.col("bandwidth") * math.sqrt(2 * math.pi)
    return sums.select(
        group_col, "_n", "bandwidth", "_lo", "_step",
        F.expr(f"posexplode(array({', '.join(f'_s{i}' for i in range(gridsize))}))").alias("i", "_s"),
    ).select(
        group_col, "i", (F.col("_lo") + F.col("i") * F.col("_step")).alias("x"), (F.col("_s") / norm).alias("density"), "bandwidth",
    )


# ---------------------------------------------------------------- T7

def histogram(
    df: DataFrame,
    value_col: str,
    bins: int = 50,
    group_col: str | None = None,
) -> DataFrame:
    """Equal-width histogram, range from the data (per group when given).

    Bin ``k`` covers ``[lo + k w, lo + (k+1) w)``, the last bin is closed;
    for a constant sample the range is ``[v - 0.5, v + 0.5]``. Every bin is
    present (zero-filled). Columns: [group], ``bin``, ``bin_start``,
    ``bin_end``, ``count``. The global range is a pair of scalar subqueries;
    per-group ranges (one row per group) are looked up map-side, so raw rows are
    only counted, never shuffled.
    """
    keep = present(value_col).isNotNull() & (F.col(group_col).isNotNull() if group_col else F.lit(True))
    keys = [group_col] if group_col else []
    base = df.where(keep).select(*keys, F.col(value_col).cast("double").alias("_v"))
    rng = base.groupBy(*keys).agg(F.min("_v").alias("_mn"), F.max("_v").alias("_mx"))
    same = F.col("_mn") == F.col("_mx")
    rng = rng.select(
        *keys,
        F.when(same, F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
        F.when(same, F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"),
    )
    if group_col:
        rng = staged_lookup(rng, "ranges")
        joined = lookup(base, rng, keys)
        grid = rng.select(*keys, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    else:
        lo, hi = rng.select("_lo").scalar(), rng.select("_hi").scalar()
        joined = base.select("_v", lo.alias("_lo"), hi.alias("_hi"))
        grid = rng.select("_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    # Each step is its own column so no expression (or scalar subquery) is repeated.
    binned = _with_bin_index(joined, bins)
    counts = binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("_c"))
    out = grid.join(counts, [*keys, "bin"], "left")
    return out.select(
        *keys, "bin",
        _edge(F.col("bin"), F.col("_lo"), F.col("_hi"), bins).alias("bin_start"),
        _edge(F.col("bin") + 1, F.col("_lo"), F.col("_hi"), bins).alias("bin_end"),
        F.coalesce(F.col("_c"), F.lit(0)).cast("bigint").alias("count"),
    )


def _edge(k: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Edge ``k`` of ``bins`` equal-width bins as an evenly spaced grid computes it
    (``k * step + lo``, the last edge exactly ``hi``)."""
    step = (hi - lo) / F.lit(float(bins))
    return F.when(k == bins, hi).otherwise(k.cast("double") * step + lo)


def _with_bin_index(df: DataFrame, bins: int) -> DataFrame:
    """Add ``bin``: the bin of ``_v`` in [``_lo``, ``_hi``] the way numpy's
    equal-width histogram assigns it.

    ``(v - lo) * (bins / (hi - lo))`` truncated, the top value folded into the
    last bin, then corrected by one against the actual edges, so a value on
    an interior edge always opens the bin above it.
    """
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    norm = F.lit(float(bins)) / (hi - lo)
    d = df.withColumn("_i0", F.least(F.floor((v - lo) * norm).cast("int"), F.lit(bins - 1)))
    d = d.withColumn("_i1", F.when(v < _edge(F.col("_i0"), lo, hi, bins), F.col("_i0") - 1).otherwise(F.col("_i0")))
    up = (F.col("_i1") != bins - 1) & (v >= _edge(F.col("_i1") + 1, lo, hi, bins))
    return d.withColumn("bin", F.when(up, F.col("_i1") + 1).otherwise(F.col("_i1"))).drop("_i0", "_i1")


# ---------------------------------------------------------------- T8

def point_feed(df: DataFrame, cols: Sequence[str], predicate: Column | None = None, fraction: float | None = None, seed: int = 42) -> DataFrame:
    """The per-point rows behind a strip plot: filter + projection.

    ``fraction`` thins the points for drawing (opt-in; the default keeps all).
    """
    out = df.where(predicate) if predicate is not None else df
    out = out.select(*cols)
    return out.sample(fraction=fraction, seed=seed) if fraction else out
