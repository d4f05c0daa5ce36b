"""p-values as Spark expressions.

Neither Spark SQL nor the image ships a Student-t or chi-square CDF, so the
tail probabilities are definite integrals evaluated with Simpson's rule inside
one expression (``aggregate`` over ``sequence``). They are applied to
already-aggregated test statistics (one row per test), so the cost is a few
thousand flops per test, independent of the data size.

Student t, two-sided: with t = sqrt(v) tan(theta) the density is proportional
to cos(theta)^(v-1) on (-pi/2, pi/2), so

    p = int_a^{pi/2} cos^(v-1) / int_0^{pi/2} cos^(v-1),  a = atan(|t| / sqrt(v)).

The integrand is negligible beyond 12/sqrt(v) (about 12 standard deviations),
so both upper limits are cut there; that keeps the grid on the mass.

Chi-square upper tail with k degrees of freedom: with x = u^2 the density is
proportional to u^(k-1) exp(-u^2/2), integrated from sqrt(x) (numerator) or 0
(denominator) to max(sqrt(x), sqrt(k)) + 12; the exponent is shifted by its
maximum so large k doesn't overflow.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

T_INTERVALS = 2000
CHI2_INTERVALS = 4000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def simpson(f, lo: Column, hi: Column, n: int) -> Column:
    """Composite Simpson integral of ``f`` (Column -> Column) over [lo, hi], n even."""
    h = (hi - lo) / F.lit(float(n))

    def step(acc, i):
        w = F.when((i == 0) | (i == n), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        return acc + w * f(lo + i.cast("double") * h)

    total = F.aggregate(F.sequence(F.lit(0), F.lit(n)), F.lit(0.0), step)
    return total * h / F.lit(3.0)


def student_t_two_sided_p(t, dof, n: int = T_INTERVALS) -> Column:
    """Two-sided p of a Student t statistic with (possibly fractional) ``dof``."""
    t, v = _c(t).cast("double"), _c(dof).cast("double")
    half_pi = F.lit(math.pi / 2)
    a = F.atan(F.abs(t) / F.sqrt(v))
    span = F.lit(12.0) / F.sqrt(v)
    f = lambda th: F.pow(F.cos(th), v - F.lit(1.0))
    num = simpson(f, a, F.least(half_pi, a + span), n)
    den = simpson(f, F.lit(0.0), F.least(half_pi, span), n)
    p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), num / den))
    return F.when(v > 0, F.when(F.isnan(t), F.lit(None)).otherwise(p))


def chi2_upper_p(x, k, n: int = CHI2_INTERVALS) -> Column:
    """Upper-tail p of a chi-square statistic ``x`` with ``k`` degrees of freedom."""
    x, k = _c(x).cast("double"), _c(k).cast("double")
    km1 = k - F.lit(1.0)
    shift = F.when(k > 1, km1 / 2 * F.log(F.greatest(km1, F.lit(1e-300))) - km1 / 2).otherwise(F.lit(0.0))
    top = F.greatest(F.sqrt(x), F.sqrt(k)) + F.lit(12.0)
    f = lambda u: F.exp(km1 * F.log(F.greatest(u, F.lit(1e-300))) - u * u / 2 - shift)
    num = simpson(f, F.sqrt(x), top, n)
    den = simpson(f, F.lit(0.0), top, n)
    p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), num / den))
    # Without degrees of freedom (one row or column) nothing can differ: p is 1.
    return F.when((k > 0) & (x >= 0), p).when((k == 0) & (x >= 0), F.lit(1.0))


def verdict(p, alpha: float = 0.05, significant: str = "significant", not_significant: str = "not significant") -> Column:
    """Text verdict from a p-value."""
    return F.when(_c(p) < alpha, F.lit(significant)).when(_c(p).isNotNull(), F.lit(not_significant))


# --- the same integrals as DuckDB SQL text, for oracle queries --------------

def simpson_sql(f, lo: str, hi: str, n: int) -> str:
    h = f"(({hi}) - ({lo})) / {float(n)}"
    w = f"(CASE WHEN i = 0 OR i = {n} THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END)"
    return f"(list_sum(list_transform(range(0, {n + 1}), lambda i: {w} * {f(f'(({lo}) + i * {h})')})) * {h} / 3.0)"


def student_t_two_sided_p_sql(t: str, dof: str, n: int = T_INTERVALS) -> str:
    t, v = f"CAST({t} AS DOUBLE)", f"CAST({dof} AS DOUBLE)"
    a = f"atan(abs({t}) / sqrt({v}))"
    span = f"(12.0 / sqrt({v}))"
    hp = repr(math.pi / 2)
    f = lambda th: f"pow(cos({th}), {v} - 1.0)"
    num = simpson_sql(f, a, f"least({hp}, {a} + {span})", n)
    den = simpson_sql(f, "0.0", f"least({hp}, {span})", n)
    return f"(CASE WHEN {v} > 0 AND NOT isnan({t}) THEN least(1.0, greatest(0.0, {num} / {den})) END)"


def chi2_upper_p_sql(x: str, k: str, n: int = CHI2_INTERVALS) -> str:
    x, k = f"CAST({x} AS DOUBLE)", f"CAST({k} AS DOUBLE)"
    km1 = f"({k} - 1.0)"
    shift = f"(CASE WHEN {k} > 1 THEN {km1} / 2 * ln(greatest({km1}, 1e-300)) - {km1} / 2 ELSE 0.0 END)"
    top = f"(greatest(sqrt({x}), sqrt({k})) + 12.0)"
    f = lambda u: f"exp({km1} * ln(greatest({u}, 1e-300)) - {u} * {u} / 2 - {shift})"
    num = simpson_sql(f, f"sqrt({x})", top, n)
    den = simpson_sql(f, "0.0", top, n)
    return f"(CASE WHEN {k} > 0 AND {x} >= 0 THEN least(1.0, greatest(0.0, {num} / {den})) END)"
