"""Numeric parsing and derived-ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Duration units and their factors in days (year = 365.25,
# month = 30.44, day = 1, hour = 1/24).
DURATION_UNITS = (("year", 365.25), ("month", 30.44), ("day", 1.0), ("hour", 1.0 / 24.0))

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _duration_from(v: Column, texts: list[Column], units) -> Column:
    nums = [F.nullif(t, F.lit("")).try_cast("double") for t in texts]
    matched = bad = total = None
    for t, n, (_, factor) in zip(texts, nums, units):
        m = t != F.lit("")
        matched = m if matched is None else (matched | m)
        b = m & n.isNull()
        bad = b if bad is None else (bad | b)
        term = F.coalesce(n * F.lit(factor), F.lit(0.0))
        total = term if total is None else total + term
    bare = F.when(v.rlike(r"^[\d.]+$"), v.try_cast("double"))
    return (
        F.when(v.isNull(), F.lit(None).cast("double"))
        .when(~matched, bare)
        .when(bad, F.lit(None).cast("double"))
        .when(total > 0, F.round(total, 2))
    )


def _duration_text(c) -> Column:
    return strip(F.translate(F.lower(_c(c)), "~,", ""))


def _unit_pattern(unit: str) -> str:
    return rf"([\d.]+)\s*{unit}"


def duration_days(c, units=DURATION_UNITS) -> Column:
    """Human-written duration -> days.

    Lower-case, drop ``~`` and ``,``, strip. For each unit the *first*
    ``<number> <unit>`` match counts; the sum of number x factor is rounded to
    2 places and a sum <= 0 is NULL. With no unit matched, a bare number
    (digits and dots only) is taken as days, unrounded. A matched number that
    is not a valid float (``'1.2.3 days'``) makes the result NULL.

    As one expression the regex captures appear in several CASE branches;
    :func:`with_duration_days` evaluates each capture once per row and is the
    one to use on large tables.
    """
    v = _duration_text(c)
    return _duration_from(v, [F.regexp_extract(v, _unit_pattern(u), 1) for u, _ in units], units)


def with_duration_days(df: DataFrame, src: str, out: str = "duration_days", units=DURATION_UNITS) -> DataFrame:
    """P4 as a projection: the normalised text and each unit's capture are
    computed once per row (Catalyst keeps non-trivial expressions that are
    referenced several times in their own projection), then combined."""
    tmp = [f"_dur_{u}" for u, _ in units]
    d = df.withColumn("_dur_v", _duration_text(F.col(src)))
    d = d.select("*", *[F.regexp_extract("_dur_v", _unit_pattern(u), 1).alias(t) for (u, _), t in zip(units, tmp)])
    d = d.withColumn(out, _duration_from(F.col("_dur_v"), [F.col(t) for t in tmp], units))
    return d.drop("_dur_v", *tmp)


def to_number(c) -> Column:
    """P5: tolerant numeric cast like a coercing parser: failures are NULL.

    Accepts surrounding whitespace, signs, ``'5.'``, ``'.5'``, exponents and
    ``inf``/``infinity`` (any case, optional sign, no surrounding blanks);
    rejects thousands separators, type suffixes (``'1.0d'``), words and
    ``'nan'`` (a missing value). Checked against pandas' coercing parser on
    random text in the tests.
    """
    s = _c(c).cast("string")
    t = F.lower(s)  # infinities are accepted only without surrounding blanks
    return (
        F.when(s.rlike(_NUMBER), F.trim(s).try_cast("double"))
        .when(t.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf")))
        .when(t.isin("-inf", "-infinity"), F.lit(float("-inf")))
    )


def rescale(c, divisor: float, decimal: tuple[int, int] | None = None) -> Column:
    """Divide by a constant, optionally conforming to ``decimal(p, s)``."""
    out = _c(c) / F.lit(divisor)
    return out.try_cast(f"decimal({decimal[0]},{decimal[1]})") if decimal else out


def present(c) -> Column:
    """A numeric column as double with NaN as NULL: the missing-value rule of every statistic."""
    return F.nanvl(_c(c).cast("double"), F.lit(None).cast("double"))


def pct(numerator, denominator, decimals: int = 2) -> Column:
    """``round(100 * a / b, d)`` with NULL for a zero or NULL denominator."""
    return F.round(F.try_divide(F.lit(100.0) * _c(numerator).cast("double"), _c(denominator).cast("double")), decimals)


def ratio(numerator, denominator, decimals: int | None = 2) -> Column:
    """Guarded ratio ``a / b`` (NULL for zero), optionally rounded."""
    r = F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double"))
    return F.round(r, decimals) if decimals is not None else r


def flag(predicate: Column) -> Column:
    """``CASE WHEN predicate THEN 1 ELSE 0 END`` (NULL predicate -> 0)."""
    return F.when(predicate, F.lit(1)).otherwise(F.lit(0))


def threshold_label(c, threshold: float, below: str = "below", at_or_above: str = "at_or_above") -> Column:
    """Two-way label of a number against a threshold (NULL stays NULL)."""
    return F.when(_c(c) < F.lit(threshold), F.lit(below)).when(_c(c).isNotNull(), F.lit(at_or_above))


def count_where(predicate: Column) -> Column:
    """Conditional count as bigint (``sum(case when ... then 1 else 0 end)``)."""
    return F.count_if(F.coalesce(predicate, F.lit(False))).cast("bigint")
