"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"


def parse_date(c, pattern: str = ISO_DATE, fmt: str = "yyyy-M-d") -> Column:
    """Tolerant date parse; anything that is not a valid ``fmt`` date is NULL.

    Like a coercing parse with the format ``%Y-%m-%d``: a four-digit year and
    one- or two-digit month and day (``'1957-10-4'`` parses), the text
    stripped first; ``'1957'``, ``'10/04/1957'``, ``'19571004'``, a time part
    or an impossible day (``'2021-02-30'``) give NULL. Unlike a plain cast,
    a bare year is rejected.
    """
    s = strip(_c(c).cast("string"))
    return F.when(s.rlike(pattern), F.try_to_date(s, fmt))


def to_day(c) -> Column:
    """Truncate a timestamp (or timestamp_ntz) to its date."""
    return _c(c).cast("date")


def decade_label(year) -> Column:
    """1957 -> ``'1950s'``."""
    y = _c(year).cast("int")
    return F.concat((F.floor(y / 10) * 10).cast("int").cast("string"), F.lit("s"))


def calendar_columns(d, prefix: str = "") -> list[Column]:
    """P8 + P9: year, quarter, month, month_name, ISO week, day, decade."""
    d = _c(d)
    return [
        F.year(d).alias(f"{prefix}year"),
        F.quarter(d).alias(f"{prefix}quarter"),
        F.month(d).alias(f"{prefix}month"),
        F.date_format(d, "MMMM").alias(f"{prefix}month_name"),
        F.weekofyear(d).alias(f"{prefix}week"),
        F.dayofmonth(d).alias(f"{prefix}day"),
        decade_label(F.year(d)).alias(f"{prefix}decade"),
    ]
