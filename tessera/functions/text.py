"""Text cleaning expressions (P1, P2, P13, D6 helper).

All functions return Spark ``Column`` expressions (or plain DataFrame
projections) so they run inside whole-stage codegen; no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cleaning sentinels, compared after stripping and lower-casing.
SENTINELS = ("n/a", "na", "none", "unknown", "not applicable", "", "nan")

# Tokens the reference's CSV reader (pandas defaults) reads as
# missing, compared on the raw field exactly.
READER_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The characters Python's str.strip() removes (str.isspace()),
# so stripping matches the reference's Unicode-aware strip.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_name(name: str) -> str:
    """P1 rule for one header: strip, lower-case, spaces to underscores."""
    return name.strip().lower().replace(" ", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column by :func:`normalize_name`; fail on collisions."""
    new = [normalize_name(c) for c in df.columns]
    dupes = sorted({n for n in new if new.count(n) > 1})
    if dupes:
        raise ValueError(f"column names collide after normalisation: {dupes}")
    return df.toDF(*new)


def strip(c) -> Column:
    """Remove leading and trailing whitespace like Python's ``str.strip()``.

    Plain ``trim`` drops spaces only; trimming the explicit whitespace set is
    a character scan, cheaper than an anchored regex.
    """
    return F.trim(_c(c), F.lit(WHITESPACE))


def null_if_sentinel(c, sentinels=SENTINELS, reader_tokens=READER_NA_TOKENS) -> Column:
    """Stripped text, or NULL when the value is a missing-value sentinel.

    A raw value equal to one of ``reader_tokens`` is NULL (what the CSV reader
    did); otherwise the stripped, lower-cased value is compared with
    ``sentinels``.
    """
    raw = _c(c)
    t = strip(raw)
    cond = F.lower(t).isin(list(sentinels))
    if reader_tokens:
        cond = raw.isin(list(reader_tokens)) | cond
    return F.when(cond, F.lit(None).cast("string")).otherwise(t)


def clean_text_columns(df: DataFrame, columns: list[str] | None = None, **kw) -> DataFrame:
    """P2 over every string column (or ``columns``) in one projection."""
    targets = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    }
    return df.select(*[
        null_if_sentinel(F.col(c), **kw).alias(c) if c in targets else F.col(c) for c in df.columns
    ])


def format_pct(c, decimals: int = 2) -> Column:
    """Number -> text such as ``'35.65%'``."""
    return F.format_string(f"%.{decimals}f%%", _c(c))


def pct_text(c, decimals: int = 2) -> Column:
    """Number rounded, then written in its shortest form plus ``%``
    (``20.5%``, ``32.0%``), as ``round(...).astype(str) + '%'`` does."""
    return F.concat(F.round(_c(c), decimals).cast("string"), F.lit("%"))


def parse_pct(c) -> Column:
    """P13 inverse: ``'35.65%'`` -> 35.65 (NULL when not a number)."""
    return F.regexp_replace(_c(c), "%", "").try_cast("double")


def split_list(c, pattern: str = r",\s*") -> Column:
    """D6 helper: delimited text -> array of stripped, non-empty items.

    Duplicates are kept and order is preserved; NULL input gives NULL.
    """
    parts = F.split(_c(c), pattern)
    stripped = F.transform(parts, lambda x: F.trim(x, F.lit(WHITESPACE)))
    return F.filter(stripped, lambda x: x != F.lit(""))
