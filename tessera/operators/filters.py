"""Filters and predicates.

F1 ``reference_date_filter``  keep rows on/after a per-key reference date (and the rejects, with reasons)
F2 ``order_violations``       rows whose end precedes their start (opt-in drop)
F3 ``where_in`` / F4 ``not_null_below`` / F5 ``having`` / F6 ``drop_nulls`` / F7 ``where_expr``
P7 ``constant_lookup``        small constant dictionary as a broadcast join
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def constant_lookup(
    df: DataFrame,
    key_col: str,
    mapping: Mapping,
    out_col: str,
    value_type: str | None = None,
) -> DataFrame:
    """Map ``key_col`` through a constant dictionary (miss -> NULL).

    The dictionary is a literal table whose size is fixed by the caller, so
    it is broadcast.
    """
    spark = df.sparkSession
    items = list(mapping.items())
    key_type = dict(df.dtypes)[key_col]
    vt = value_type or ("bigint" if all(isinstance(v, int) for _, v in items) else "string")
    table = spark.createDataFrame(items, f"_k {key_type}, _v {vt}")
    joined = df.join(F.broadcast(table), df[key_col] == table["_k"], "left")
    return joined.drop("_k").withColumnRenamed("_v", out_col)


def reference_date_filter(
    df: DataFrame,
    key_col: str,
    date_col: str,
    first_year: Mapping[str, int] | None = None,
    reference_col: str | None = None,
    with_rejects: bool = False,
):
    """keep rows with ``date_col >= reference date``.

    The reference date is 1 January of ``first_year[key]`` (a broadcast
    constant lookup) or the value of an existing ``reference_col``. SQL
    three-valued logic applies as in the reference: rows with a NULL date or
    an unknown key are dropped too. With ``with_rejects`` returns
    ``(kept, rejects)`` where rejects carry a ``reject_reason`` of
    ``unknown_key``, ``null_date`` or ``before_reference``.
    """
    flagged = flag_rejects(df, key_col, date_col, first_year, "_reject", reference_col)
    kept = flagged.where(F.col("_reject").isNull()).drop("_reject")
    if not with_rejects:
        return kept
    return kept, flagged.where(F.col("_reject").isNotNull()).withColumnRenamed("_reject", "reject_reason")


def flag_rejects(
    df: DataFrame,
    key_col: str,
    date_col: str,
    first_year: Mapping[str, int] | None = None,
    flag_col: str = "reject_reason",
    reference_col: str | None = None,
) -> DataFrame:
    """F1 without dropping: all rows with ``flag_col`` = why :func:`reference_date_filter`
    would reject the row, NULL if it keeps it."""
    ref = "_ref_date"
    if reference_col is None:
        with_ref = constant_lookup(df, key_col, first_year or {}, "_ref_year").withColumn(
            ref, F.make_date(F.col("_ref_year").cast("int"), F.lit(1), F.lit(1))
        ).drop("_ref_year")
    else:
        with_ref = df.withColumn(ref, F.col(reference_col).cast("date"))
    reason = (
        F.when(F.col(ref).isNull(), F.lit("unknown_key"))
        .when(F.col(date_col).isNull(), F.lit("null_date"))
        .when(F.col(date_col).cast("date") >= F.col(ref), F.lit(None))
        .otherwise(F.lit("before_reference"))
    )
    return with_ref.withColumn(flag_col, reason).drop(ref)


def order_violations(df: DataFrame, start_col: str, end_col: str, drop: bool = False) -> DataFrame:
    """rows where ``end`` is present and earlier than ``start``.

    With ``drop=True`` returns the complement instead (the documented but
    not implemented cleaning step).
    """
    bad = F.col(end_col).isNotNull() & (F.col(end_col) < F.col(start_col))
    if drop:
        return df.where(~F.coalesce(bad, F.lit(False)))
    return df.where(bad)


def where_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """equality / IN filter."""
    vals = list(values)
    return df.where(F.col(col) == F.lit(vals[0])) if len(vals) == 1 else df.where(F.col(col).isin(vals))


def not_null_below(df: DataFrame, col: str, upper) -> DataFrame:
    """``col IS NOT NULL AND col < upper``."""
    return df.where(F.col(col).isNotNull() & (F.col(col) < F.lit(upper)))


def having(df: DataFrame, predicate: Column | str) -> DataFrame:
    """filter applied after an aggregate (HAVING)."""
    return df.where(predicate)


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """drop rows with a NULL in any column (or in ``subset``)."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def where_expr(df: DataFrame, expr: str) -> DataFrame:
    """filter by a SQL expression string, e.g. ``'null_count > 0'``."""
    return df.where(F.expr(expr))
