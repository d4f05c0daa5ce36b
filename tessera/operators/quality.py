"""Data-quality checks returned as tables (Q1-Q11).

Each check is an aggregate or an anti/semi join, so it runs distributed and
brings nothing but its (small) answer back. Constraints come from
:mod:`tessera.sources.schema` or the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .staging import stage_table

from ..sources.schema import TableConstraints


def _unpivot_counts(row: DataFrame, names: Sequence[str], name_col: str, value_col: str) -> DataFrame:
    return row.unpivot([], list(names), name_col, value_col)


def pk_violations(df: DataFrame, keys: Sequence[str], count_col: str = "n_rows") -> DataFrame:
    """Q1: key values that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)


def fk_violations(child: DataFrame, fk_col: str, parent: DataFrame, pk_col: str) -> DataFrame:
    """Q2: child rows whose non-NULL foreign key has no parent row (left anti join)."""
    parent_keys = parent.select(F.col(pk_col).alias("_pk")).distinct()
    return child.where(F.col(fk_col).isNotNull()).join(parent_keys, F.col(fk_col) == F.col("_pk"), "left_anti")


def unresolved_keys(df: DataFrame, key_cols: Sequence[str], prefix: str = "unresolved_") -> DataFrame:
    """Q3: one row with the NULL count of each looked-up key column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(f"{prefix}{c}") for c in key_cols])


def counters(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Q7: named conditional counts in one pass (``count_if`` each)."""
    return df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).cast("bigint").alias(n) for n, p in predicates.items()])


def observed_counters(df: DataFrame, predicates: Mapping[str, Column], name: str = "observed") -> tuple[DataFrame, DataFrame]:
    """Q7 for a table that is staged anyway: (staged table, one row of named conditional counts).

    The counts are observed while the table is written, so they cost no further
    scan. They reach the driver as one number each.
    """
    seen = Observation(name)
    observed = df.observe(seen, *[F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in predicates.items()])
    staged = stage_table(observed, name)
    found = seen.get
    row = tuple(found[n] for n in predicates)
    return staged, df.sparkSession.createDataFrame([row], ", ".join(f"`{n}` bigint" for n in predicates))


def check_violations(
    df: DataFrame,
    not_null: Sequence[str] = (),
    ranges: Mapping[str, tuple] | None = None,
) -> DataFrame:
    """Q4: NOT NULL and CHECK (BETWEEN) violations, one row per rule.

    Columns: ``rule``, ``column_name``, ``n_violations``. All rules are
    counted in one aggregate.
    """
    ranges = ranges or {}
    aggs, names, meta = [], [], {}
    for c in not_null:
        n = f"not_null__{c}"
        aggs.append(F.count_if(F.col(c).isNull()).cast("bigint").alias(n))
        names.append(n)
        meta[n] = ("not_null", c)
    for c, (lo, hi) in ranges.items():
        n = f"range__{c}"
        aggs.append(F.count_if(F.col(c).isNotNull() & ~F.col(c).between(lo, hi)).cast("bigint").alias(n))
        names.append(n)
        meta[n] = ("range", c)
    return _rules_table(df, aggs, names, meta)


def length_violations(
    df: DataFrame,
    max_length: Mapping[str, int] | None = None,
    precision: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """Q5: VARCHAR(n) and DECIMAL(p, s) overflows, one row per rule.

    A value violates DECIMAL(p, s) when it is present but does not fit
    (``try_cast`` gives NULL).
    """
    aggs, names, meta = [], [], {}
    for c, n_chars in (max_length or {}).items():
        n = f"length__{c}"
        aggs.append(F.count_if(F.length(F.col(c)) > n_chars).cast("bigint").alias(n))
        names.append(n)
        meta[n] = ("max_length", c)
    for c, (p, s) in (precision or {}).items():
        n = f"precision__{c}"
        fits = F.col(c).try_cast(f"decimal({p},{s})")
        aggs.append(F.count_if(F.col(c).isNotNull() & fits.isNull()).cast("bigint").alias(n))
        names.append(n)
        meta[n] = ("precision", c)
    return _rules_table(df, aggs, names, meta)


def _rules_table(df: DataFrame, aggs: list[Column], names: list[str], meta: dict) -> DataFrame:
    if not aggs:
        return df.sparkSession.createDataFrame([], "rule string, column_name string, n_violations bigint")
    long = _unpivot_counts(df.agg(*aggs), names, "_rule_key", "n_violations")
    rule = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(meta[n][0]))])
    col = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(meta[n][1]))])
    return long.select(
        rule[F.col("_rule_key")].alias("rule"),
        col[F.col("_rule_key")].alias("column_name"),
        F.col("n_violations").cast("bigint").alias("n_violations"),
    )


def table_constraint_violations(df: DataFrame, c: TableConstraints) -> DataFrame:
    """Q4 + Q5 for a declared table: one table of rule counts (key columns are never NULL)."""
    return check_violations(df, list(dict.fromkeys((*c.primary_key, *c.not_null))), c.ranges).unionByName(length_violations(df, c.max_length, c.precision))


def domain_violations(df: DataFrame, allowed: Mapping[str, Sequence]) -> DataFrame:
    """Q6: values outside each column's allowed set, with counts.

    Columns: ``column_name``, ``value``, ``n_rows``. NULLs are ignored. The
    columns are unpivoted and aggregated by (column, value) with a map-side
    partial aggregate, so no set of values is gathered in one task.
    """
    cols = list(allowed)
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column_name", "value")
    ok = None
    for c in cols:
        vals = [v for v in allowed[c] if v is not None]
        cond = (F.col("column_name") == F.lit(c)) & F.col("value").isin(vals)
        ok = cond if ok is None else (ok | cond)
    return (
        long.where(F.col("value").isNotNull() & ~ok)
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def health_check(tables: Mapping[str, DataFrame | Callable[[], DataFrame]], spark=None) -> DataFrame:
    """Q8: row count per table with status ``ok`` / ``empty`` / ``failed``.

    Values are DataFrames or zero-argument callables returning one (e.g.
    ``lambda: spark.read.parquet(path)``); a table whose callable raises
    (missing path, bad SQL), or that fails while it is read, is reported as
    ``failed`` with a NULL count instead of aborting the report. Every table
    is counted by a job of its own; one number per table reaches the driver.
    """
    rows = []
    for name, src in tables.items():
        try:
            df = src() if callable(src) else src
            spark = spark or df.sparkSession
            rows.append((name, df.agg(F.count(F.lit(1))).first()[0]))
        except Exception:  # noqa: BLE001 - reported as a row
            rows.append((name, None))
    if spark is None:
        raise ValueError("health_check needs a session when every table failed")
    out = spark.createDataFrame(rows, "table_name string, n_rows bigint")
    status = F.when(F.col("n_rows").isNull(), "failed").when(F.col("n_rows") == 0, "empty").otherwise("ok")
    return out.withColumn("status", status)


def overall_health(report: DataFrame) -> DataFrame:
    """Q8: one row over a :func:`health_check` report: tables, how many are empty or
    failed, and whether all are ``ok`` (NULL never; an empty report is healthy)."""
    bad = F.count_if(F.col("status") != "ok")
    return report.agg(
        F.count(F.lit(1)).alias("n_tables"), F.count_if(F.col("status") == "empty").alias("n_empty"),
        F.count_if(F.col("status") == "failed").alias("n_failed"), (bad == 0).alias("healthy"))


def duplicate_counts(df: DataFrame, cols: Sequence[str], prefix: str = "dup_") -> DataFrame:
    """Q9: per column, rows beyond the first occurrence of each value.

    NULLs count as equal to each other (``n - distinct non-null - [any null]``).
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        aggs += [F.count_distinct(F.col(c)).alias(f"_d_{c}"), F.max(F.col(c).isNull().cast("int")).alias(f"_z_{c}")]
    row = df.agg(*aggs)
    return row.select(*[
        (F.col("_n") - F.col(f"_d_{c}") - F.coalesce(F.col(f"_z_{c}"), F.lit(0))).cast("bigint").alias(f"{prefix}{c}")
        for c in cols
    ])


def duplicate_rows(df: DataFrame, col: str, n: int | None = 10, tie_break: Sequence[str] = ()) -> DataFrame:
    """Q10 + O2: all rows whose ``col`` value occurs more than once, sorted, first ``n``.

    The repeated values are found by an aggregate (partial, skew-safe) and
    semi-joined back; ``tie_break`` columns complete the sort so the first
    ``n`` rows are well defined. ``n=None`` keeps all.
    """
    dup_vals = df.groupBy(col).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select(F.col(col).alias("_v"))
    rows = df.join(dup_vals, df[col].eqNullSafe(dup_vals["_v"]), "left_semi")
    rows = rows.orderBy(F.col(col).asc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tie_break])
    return rows.limit(n) if n is not None else rows


def null_profile(df: DataFrame, decimals: int = 2) -> DataFrame:
    """Q11 + F7: per column NULL (or NaN) count and percent, only columns with some, by percent desc."""
    cols = df.columns
    floats = {c for c, kind in df.dtypes if kind in ("float", "double")}
    missing = lambda c: F.col(c).isNull() | F.isnan(F.col(c)) if c in floats else F.col(c).isNull()
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(missing(c)).cast("bigint").alias(c) for c in cols])
    long = row.unpivot(["_n"], cols, "column_name", "null_count")
    return (
        long.where("null_count > 0")
        .select(
            "column_name",
            F.col("null_count").cast("bigint").alias("null_count"),
            F.round(F.col("null_count") / F.col("_n") * 100.0, decimals).alias("null_pct"),
        )
        .orderBy(F.col("null_pct").desc(), F.col("column_name"))
    )
