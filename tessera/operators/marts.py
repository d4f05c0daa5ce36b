"""Summary marts and profiles.

Every mart is one ``groupBy().agg()`` (partial aggregate map-side, one
shuffle on the group keys) or one global ``agg``; conditional counts are
``count_if`` inside the same aggregate, never one scan per condition.
Aggregated measures are returned as double; counts as bigint.

Two null rules coexist, as in the reference: the SQL-view marts (A5-A7) keep
NULL group keys, the notebook profiles (A8-A11, A14, A17) drop them
(``_drop_null_keys``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import count_where, pct, present
from ..functions.text import format_pct, pct_text
from .quantiles import counted_values, exact_quantiles, quantiles
from .staging import stage_table


def _drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.na.drop(how="any", subset=list(keys))


def _round(c: Column, decimals: int | None) -> Column:
    return F.round(c, decimals) if decimals is not None else c


def present_sum(col: str, df: DataFrame) -> Column:
    """The column with NaN as NULL; decimals and integers as they are, so sums stay exact."""
    return F.nanvl(F.col(col), F.lit(None)) if df.schema[col].dataType.typeName() in ("double", "float") else F.col(col)


def _avg(col: str, decimals: int | None, df: DataFrame) -> Column:
    return _round(F.avg(present_sum(col, df)), decimals).cast("double")


# ---------------------------------------------------------------- A1-A4

def overview(
    df: DataFrame,
    distinct_cols: Sequence[str] = (),
    min_max_cols: Sequence[str] = (),
    flags: Mapping[str, Column] | None = None,
    count_alias: str = "total_rows",
    approx_distinct: bool = False,
) -> DataFrame:
    """A1: row count, distinct counts (NULLs excluded), min/max, conditional counts.

    ``approx_distinct`` swaps the exact distinct counts for HyperLogLog
    sketches (opt-in; exact is the default).
    """
    aggs = [F.count(F.lit(1)).alias(count_alias)]
    distinct = (lambda c: F.approx_count_distinct(c).cast("bigint")) if approx_distinct else F.count_distinct
    aggs += [distinct(F.col(c)).alias(f"distinct_{c}") for c in distinct_cols]
    for c in min_max_cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    aggs += [count_where(p).alias(n) for n, p in (flags or {}).items()]
    return df.agg(*aggs)


def value_counts(df: DataFrame, col: str, count_col: str = "count") -> DataFrame:
    """A2: frequency of each non-NULL value, most frequent first (ties by value)."""
    return (
        df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(count_col))
        .orderBy(F.col(count_col).desc(), F.col(col).asc())
    )


def value_share(df: DataFrame, col: str, decimals: int = 2, as_text: bool = True, share_col: str = "share") -> DataFrame:
    """A3 + P13: share of each non-NULL value in percent, optionally as text (``'35.65%'``, ``'20.5%'``).

    The denominator (non-NULL rows) is a scalar subquery over the aggregated
    counts, so no single-partition window is needed.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    total = counts.select(F.sum("_c")).scalar()
    share = F.round(F.col("_c") * 100.0 / total, decimals)
    out = counts.select(col, share.alias(share_col))
    if as_text:
        out = out.select(col, pct_text(F.col(share_col), decimals).alias(share_col))
    return out


def value_counts_multi(df: DataFrame, cols: Sequence[str], dropna: bool = False) -> DataFrame:
    """A4: value counts of several columns in one pass: (column_name, value, count).

    The columns are unpivoted to text; NULL is its own value unless ``dropna``.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column_name", "value")
    if dropna:
        long = long.where(F.col("value").isNotNull())
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))


# ---------------------------------------------------------------- A5-A7 (views)

def status_summary(
    df: DataFrame,
    group_cols: Sequence[str],
    status_col: str,
    statuses: Mapping[str, str],
    success_value: str,
    measure_col: str | None = None,
    extra_counts: Mapping[str, Column] | None = None,
    id_col: str | None = None,
    total_alias: str = "total_missions",
    rate_alias: str | None = "success_rate_pct",
    avg_alias: str | None = "avg_cost_usd_billion",
    sum_alias: str | None = "total_cost_usd_billion",
    decimals: int = 2,
    order_by: Sequence[Column] = (),
) -> DataFrame:
    """Grouped counts per status, guarded success rate, avg/total measure.

    ``statuses`` maps output alias -> status value; NULL group keys are kept.
    The success rate is ``round(100 * successes / NULLIF(total, 0), d)``.
    """
    total = F.count(F.col(id_col)) if id_col else F.count(F.lit(1))
    aggs = [total.cast("bigint").alias(total_alias)]
    aggs += [count_where(F.col(status_col) == F.lit(v)).alias(a) for a, v in statuses.items()]
    aggs += [count_where(p).alias(a) for a, p in (extra_counts or {}).items()]
    if rate_alias:
        aggs.append(count_where(F.col(status_col) == F.lit(success_value)).alias("_succ"))
    if measure_col and avg_alias:
        aggs.append(_avg(measure_col, decimals, df).alias(avg_alias))
    if measure_col and sum_alias:
        aggs.append(_round(F.sum(present_sum(measure_col, df)), decimals).cast("double").alias(sum_alias))
    out = df.groupBy(*group_cols).agg(*aggs)
    if rate_alias:
        out = out.withColumn(rate_alias, pct(F.col("_succ"), F.col(total_alias), decimals)).drop("_succ")
    if order_by:
        out = out.orderBy(*order_by)
    return out


# ---------------------------------------------------------------- A8-A11 (profiles)

def mode_by_group(df: DataFrame, group_cols: Sequence[str], col: str, alias: str, default: str | None = None) -> DataFrame:
    """Most frequent non-NULL value per group; ties -> smallest value.

    Two aggregates (counts per value, then the best count) instead of a
    per-group map, so a hot group is combined map-side like any other.
    ``default`` fills groups with no value (the profile's ``'Unknown'``).
    """
    keys = list(group_cols)
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_c"))
    best = counts.groupBy(*keys).agg(F.max("_c").alias("_best"))
    top = counts.join(best, keys, "inner").where(F.col("_c") == F.col("_best")).groupBy(*keys).agg(
        F.min(col).alias(alias)
    )
    allg = df.select(*keys).distinct()
    out = allg.join(top, [allg[k].eqNullSafe(top[k]) for k in keys], "left").select(
        *[allg[k] for k in keys], F.col(alias)
    )
    if default is not None:
        out = out.withColumn(alias, F.coalesce(F.col(alias), F.lit(default)))
    return out


def _mean_from(total: Column, count: Column, dtype: T.DataType) -> Column:
    """``avg`` rebuilt from a rolled-up sum and count, with Spark's result type.

    Decimals use ``avg``'s own arithmetic: the sum as ``decimal(p + 10, s)``
    divided by the count, cast to ``decimal(p + 4, s + 4)``; other numbers
    divide in double.
    """
    if isinstance(dtype, T.DecimalType):
        p, sc = dtype.precision, dtype.scale
        s10 = total.cast(f"decimal({min(38, p + 10)},{sc})")
        return F.try_divide(s10, count.cast("decimal(20,0)")).cast(f"decimal({min(38, p + 4)},{min(38, sc + 4)})")
    return F.try_divide(total.cast("double"), count.cast("double"))


def group_profile(
    df: DataFrame,
    group_col: str,
    status_col: str,
    statuses: Mapping[str, str],
    success_value: str,
    cost_col: str,
    duration_col: str,
    type_col: str,
    flag_counts: Mapping[str, Column] | None = None,
    id_col: str | None = None,
    min_total: int = 5,
    decimals: int = 2,
    rate_as_text: bool = True,
) -> DataFrame:
    """A8 (+F5, P12, P13): per-group profile as the notebook builds it.

    NULL group keys are dropped; the mean cost and duration are rounded, the
    total cost of a group with no cost is 0; the type is the group's mode
    (``'Unknown'`` if none); groups with ``total <= min_total`` are dropped;
    cost per success is NULL when there is no success.

    One pass over the data: everything is aggregated at (group, type) grain
    (counts, sums and non-NULL counts, all additive), then rolled up to the
    group. The mode comes from the same fine-grained counts.
    """
    base = _drop_null_keys(df, [group_col])
    dtypes = {f.name: f.dataType for f in base.schema.fields}
    total = F.count(F.col(id_col)) if id_col else F.count(F.lit(1))
    counts = {"total_missions": total}
    counts.update({a: count_where(F.col(status_col) == F.lit(v)) for a, v in statuses.items()})
    counts.update({a: count_where(p) for a, p in (flag_counts or {}).items()})
    counts["_succ"] = count_where(F.col(status_col) == F.lit(success_value))
    fine = base.groupBy(group_col, type_col).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[c.cast("bigint").alias(a) for a, c in counts.items()],
        F.sum(present_sum(cost_col, df)).alias("_cost_sum"), F.count(present_sum(cost_col, df)).alias("_cost_n"),
        F.sum(present_sum(duration_col, df)).alias("_dur_sum"), F.count(present_sum(duration_col, df)).alias("_dur_n"),
    )
    # The most frequent type, the smallest of ties; NULL types do not count.
    rank = F.when(F.col(type_col).isNotNull(), F.struct((-F.col("_rows")).alias("r"), F.col(type_col).alias("t")))
    prof = fine.groupBy(group_col).agg(
        F.min_by(F.col(type_col), rank).alias("_mode"),
        *[F.sum(a).cast("bigint").alias(a) for a in counts],
        F.sum("_cost_sum").alias("_cost_sum"), F.sum("_cost_n").alias("_cost_n"),
        F.sum("_dur_sum").alias("_dur_sum"), F.sum("_dur_n").alias("_dur_n"),
    ).where(F.col("total_missions") > min_total)
    cost_type = dtypes[cost_col]
    dur_type = dtypes[duration_col]
    prof = prof.select(
        group_col, "_mode", *[a for a in counts],
        _round(_mean_from(F.col("_cost_sum"), F.col("_cost_n"), cost_type), decimals).cast("double").alias("avg_cost_billion"),
        F.coalesce(F.col("_cost_sum"), F.lit(0)).cast("double").alias("total_cost_billion"),
        _round(_mean_from(F.col("_dur_sum"), F.col("_dur_n"), dur_type), decimals).cast("double").alias("avg_duration_days"),
    )
    prof = prof.withColumn(type_col, F.coalesce(F.col("_mode"), F.lit("Unknown"))).drop("_mode")
    rate = pct(F.col("_succ"), F.col("total_missions"), decimals)
    prof = prof.withColumn("success_rate", format_pct(rate, decimals) if rate_as_text else rate)
    prof = prof.withColumn(
        "cost_per_success", F.round(F.try_divide(F.col("total_cost_billion"), F.col("_succ").cast("double")), decimals)
    )
    return prof.drop("_succ")


def rate_profile(
    df: DataFrame,
    group_cols: Sequence[str],
    status_col: str,
    rates: Mapping[str, str],
    measure_col: str | None,
    counts: Mapping[str, Column] | None = None,
    shares: Mapping[str, str] | None = None,
    total_alias: str = "total_missions",
    avg_alias: str = "avg_cost_billion",
    decimals: int | None = 2,
    share_decimals: int | None = 1,
    order_by: Sequence[Column] = (),
    rate_decimals: int | None | str = "same",
    id_col: str | None = None,
) -> DataFrame:
    """Per-group count, rates and mean measure.

    Each rate is ``100 * count(status == value) / count(*)``: rows with a NULL
    status stay in the denominator, as the reference's boolean mean does.
    ``counts`` adds conditional counts and ``shares`` turns one of them into a
    percentage of the total (alias -> count alias). NULL group keys are
    dropped. ``decimals`` rounds the mean, ``rate_decimals`` the rates
    (``"same"``: like the mean; ``None``: unrounded); the total counts
    ``id_col`` when given (non-NULL ids), else rows.
    """
    rate_decimals = decimals if rate_decimals == "same" else rate_decimals
    base = _drop_null_keys(df, group_cols)
    total = F.count(F.col(id_col)) if id_col else F.count(F.lit(1))
    aggs = [total.cast("bigint").alias(total_alias)]
    for alias, value in rates.items():
        aggs.append(_round(
            count_where(F.col(status_col) == F.lit(value)).cast("double") * 100.0 / F.count(F.lit(1)), rate_decimals
        ).alias(alias))
    aggs += [count_where(p).alias(a) for a, p in (counts or {}).items()]
    if measure_col:
        aggs.append(_avg(measure_col, decimals, df).alias(avg_alias))
    out = base.groupBy(*group_cols).agg(*aggs)
    for alias, count_alias in (shares or {}).items():
        out = out.withColumn(alias, _round(F.col(count_alias).cast("double") * 100.0 / F.col(total_alias), share_decimals))
    if order_by:
        out = out.orderBy(*order_by)
    return out


# ---------------------------------------------------------------- A12-A17

def pivot_counts(df: DataFrame, row_col: str, col_col: str, values: Sequence | None = None) -> DataFrame:
    """Row x column counts, missing combinations 0.

    With ``values`` the pivot is one pass. Without, the (row, column) counts
    are aggregated once and staged (a small table), and both the column
    values and the pivot come from it, so the data is still read once.
    """
    base = _drop_null_keys(df, [row_col, col_col])
    if values is None:
        counts = stage_table(base.groupBy(row_col, col_col).agg(F.count(F.lit(1)).alias("_c")), "pivot")
        most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        values = [r[0] for r in counts.select(col_col).distinct().orderBy(col_col).limit(most + 1).collect()]
        if len(values) > most:
            raise ValueError(f"{col_col} has more than spark.sql.pivotMaxValues = {most} values")
        out = counts.groupBy(row_col).pivot(col_col, list(values)).agg(F.sum("_c"))
    else:
        out = base.groupBy(row_col).pivot(col_col, list(values)).agg(F.count(F.lit(1)))
    names = [str(v) for v in values]
    return out.na.fill(0, subset=names).select(row_col, *[F.col(n).cast("bigint").alias(n) for n in names])


def contingency(df: DataFrame, row_col: str, col_col: str, count_col: str = "observed") -> DataFrame:
    """Long-form contingency table; rows with a NULL on either side dropped."""
    return _drop_null_keys(df, [row_col, col_col]).groupBy(row_col, col_col).agg(
        F.count(F.lit(1)).alias(count_col)
    )


def group_median(df: DataFrame, group_col: str, value_col: str, alias: str = "median", exact: bool = True) -> DataFrame:
    """Median per group (NULL keys dropped, NULL values ignored), largest first.

    A group whose values are all NULL keeps a NULL median, sorted last.
    Exact and skew-safe by default; ``exact=False`` uses a sketch.
    """
    base = _drop_null_keys(df, [group_col])
    if exact:
        out = exact_quantiles(base, [group_col], value_col, [0.5], [alias], keep_empty=True)
    else:
        med = quantiles(base, [group_col], value_col, [0.5], [alias], exact=False)
        out = base.select(group_col).distinct().join(med, group_col, "left")
    return out.orderBy(F.col(alias).desc_nulls_last(), F.col(group_col))


def two_sample_overview(df: DataFrame, group_col: str, value_col: str, groups: Sequence[str]) -> DataFrame:
    """N, mean and exact median of ``value_col`` per sample (NULL values omitted)."""
    counted = counted_values(df.where(F.col(group_col).isin(list(groups)) & present(value_col).isNotNull()), [group_col], value_col)
    medians = counted.quantiles([0.5], ["median"])
    return medians.join(counted.moments(["mean"]), group_col).select(group_col, "n", "mean", "median")


def share_kpis(
    df: DataFrame,
    key_col: str,
    key_value: str,
    status_col: str,
    success_value: str,
    spend_col: str,
    segments: Mapping[str, Column],
    min_total: int = 5,
    id_col: str | None = None,
) -> DataFrame:
    """One row of share KPIs.

    * ``key_share_pct``: the key's rows (non-NULL ``id_col`` if given) over **all** rows,
    * ``key_spend_share_pct``: the key's spend over the groups of ``key_col`` with
      more than ``min_total`` rows (the profile's minimum-size filter); NULL if
      the key itself is not among them,
    * one success rate per named segment predicate (rows with a NULL status
      count in the denominator).

    One aggregate per key (rows, spend, and rows and successes of every
    segment, all additive) is rolled up to the KPIs, so ``df`` is read once.
    """
    ids = F.count(F.col(id_col)) if id_col else F.count(F.lit(1))
    success = F.col(status_col) == F.lit(success_value)
    parts = [F.count(F.lit(1)).alias("_rows"), ids.alias("_ids"), F.sum(present_sum(spend_col, df)).alias("_spend")]
    for i, pred in enumerate(segments.values()):
        p = F.coalesce(pred, F.lit(False))
        parts += [F.count_if(p).alias(f"_n{i}"), F.count_if(p & success).alias(f"_s{i}")]
    per_key = df.groupBy(key_col).agg(*parts)
    kept = F.col(key_col).isNotNull() & (F.col("_ids") > min_total)
    own = kept & (F.col(key_col) == F.lit(key_value))
    spend = F.coalesce(F.col("_spend"), F.lit(0)).cast("double")
    rates = [F.try_divide(F.sum(f"_s{i}").cast("double") * 100.0, F.sum(f"_n{i}").cast("double")).alias(n) for i, n in enumerate(segments)]
    return per_key.agg(
        (F.max(F.when(own, F.col("_ids"))).cast("double") * 100.0 / F.sum("_rows")).alias("key_share_pct"),
        F.try_divide(F.max(F.when(own, spend)) * 100.0, F.sum(F.when(kept, spend))).alias("key_spend_share_pct"),
        *rates,
    )


# ---------------------------------------------------------------- A18-A20

def long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numeric columns as (column_name, value double) rows, NaN as NULL. NULLs stay,
    so a column without any value is still described (count 0)."""
    return df.select(*[present(c).alias(c) for c in cols]).unpivot([], list(cols), "column_name", "value")


def describe_long(
    long: DataFrame,
    probs: Sequence[float] = (0.25, 0.5, 0.75, 0.90, 0.95, 0.99),
    decimals: int | None = 2,
    exact: bool = True,
) -> DataFrame:
    """A19 over a (column_name, value) frame, so several sources share one pass.

    Percentiles are exact (interpolated, skew-safe) unless ``exact=False``.
    """
    names = [f"p{int(round(p * 100))}" for p in probs]
    if exact:
        # Everything comes from the staged counted values: one pass over the input.
        counted = counted_values(long, ["column_name"], "value")
        out = counted.moments().join(counted.quantiles(probs, names).drop("n"), "column_name")
    else:
        basic = {"count": lambda v: F.count(v).cast("bigint"), "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
        stats_df = long.groupBy("column_name").agg(*[fn(present("value")).alias(n) for n, fn in basic.items()])
        out = stats_df.join(quantiles(long, ["column_name"], "value", probs, names, exact=False), "column_name", "left")
    stats = ["mean", "std", "min", *names, "max"]
    return out.select("column_name", "count", *[_round(F.col(s), decimals).alias(s) for s in stats])


def describe_percentiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float] = (0.25, 0.5, 0.75, 0.90, 0.95, 0.99),
    decimals: int | None = 2,
    exact: bool = True,
) -> DataFrame:
    """Count, mean, std, min, exact percentiles, max per numeric column.

    One row per column (``column_name``), also for columns of NULLs and of an
    empty table (count 0, else NULL). The columns are unpivoted so each becomes a
    group of the skew-safe exact quantile operator.
    """
    found = describe_long(long_values(df, cols), probs, decimals, exact)
    out = _column_names_frame(df.sparkSession, cols).join(found, "column_name", "left")
    return out.withColumn("count", F.coalesce(F.col("count"), F.lit(0)).cast("bigint"))


def _column_names_frame(spark, names: Sequence[str]) -> DataFrame:
    """The column names as a one-column frame (so all-NULL columns still get a row)."""
    return spark.createDataFrame([(n,) for n in names], "column_name string")


def describe_all(df: DataFrame, decimals: int | None = None) -> DataFrame:
    """Summary of every column, one row per column.

    Text columns get count, unique, top, freq (top ties -> smallest value);
    numeric columns count, mean, std, min, quartiles, max. Statistics that do
    not apply are NULL.
    """
    numeric_types = ("int", "bigint", "smallint", "tinyint", "double", "float")
    dtypes = dict(df.dtypes)
    num = [c for c in df.columns if dtypes[c] in numeric_types or dtypes[c].startswith("decimal")]
    text = [c for c in df.columns if c not in num]
    parts = []
    if text:
        # One frequency aggregate per (column, value) gives count, unique, top and freq.
        long = df.select(*[F.col(c).cast("string").alias(c) for c in text]).unpivot([], text, "column_name", "value")
        freq = long.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("_c"))
        per_col = freq.groupBy("column_name").agg(
            F.sum("_c").cast("bigint").alias("count"), F.count(F.lit(1)).cast("bigint").alias("unique"),
            F.max("_c").alias("freq"),
        )
        top = freq.join(per_col.select("column_name", "freq"), "column_name").where(F.col("_c") == F.col("freq")).groupBy(
            "column_name"
        ).agg(F.min("value").alias("top"))
        present = _column_names_frame(df.sparkSession, text)
        stats = present.join(per_col, "column_name", "left").join(top, "column_name", "left")
        parts.append(stats.select(
            "column_name", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
            F.coalesce(F.col("unique"), F.lit(0)).cast("bigint").alias("unique"), "top",
            F.col("freq").cast("bigint").alias("freq"),
            *[F.lit(None).cast("double").alias(s) for s in ("mean", "std", "min", "q25", "q50", "q75", "max")],
        ))
    if num:
        d = describe_percentiles(df, num, (0.25, 0.5, 0.75), decimals)
        parts.append(d.select(
            "column_name", "count", F.lit(None).cast("bigint").alias("unique"), F.lit(None).cast("string").alias("top"),
            F.lit(None).cast("bigint").alias("freq"), "mean", "std", "min",
            F.col("p25").alias("q25"), F.col("p50").alias("q50"), F.col("p75").alias("q75"), "max",
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def schema_report(df: DataFrame) -> DataFrame:
    """Column, Spark type and non-NULL count, in schema order."""
    cols = df.columns
    row = df.agg(*[F.count(F.col(c)).cast("bigint").alias(c) for c in cols])
    long = row.unpivot([], cols, "column_name", "non_null")
    types = F.create_map(*[x for c, t in df.dtypes for x in (F.lit(c), F.lit(t))])
    order = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
    return long.select(
        F.col("column_name"), types[F.col("column_name")].alias("dtype"), F.col("non_null").cast("bigint").alias("non_null"),
        order[F.col("column_name")].alias("position"),
    )


# ---------------------------------------------------------------- O1-O3

def sort_nulls_last(df: DataFrame, keys: Sequence[tuple[str, bool]]) -> DataFrame:
    """O1: ORDER BY with PostgreSQL NULL placement (NULLs last ascending, first descending).

    ``keys`` = [(column, ascending)].
    """
    return df.orderBy(*[F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_first() for c, asc in keys])


def top_n(df: DataFrame, order: Sequence[Column], n: int = 5) -> DataFrame:
    """O2: first ``n`` rows in a total order (distributed top-k, no global sort)."""
    return df.orderBy(*order).limit(n)


def row_by_key(df: DataFrame, predicate: Column, order: Sequence[Column] = ()) -> DataFrame:
    """O3: the first row satisfying ``predicate`` (ties by ``order``)."""
    f = df.where(predicate)
    return (f.orderBy(*order) if order else f).limit(1)
