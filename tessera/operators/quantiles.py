"""Exact, linearly interpolated quantiles per group, skew-safe.

Matches the default ("linear") method of pandas/numpy: for ``n`` values and
probability ``q`` the position is ``h = (n - 1) q`` and the result
``v[floor h] + (v[floor h + 1] - v[floor h]) (h - floor h)``; NULLs are
ignored.

Spark's exact ``percentile``/``median`` merge every distinct value of a group
in one task, which a hot group cannot afford. Here the selection runs on
*counted* values:

1. The input is aggregated to (group, value, count), combined map-side, so a
   value that a third of all rows share is one row from there on, and the
   input is read once.
2. The counted values are range-partitioned on (group, value). The key is
   unique, so Spark's sampled ranges can split any group, and no tie-breaking
   id and no staging of the input are needed. They are staged once.
3. Per (range, group), the summed counts give the ranks that a range holds. A
   needed rank is located in one of these segments, and only the located
   segments (a part of one range each) are walked by running counts.

Counts, means, deviations, fences and whiskers come from the staged counted
values as well (weighted by the counts), not from another pass over the input.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import present
from .lookup import lookup, staged_lookup
from .staging import stage_table


def _null_safe_on(left: DataFrame, right: DataFrame, cols: Sequence[str]):
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def approx_quantiles(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    accuracy: int = 10000,
) -> DataFrame:
    """Opt-in sketch quantiles (``percentile_approx``): one pass, bounded memory per group.

    Results are data values within ``1/accuracy`` rank error, not the
    interpolated exact quantiles; use when an exact answer isn't required.
    """
    names = list(names) if names is not None else [f"q{int(round(p * 100))}" for p in probs]
    q = F.percentile_approx(F.col(value_col).cast("double"), list(probs), accuracy)
    out = df.where(F.col(value_col).isNotNull()).groupBy(*group_cols).agg(q.alias("_q"))
    return out.select(*group_cols, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def quantiles(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    exact: bool = True,
) -> DataFrame:
    """Exact (default, skew-safe) or sketch quantiles with the same output shape."""
    if exact:
        return exact_quantiles(df, group_cols, value_col, probs, names)
    return approx_quantiles(df, group_cols, value_col, probs, names)


@dataclass
class CountedValues:
    """Counted values of one column per group, staged in ranges of (group, value).

    ``rows`` has the group columns, ``_v`` (double; NULL: rows of the group
    without a value), ``_c`` (how many rows have it) and ``_pid`` (the range).
    """

    rows: DataFrame
    group_cols: list[str]

    def sizes(self) -> DataFrame:
        """One row per group: ``n`` rows with a value (0 if there are none)."""
        n = F.sum(F.when(F.col("_v").isNotNull(), F.col("_c")).otherwise(0))
        return self.rows.groupBy(*self.group_cols).agg(n.cast("bigint").alias("n"))

    def moments(self, names: Sequence[str] = ("count", "mean", "std", "min", "max")) -> DataFrame:
        """One row per group: count, mean, sample deviation, least and greatest value.

        The deviation is summed around the mean in a second walk over the staged
        values; the means come back by a lookup of checked size.
        """
        v, c = F.col("_v"), F.col("_c")
        known = F.when(v.isNotNull(), c).otherwise(0)
        first = self.rows.groupBy(*self.group_cols).agg(
            F.sum(known).cast("bigint").alias("count"), F.try_divide(F.sum(v * c), F.sum(known)).alias("mean"),
            F.min(v).alias("min"), F.max(v).alias("max"))
        if "std" not in names:
            return first.select(*self.group_cols, *names)
        keys = [f"_k{i}" for i in range(len(self.group_cols))]
        means = staged_lookup(first.withColumnsRenamed(dict(zip(self.group_cols, keys))), "moments")
        match = F.lit(True)
        for g, k in zip(self.group_cols, keys):
            match = match & F.col(g).eqNullSafe(F.col(k))
        apart = (v - F.col("mean")) * (v - F.col("mean")) * c
        spread = self.rows.join(means, match).groupBy(*keys).agg(
            *[F.first(x).alias(x) for x in ("count", "mean", "min", "max")], F.sum(apart).alias("_s"))
        std = F.when(F.col("count") > 1, F.sqrt(F.col("_s") / (F.col("count") - 1)))
        return spread.withColumn("std", std).withColumnsRenamed(dict(zip(keys, self.group_cols))).select(*self.group_cols, *names)

    def at_ranks(self, ranks: DataFrame) -> DataFrame:
        """``ranks`` (group columns, ``_rank``, further columns) with ``_value``: the
        value at that 0-based rank of the group. Ranks beyond the group drop."""
        g = self.group_cols
        held = self.rows.where(F.col("_v").isNotNull())
        segments = held.groupBy("_pid", *g).agg(F.sum("_c").alias("_w"))
        earlier = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
        segments = segments.withColumn("_before", F.coalesce(F.sum("_w").over(earlier), F.lit(0)))
        located = ranks.join(segments, _null_safe_on(ranks, segments, g)).where(
            (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_w"))
        ).select(*[ranks[c] for c in ranks.columns], "_pid", "_before")
        # A segment lies within one range, so its running counts are the work of one range at most.
        needed = located.select("_pid", *g, "_before").distinct()
        walk = Window.partitionBy("_pid", *g).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
        inside = held.alias("r").join(needed.alias("s"), _null_safe_on_alias("r", "s", ["_pid", *g])).select(
            *[F.col(f"r.{c}").alias(c) for c in ["_pid", *g, "_v", "_c"]], "s._before")
        inside = inside.withColumn("_from", F.col("_before") + F.coalesce(F.sum("_c").over(walk), F.lit(0)))
        return located.alias("l").join(inside.alias("i"), _null_safe_on_alias("l", "i", ["_pid", *g]) & (
            F.col("l._rank") >= F.col("i._from")) & (F.col("l._rank") < F.col("i._from") + F.col("i._c"))).select(
            *[F.col(f"l.{c}").alias(c) for c in ranks.columns], F.col("i._v").alias("_value"))

    def quantiles(self, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
        """One row per group: group columns, ``names`` and ``n``; NULL in groups without a value."""
        g = self.group_cols
        sizes = self.sizes()
        wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
        need = sizes.select(*g, "n", F.explode(wanted).alias("_q")).where("n > 0").select(
            *g, F.col("_q.i").alias("_i"), ((F.col("n") - 1).cast("double") * F.col("_q.p")).alias("_h"), "n")
        low = F.floor("_h").cast("bigint")
        ends = F.array(F.struct(F.lit(False).alias("up"), low.alias("rank")), F.struct(F.lit(True).alias("up"), F.least(low + 1, F.col("n") - 1).alias("rank")))
        ranks = need.select(*g, "_i", "_h", F.explode(ends).alias("_e")).select(*g, "_i", "_h", F.col("_e.up").alias("_up"), F.col("_e.rank").alias("_rank"))
        found = self.at_ranks(ranks)
        columns = []
        for i, name in enumerate(names):
            at = lambda up, i=i: F.max(F.when((F.col("_i") == i) & (F.col("_up") == up), F.col("_value")))
            h = F.max(F.when(F.col("_i") == i, F.col("_h")))
            part = h - F.floor(h)
            columns.append(F.when(part == 0, at(False)).otherwise(at(False) + (at(True) - at(False)) * part).alias(name))
        wide = found.groupBy(*g).agg(*columns)
        return sizes.join(wide, _null_safe_on(sizes, wide, g), "left").select(*[sizes[c] for c in g], *names, "n")


def _null_safe_on_alias(left: str, right: str, cols: Sequence[str]):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


def counted_values(df: DataFrame, group_cols: Sequence[str], value_col: str, num_partitions: int | None = None) -> CountedValues:
    """Count the values of ``value_col`` (as double, NaN as NULL) per group and stage them in ranges."""
    g = list(group_cols)
    counts = df.select(*g, present(value_col).alias("_v")).groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c"))
    keys = [*[F.col(c).asc_nulls_first() for c in g], F.col("_v").asc_nulls_last()]
    ranged = counts.repartitionByRange(num_partitions, *keys) if num_partitions else counts.repartitionByRange(*keys)
    return CountedValues(stage_table(ranged.withColumn("_pid", F.spark_partition_id().cast("bigint")), "counted"), g)


def exact_quantiles(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    with_count: bool = False,
    num_partitions: int | None = None,
    keep_empty: bool = False,
) -> DataFrame:
    """One row per group: the ``probs`` quantiles of ``value_col``.

    Output columns are ``group_cols`` + ``names`` (default ``q25``-style names)
    [+ ``n`` with ``with_count``]. Groups whose values are all NULL (or NaN) are
    absent, or have NULLs with ``keep_empty``. Values are computed in double
    precision.
    """
    names = list(names) if names is not None else [f"q{int(round(p * 100))}" for p in probs]
    if not group_cols:  # all rows are one group
        df, group_cols = df.select(F.lit(0).alias("_g"), value_col), ["_g"]
    out = counted_values(df, group_cols, value_col, num_partitions).quantiles(probs, names)
    out = out if keep_empty else out.where("n > 0")
    return out.drop("_g", *([] if with_count else ["n"]))
