"""Global and per-group positions without single-task windows.

``row_number() OVER (ORDER BY k)`` runs in one task, and
``row_number() OVER (PARTITION BY g ORDER BY v)`` puts a whole group in one
task: with a group holding a third of the rows that is the bottleneck. Here
the rows are range-partitioned on the sort key (Spark samples the key, so a hot
group is split over many partitions), sorted inside each partition and
staged in the shared checkpoint folder. Positions are then
``prefix count of earlier partitions + ordinal inside the partition``; the
prefix counts come from an aggregate with one row per (partition, group)
pair, which is at most #partitions + #groups rows.

The row ids are computed before the rows are staged (a parquet table in the
shared checkpoint folder, partitioned by range index) and stored with them, so
recomputing after a lost executor re-reads the same positions (ties in the
sort key are broken by the materialised order) and every plan built on top
stays deterministic. Later passes read only the columns they need, and the
fetch of a few ranked rows reads only the ranges that hold them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import stage_table

_SHIFT = 33  # monotonically_increasing_id = partition id << 33 | ordinal
_LOW = (1 << _SHIFT) - 1


def range_sorted(df: DataFrame, sort_cols: list[Column | str], num_partitions: int | None = None) -> DataFrame:
    """Range-partition and sort ``df``, stage it, and tag each row.

    Adds ``_pid`` (range index, in key order), ``_pos`` (0-based ordinal
    inside the range) and ``_rid`` (unique row id, ``_pid << 33 | _pos``).
    The ids are computed before staging and stored with the rows, so every
    later plan is deterministic and a lost executor re-reads the same ids.
    Without ``num_partitions`` the range count follows
    ``spark.sql.shuffle.partitions`` and AQE may coalesce adjacent small
    ranges (order is kept). The staged table is partitioned by ``_pid``.
    """
    if num_partitions:
        ordered = df.repartitionByRange(num_partitions, *sort_cols)
    else:
        ordered = df.repartitionByRange(*sort_cols)
    # The range index leads the in-partition sort: constant per task, it costs
    # nothing to compare, and it already satisfies the ordering the
    # partitioned writer needs, so the staged write adds no second sort.
    ordered = ordered.withColumn("_pid", F.spark_partition_id().cast("bigint"))
    tagged = ordered.sortWithinPartitions(F.col("_pid"), *sort_cols).withColumn("_rid", F.monotonically_increasing_id())
    staged = stage_table(tagged, "ranked", partition_by="_pid")
    return staged.withColumn("_pos", F.col("_rid").bitwiseAND(F.lit(_LOW)))


def sequential_ids(
    df: DataFrame,
    order_cols: list[Column | str],
    id_col: str = "id",
    start: int = 1,
    num_partitions: int | None = None,
    id_type: str = "bigint",
) -> DataFrame:
    """Dense ids ``start, start+1, ...`` in the total order of ``order_cols``.

    Equivalent to ``row_number() OVER (ORDER BY order_cols) + start - 1`` but
    spread over ``num_partitions`` tasks. The per-partition count table has
    one row per partition, so it is broadcast with a proven size bound.
    """
    tagged = range_sorted(df, order_cols, num_partitions)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    )
    out = tagged.join(F.broadcast(offsets), "_pid", "left")
    ident = (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_pos") + F.lit(start)).cast(id_type)
    return out.select(ident.alias(id_col), *[F.col(c) for c in df.columns])


def group_positions(
    df: DataFrame,
    group_cols: list[str],
    value_col: str,
    num_partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Per-group ascending positions of ``value_col``, skew-safe.

    Returns ``(rows, segments)``: ``rows`` is the staged, range-sorted input with
    ``_rid``/``_pid``/``_pos``; ``segments`` has one row per
    (partition, group): ``_pid``, group columns, ``_first`` (position of the
    group's first row in that partition), ``_cnt`` and ``_before`` (rows of
    the group in earlier partitions). A row's 0-based rank in its group is
    ``_before + _pos - _first``.
    """
    # A unique tie-breaker lets the range partitioner split a hot group even
    # when most of its values are equal (identical sort keys cannot be split).
    # The input is staged first: a written table is read back in a fixed split
    # and row order, so a re-run task hands out the same (row, id) pairs and
    # routes each row to the same range (an id taken in the order rows arrive
    # from a shuffle could change on a re-run). Staging also means the range
    # sampling re-reads the staged table, not an expensive upstream plan.
    data = stage_table(df, "positions-input").withColumn("_tb", F.monotonically_increasing_id())
    keys = [F.col(g).asc_nulls_first() for g in group_cols] + [F.col(value_col).asc_nulls_last(), F.col("_tb")]
    rows = range_sorted(data, keys, num_partitions)
    seg = rows.groupBy("_pid", *group_cols).agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_cnt")
    )
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.withColumn("_before", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    return rows, seg
