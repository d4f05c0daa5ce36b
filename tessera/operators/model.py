"""Dimension, fact and bridge construction; key lookups; star joins.

D1  ``date_dimension``      observed dates of several columns, calendar attributes, ids
D2/D3 ``distinct_dimension`` distinct natural keys with ids in sorted-key order
D4  ``lookup_key`` + ``role_playing_keys`` + ``project``  fact build (configured in plans.missions)
D5  ``project``             metadata dimension
D6-D8 ``explode_list`` / ``bridge``  delimited text -> bridge rows with ids
D9  ``ranking.sequential_ids``  surrogate ids
D10 ``union_distinct`` / ``set_difference``
J1/J2 ``lookup_key``        single or composite (null-safe) key lookup
J3  ``role_playing_keys``   one date dimension joined for several roles
J4  ``inner_lookup``        inner fact-dimension join
J5/J6 ``star_join``         chained left joins to a wide, ordered view

Joins carry no broadcast hints unless the build side has a proven bound: AQE
measures the dimension at run time and switches to a broadcast hash join when
it is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; beyond that the
sort-merge join stays.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import calendar_columns, to_day
from ..functions.text import split_list
from .ranking import sequential_ids
from .staging import stage_table


# ---------------------------------------------------------------- dimensions

def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION (all) then DISTINCT, by column position."""
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out.distinct()


def set_difference(found: DataFrame, allowed: DataFrame) -> DataFrame:
    """Distinct rows of ``found`` not in ``allowed`` (``EXCEPT``)."""
    return found.subtract(allowed)


def date_dimension(
    df: DataFrame,
    date_cols: Sequence[str],
    id_col: str = "date_id",
    date_col: str = "full_date",
    num_partitions: int | None = None,
) -> DataFrame:
    """One row per distinct observed date over ``date_cols``.

    Dates are truncated to the day, NULLs dropped, ids 1..n in date order,
    with year, quarter, month, month_name, ISO week, day and decade.
    """
    days = union_distinct([df.select(to_day(F.col(c)).alias(date_col)) for c in date_cols]).where(
        F.col(date_col).isNotNull()
    )
    dim = days.select(F.col(date_col), *calendar_columns(F.col(date_col)))
    return sequential_ids(dim, [F.col(date_col)], id_col, num_partitions=num_partitions)


def distinct_dimension(
    df: DataFrame,
    cols: Sequence[str],
    id_col: str,
    rename: dict[str, str] | None = None,
    required: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """Distinct combinations of ``cols`` with ids 1..n.

    Rows with a NULL in any ``required`` column are dropped; NULLs elsewhere
    form their own combination. Ids follow the ascending sort of ``cols``
    (NULLs first), a total order, so a re-run on the same data gives the same
    keys.
    """
    d = df.select(*cols).distinct()
    if required:
        d = d.na.drop(how="any", subset=list(required))
    out = sequential_ids(d, [F.col(c).asc_nulls_first() for c in cols], id_col, num_partitions=num_partitions)
    for old, new in (rename or {}).items():
        out = out.withColumnRenamed(old, new)
    return out


def project(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """Column subset (meta dimension, fact projection)."""
    return df.select(*cols)


# ---------------------------------------------------------------- lookups

class DuplicateKeyError(ValueError):
    pass


def assert_unique(dim: DataFrame, keys: Sequence[str], null_safe: bool = False, sample: int = 5) -> None:
    """Fail when a lookup key maps to more than one dimension row.

    The reference's dictionary lookup raises on a duplicated key; a plain join
    would silently duplicate facts instead. The check is an aggregate over the
    dimension and brings back at most ``sample`` offending keys.
    """
    d = dim if null_safe else dim.na.drop(subset=list(keys))
    bad = d.groupBy(*keys).count().where("count > 1").limit(sample).collect()
    if bad:
        raise DuplicateKeyError(f"lookup key {list(keys)} is not unique: {[tuple(r) for r in bad]}")


def lookup_key(
    fact: DataFrame,
    dim: DataFrame,
    fact_keys: Sequence[str],
    dim_keys: Sequence[str],
    id_col: str,
    out_col: str | None = None,
    null_safe: bool = False,
    check_unique: bool = True,
) -> DataFrame:
    """Add ``out_col`` = the dimension id for each fact row (left join).

    A miss gives NULL. ``null_safe`` makes NULL match NULL (the composite
    vehicle/site lookup does). With ``check_unique`` the dimension keys are
    verified unique first so the join cannot fan out.
    """
    out_col = out_col or id_col
    if check_unique:
        assert_unique(dim, dim_keys, null_safe=null_safe)
    tags = [f"_lk{i}" for i in range(len(dim_keys))]
    right = dim.select(*[F.col(k).alias(t) for k, t in zip(dim_keys, tags)], F.col(id_col).alias(f"_lk_{out_col}"))
    conds = [
        (F.col(fk).eqNullSafe(F.col(t)) if null_safe else (F.col(fk) == F.col(t))) for fk, t in zip(fact_keys, tags)
    ]
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    joined = fact.join(right, cond, "left")
    return joined.drop(*tags).withColumnRenamed(f"_lk_{out_col}", out_col)


def role_playing_keys(
    fact: DataFrame,
    dim_date: DataFrame,
    roles: dict[str, str],
    id_col: str = "date_id",
    date_col: str = "full_date",
) -> DataFrame:
    """Look the same date dimension up once per role.

    ``roles`` maps output key column -> fact date/timestamp column; the fact
    value is truncated to the day; NULL dates give NULL keys.
    """
    out = fact
    for key_col, src in roles.items():
        day = f"_day_{key_col}"
        out = out.withColumn(day, to_day(F.col(src)))
        out = lookup_key(out, dim_date, [day], [date_col], id_col, key_col, check_unique=False).drop(day)
    return out


def inner_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Inner join fact -> dimension (rows with a NULL or unknown key drop)."""
    return fact.join(dim, fact[fact_key] == dim[dim_key], "inner")


@dataclass
class DimJoin:
    """One arm of a star join: ``fact.fk = dim.pk``, columns to take (alias -> dim column).

    ``large`` marks an arm of the fact's own size (a one-to-one extension of it)."""

    dim: DataFrame
    fact_key: str
    dim_key: str
    columns: dict[str, str] = field(default_factory=dict)
    large: bool = False


def star_join(
    fact: DataFrame,
    fact_columns: Sequence[str],
    arms: Sequence[DimJoin],
    order_by: Sequence[Column] = (),
) -> DataFrame:
    """Fact left-joined to each arm, aliased projection, optional order.

    Each arm is joined on its own key, so one dimension can appear several
    times (role-playing). Large arms are joined first, while the fact is still
    partitioned as it came (one shuffle for that key, none if the fact is already
    laid out by it); small dimensions follow as broadcast joins.

    With ``order_by`` the unsorted view is staged first. A global sort samples its
    input to cut its ranges, so it would run everything below it twice; like
    this it reads the staged file twice. End ``order_by`` with unique columns:
    equal keys (a hot date) cannot be split across tasks.
    """
    keys = list(dict.fromkeys(a.fact_key for a in arms if a.fact_key not in fact_columns))
    out = fact.select(*fact_columns, *keys)
    for i, arm in enumerate(sorted(arms, key=lambda a: not a.large)):
        tag = f"_k{i}"
        right = arm.dim.select(F.col(arm.dim_key).alias(tag), *[F.col(src).alias(al) for al, src in arm.columns.items()])
        out = out.join(right, out[arm.fact_key] == right[tag], "left").drop(tag)
    keep = list(fact_columns) + [al for arm in arms for al in arm.columns]
    out = out.select(*keep)
    if order_by:
        out = stage_table(out, "wide").orderBy(*order_by)
    return out


# ---------------------------------------------------------------- bridges

def explode_list(df: DataFrame, id_col: str, src_col: str, out_col: str, pattern: str = r",\s*") -> DataFrame:
    """One row per item of a delimited text column.

    Items are split on ``pattern``, stripped and empty ones dropped;
    duplicates are kept; NULL sources give no rows. Also returns the item
    position (``_pos``) so a stable id order exists.
    """
    return df.select(
        F.col(id_col), F.posexplode(split_list(F.col(src_col), pattern)).alias("_pos", out_col)
    )


def bridge(
    df: DataFrame,
    id_col: str,
    src_col: str,
    out_col: str,
    key_col: str = "id",
    pattern: str = r",\s*",
    num_partitions: int | None = None,
) -> DataFrame:
    """Bridge table ``(key_col, id_col, out_col)`` with serial ids.

    Ids follow (``id_col``, position in the list), the order in which the
    rows would have been appended; the item breaks the remaining ties (a
    repeated ``id_col``), so a re-run gives the same ids.
    """
    rows = explode_list(df, id_col, src_col, out_col, pattern)
    with_ids = sequential_ids(rows, [F.col(id_col), F.col("_pos"), F.col(out_col)], key_col, num_partitions=num_partitions)
    return with_ids.select(key_col, id_col, out_col)


def distinct_where(df: DataFrame, id_col: str, predicate: Column, alias: str = "n") -> DataFrame:
    """Number of distinct ``id_col`` among rows satisfying ``predicate``."""
    return df.agg(F.count_distinct(F.when(predicate, F.col(id_col))).alias(alias))
