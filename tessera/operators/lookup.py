"""Map-side lookups in small tables whose size is measured, not assumed.

A table with one row per group (fences, histogram ranges, density grids) meets
the raw rows by the group key. Shuffling raw rows on a key of five values puts a
hot group into one task. So the small table is staged, its size is read from the
staged rows, and up to ``MOST_ROWS`` and ``MOST_BYTES`` it is broadcast, which
leaves the raw rows where they are; beyond that the two are joined, with the
same rows as result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import stage_table

#: A looked-up table of up to so many rows and so many bytes of text in them is broadcast.
MOST_ROWS = 100_000
MOST_BYTES = 16 << 20


def fits_broadcast(small: DataFrame) -> bool:
    """Whether a staged table is within ``MOST_ROWS`` and ``MOST_BYTES``."""
    texts = [F.octet_length(f.name).cast("bigint") for f in small.schema.fields if f.dataType.typeName() in ("string", "binary")]
    width = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(0).cast("bigint"))
    rows, size = small.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= MOST_ROWS and size <= MOST_BYTES


def staged_lookup(small: DataFrame, name: str = "lookup") -> DataFrame:
    """``small`` staged, with a broadcast hint if it is within the bounds."""
    small = stage_table(small, name)
    return F.broadcast(small) if fits_broadcast(small) else small


def lookup(rows: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` inner-joined to ``small`` (one row per key, see :func:`staged_lookup`) on ``keys``; NULL keys drop."""
    return rows.join(small, list(keys))
