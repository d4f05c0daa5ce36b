"""Cutting lineage with a written table in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import ensure_checkpoint_dir


def stage_table(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a parquet table under the shared checkpoint folder and read it back.

    This cuts the lineage like ``checkpoint()`` but keeps the data columnar:
    later passes read only the columns they use, and with ``partition_by``
    a filter or a dynamic-pruning join on that column reads only the
    matching directories. Tables live in ``<spark.checkpoint.dir>/tessera-stage``.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tessera-stage/{name}-{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
