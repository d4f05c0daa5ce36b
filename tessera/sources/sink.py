"""Full-refresh sink for a set of related tables.

The reference empties every table first and then appends, so a failed load
leaves the warehouse empty. Here a refresh writes every table into a version
folder of its own, the caller's gate runs on what was actually written, and
one file is created at the end: the commit. Readers take the version of the
greatest commit, so all tables switch at once. A run that dies anywhere before
the commit leaves the former version as it was; nothing is renamed, so this
holds on object stores too, where renames copy. Writes are ordinary parallel
task writes; a lost executor only re-runs its tasks.

``root/v<number>-<run>/<table>`` holds a version,
``root/_commits/<number>-<run>`` (an empty file) makes it readable.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from .schema import LOAD_ORDER

log = logging.getLogger(__name__)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the committed versions under ``root``, oldest first."""
    fs, jvm = _fs(spark, root)
    commits = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/_commits")
    if not fs.exists(commits):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(commits))


def refresh_tables(
    tables: Mapping[str, DataFrame],
    root: str,
    order: list[str] | None = None,
    gate: Callable[[Mapping[str, DataFrame]], None] | None = None,
    fmt: str = "parquet",
    partition_by: Mapping[str, list[str]] | None = None,
    keep: int = 2,
) -> dict[str, str]:
    """Write ``tables`` as the next version under ``root``. Returns name -> path.

    ``gate`` receives the written tables (read back from storage) and raises to
    refuse them; the version is then deleted and the former one stays. The last
    ``keep`` versions stay readable by path (at least one), older ones are
    deleted after the commit. Of two refreshes at the same time the one with the
    greater name wins as a whole.
    """
    order = [n for n in (order or LOAD_ORDER) if n in tables] + [n for n in tables if n not in (order or LOAD_ORDER)]
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    root = root.rstrip("/")
    fs, jvm = _fs(spark, root)
    Path = jvm.org.apache.hadoop.fs.Path
    committed = versions(spark, root)
    number = int(committed[-1].split("-")[0]) + 1 if committed else 1
    version = f"{number:010d}-{uuid.uuid4().hex[:12]}"
    paths = {name: f"{root}/v{version}/{name}" for name in order}
    partition_by = partition_by or {}
    try:
        for name in order:
            w = tables[name].write.mode("errorifexists").format(fmt)
            if partition_by.get(name):
                w = w.partitionBy(*partition_by[name])
            w.save(paths[name])
            log.info("written %s", name)
        if gate is not None:
            gate({name: spark.read.format(fmt).load(path) for name, path in paths.items()})
    except BaseException:
        fs.delete(Path(f"{root}/v{version}"), True)
        raise
    fs.create(Path(f"{root}/_commits/{version}"), False).close()
    for old in [*committed, version][: -max(1, keep)]:
        fs.delete(Path(f"{root}/_commits/{old}"), False)
        fs.delete(Path(f"{root}/v{old}"), True)
    return paths


def table_paths(spark: SparkSession, root: str, names: Sequence[str]) -> dict[str, str]:
    """Paths of the tables in the last committed version. Resolve once and read
    all tables by these paths, so that they belong together."""
    committed = versions(spark, root)
    if not committed:
        raise FileNotFoundError(f"no committed version under {root}")
    return {n: f"{root.rstrip('/')}/v{committed[-1]}/{n}" for n in names}


def read_tables(spark: SparkSession, root: str, names: Sequence[str], fmt: str = "parquet") -> dict[str, DataFrame]:
    return {n: spark.read.format(fmt).load(path) for n, path in table_paths(spark, root, names).items()}


def create_views(spark: SparkSession, views: Mapping[str, str], database: str | None = None) -> list[str]:
    """Create (or replace) catalog views from SQL texts. Returns their qualified names."""
    prefix = f"`{database}`." if database else ""
    for name, sql in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}`{name}` AS {sql}")
    return [f"{prefix}`{name}`" for name in views]


def write_bucketed(
    df: DataFrame,
    table: str,
    keys: list[str],
    buckets: int,
    sort: bool = True,
    fmt: str = "parquet",
) -> DataFrame:
    """Write ``df`` as a catalog table bucketed (and sorted) by ``keys``.

    Two fact-sized tables written with the same keys and bucket count (the
    fact and the mission meta dimension) join bucket-to-bucket: the planner
    reads each bucket pair in one task and inserts no exchange. The table
    lives under ``spark.sql.warehouse.dir``; returns it read back.
    """
    w = df.write.mode("overwrite").format(fmt).bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(table)
    return df.sparkSession.table(table)
