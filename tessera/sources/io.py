"""Readers and SQL entry points.

S1 ``read_raw_csv``   header CSV scan, every column a string, split where quotes allow it, clear error if missing
S2 ``query``          parameterised SQL -> DataFrame, warns when empty
S3 ``table_scan``     whole-table scan of a catalog table or a parquet path
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Read one parquet table ``{base_dir}/{name}.parquet``.

    Column pruning and filter pushdown reach the scan through Catalyst, so
    callers select what they need after this call.
    """
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(jpath))


_CSV = {"header": True, "escape": '"', "emptyValue": "", "encoding": "UTF-8"}


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Header names of a CSV (one row of one file, parsed with the options of the scan)."""
    row = spark.read.options(**_CSV | {"header": False}).option("multiLine", True).csv(path).limit(1).first()
    if row is None:
        return []
    return [str(v) if v is not None else f"_c{i}" for i, v in enumerate(row)]


def csv_files_to_read_whole(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(splittable, whole): the files of a CSV, by whether a task may begin inside them.

    A quoted field that goes on in the next line leaves its first line with an odd
    number of quotes (a doubled quote counts twice). A file without such a line has
    no record over two lines, so any line begins one. Files with a lone carriage
    return or a line of blanks are read whole as well, as the two ways of reading
    differ on those. One scan of the text; one row per file comes back.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    whole = (quotes % 2 == 1) | value.rlike(r"\r(?!$)|^[ \t]+\r?$")
    found = lines.select(F.col("_metadata.file_path").alias("file"), whole.cast("int").alias("whole")).groupBy("file").agg(F.max("whole").alias("whole"))
    rows = found.collect()
    return sorted(r.file for r in rows if not r.whole), sorted(r.file for r in rows if r.whole)


def read_raw_csv(spark: SparkSession, path: str, columns: list[str] | None = None, splittable: bool | None = None) -> DataFrame:
    """Header CSV scan with every column typed as string.

    No type inference: inference would make a purely numeric text column a
    number and break the text parsers downstream. Values that the reference's
    reader treats as missing are nulled later by
    :func:`tessera.functions.text.null_if_sentinel`, which knows both the
    reader's tokens and the cleaning sentinels.

    ``columns`` gives the header names; when omitted they are read from the
    first line of one file (a one-row job), so the full scan still runs with an
    explicit schema. Every file's header is compared with them when it is read:
    other names, or the same in another order, fail the job.

    ``splittable`` says whether tasks may begin inside a file. ``True``: no field
    holds a line break, every file is split; ``False``: each file is one task;
    ``None``: a scan of the text finds out for each file
    (:func:`csv_files_to_read_whole`). The rows are the same in all three cases,
    if ``True`` is true.
    """
    if not _path_exists(spark, path):
        raise FileNotFoundError(f"CSV not found: {path}")
    names = columns if columns is not None else csv_header(spark, path)
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])

    def scan(paths, whole: bool) -> DataFrame:
        return spark.read.schema(schema).options(**_CSV).option("multiLine", whole).option("enforceSchema", False).csv(paths)

    if splittable is not None:
        return scan(path, not splittable)
    split, whole = csv_files_to_read_whole(spark, path)
    if not split or not whole:
        return scan(path, not split)
    return scan(split, False).unionByName(scan(whole, True))


def query(spark: SparkSession, sql: str, params: dict | None = None, warn_empty: bool = False) -> DataFrame:
    """Parameterised SQL (named markers ``:name``) returning a DataFrame.

    Errors surface at analysis time, as in the reference. The emptiness
    warning is opt-in because it costs a job (``isEmpty`` reads at most one
    row).
    """
    try:
        df = spark.sql(sql, args=params or None)
    except Exception:
        log.exception("query failed: %s", sql[:120])
        raise
    if warn_empty and df.isEmpty():
        log.warning("query returned 0 rows: %s", sql[:120])
    return df


def table_scan(spark: SparkSession, name_or_path: str) -> DataFrame:
    """S3: whole table, by catalog name or by parquet path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)
