"""Arrow tasks that can import this package on every executor."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()

#: Rows of an Arrow batch, unless the submitter has set their number: whole texts
#: are kilobytes each, and Spark's 10,000 of them would lie in a worker and beside
#: the heap of its executor at once.
BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _ship(spark: SparkSession) -> None:
    """Give the running application this package's sources and its default of
    ``BATCH_ROWS``, once. Spark's own file server hands the sources to executors,
    as with ``spark-submit --py-files``."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    to = Path(tempfile.mkdtemp(prefix="tessera-py-")) / "tessera-py.zip"
    with zipfile.ZipFile(to, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(to))
    if not sc.getConf().contains(_BATCH_CONF) and spark.conf.get(_BATCH_CONF) == "10000":
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))
    _shipped.add(sc.applicationId)


def _release() -> None:
    """Give freed memory back to the system. A worker process outlives its task and
    would keep the task's peak, which adds up beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with this package importable in its tasks."""
    _ship(df.sparkSession)

    def task(batches):
        try:
            yield from run(batches)
        finally:
            _release()

    return df.mapInArrow(task, schema)
