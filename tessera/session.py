"""Session helpers for scripts, tests and the bench.

Library functions never build a session; they take DataFrames. Only entry
points (tests, bench, the mission plan's CLI) call :func:`get_session`.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session gets unless the submitter already set them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Static settings for sessions this helper starts itself (local runs).
LOCAL_STATIC_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "tessera",
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    With ``master`` (tests, bench) the session is started here with all
    defaults. Without it (spark-submit on a cluster) the existing settings
    win: a default is applied only where the key is unset.
    ``spark.checkpoint.dir`` is left alone when set; only a local run without
    one gets a fresh scratch directory.
    """
    b = SparkSession.builder.appName(app_name)
    explicit = dict(extra or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master:
        b = b.master(master)
        for k, v in {**LOCAL_STATIC_CONF, **DEFAULT_CONF, **explicit}.items():
            b = b.config(k, v)
        spark = b.getOrCreate()
    else:
        spark = b.getOrCreate()
        for k, v in DEFAULT_CONF.items():
            if spark.conf.get(k, None) is None and not spark.sparkContext.getConf().contains(k):
                spark.conf.set(k, v)
        for k, v in explicit.items():
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...)
    and is used as is. A local run without the setting (tests, bench) gets a
    new scratch directory under the system temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared folder"
        )
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def cluster_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Suggested settings for a large run (pass as ``extra`` or to spark-submit).

    The initial shuffle partition count is sized so the biggest shuffle (at
    most the input) lands near ``partition_bytes`` per task, never below two
    waves of cores; AQE then coalesces small partitions to the same advisory
    size and splits skewed join partitions.
    """
    n = max(2 * total_cores, -(-input_bytes // partition_bytes))
    size = f"{partition_bytes >> 20}m"
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * (partition_bytes >> 20)}m",
        "spark.sql.files.maxPartitionBytes": size,
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def bench_cpus() -> int:
    return int(os.environ.get("BENCH_CPUS", "8"))
