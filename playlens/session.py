"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Skewed joins and oversized write partitions are split at run time; the size of
# shuffle partitions follows the data instead of a fixed count.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM never compiles methods beyond 8000 bytes; wide projections then run
    # faster as split methods than as one whole-stage method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: int | str = 8, partitions: int = 8, name: str = "playlens") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Recording the Python call site of every column costs more than the column.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_scratch: str | None = None


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for written tables, below ``spark.checkpoint.dir``.

    Executors must all see it, so a cluster has to name the shared folder. Only a
    local session, where driver and executors share one disk, may fall back to a
    temporary folder.
    """
    global _local_scratch
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="playlens-")
            atexit.register(shutil.rmtree, _local_scratch, ignore_errors=True)
        root = _local_scratch
    return f"{root.rstrip('/')}/playlens/{label}-{uuid.uuid4().hex}"
