"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import gc
import math
import re
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.session import scratch_dir

# crc32 of the decimal document number, modulo this, is 0 for held-out documents.
HELD_OUT_MODULUS = 5
BATCH_BYTES = 8 << 20
COLLECT_SECONDS = 20.0  # between two collections in the driver
FEW = 1 << 16  # rows of a few numbers each that one task groups
_collected = 0.0


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written as Parquet into the shared scratch folder and read again.

    Cuts the lineage: what follows survives lost executors without computing the
    written part again.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._written_to = path
    return written


def drop_shuffles(spark: SparkSession) -> None:
    """A collection in the driver, which lets Spark drop the shuffle files of plans that nobody holds any more."""
    global _collected
    gc.collect()
    spark._jvm.System.gc()
    _collected = time.monotonic()


def discard(*frames: DataFrame) -> None:
    """Deletes tables that ``stored`` wrote, once everything made from them is written itself.

    From time to time the shuffle files nobody needs any more go as well.
    """
    if time.monotonic() - _collected > COLLECT_SECONDS:
        drop_shuffles(frames[0].sparkSession)
    for df in frames:
        path = getattr(df, "_written_to", None)
        if path is not None:
            jvm, hadoop = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(hadoop).delete(place, True)


def gathered(df: DataFrame) -> DataFrame:
    """``df``, narrow rows of a stored table, in one task if they are ``FEW`` at most: grouping them shuffles nothing then."""
    return df.coalesce(1) if df.count() <= FEW else df


def reads(df: DataFrame, written: DataFrame) -> bool:
    """Whether ``df`` reads files of a table that ``stored`` wrote."""
    folder = written._written_to.rsplit("/", 1)[-1]
    return any(f"/{folder}/" in file for file in df.inputFiles())


def bounded_batches(df: DataFrame, most: int = BATCH_BYTES) -> DataFrame:
    """``df``, with Arrow batches of the session bounded by bytes.

    Rows hold whole texts, so a bound on rows alone would let a few long ones fill a
    Python worker. A smaller bound that the session already has stays.
    """
    conf = df.sparkSession.conf
    number, unit = re.match(r"(-?\d+)([kmgt]?)", conf.get("spark.sql.execution.arrow.maxBytesPerBatch").lower()).groups()
    size = int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]
    if not 0 < size <= most:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str | Column) -> Column:
    """Whether a document is kept out of all learning; FALSE where it has no number."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    text = column.cast("string").cast("binary")
    return F.coalesce(F.crc32(text) % HELD_OUT_MODULUS == 0, F.lit(False))


def split_count(rows: int, per_part: int) -> int:
    """Parts so that each has about ``per_part`` rows; at least one."""
    return max(1, math.ceil(rows / per_part))
