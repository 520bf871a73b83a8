"""A bitmap that tells, before a shuffle, which rows of a table cannot be among some keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.session import scratch_dir

BITS_A_KEY = 16
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 26


class Sieve:
    """Bits of 64-bit hashes, about ``BITS_A_KEY`` for each up to ``MOST_BITS`` in all.

    The bits travel as rows of 64, so at most ``MOST_BITS`` / 64 rows are broadcast. Beyond that
    bound the sieve lets more rows through; rows of a listed hash always pass.
    """

    def __init__(self, hashes: DataFrame):
        """``hashes`` has one long column, which is read twice."""
        hashes, spark = hashes.toDF("hash_"), hashes.sparkSession
        count, self.bits = hashes.count(), LEAST_BITS
        while self.bits < min(MOST_BITS, BITS_A_KEY * count):
            self.bits *= 2
        bit = hashes.select(self._bit(F.col("hash_")).alias("bit")).withColumn("word_", F.shiftright("bit", 6))
        words = bit.groupBy("word_").agg(F.bit_or(F.expr("shiftleft(1L, bit & 63)")).alias("bits_"))
        path = scratch_dir(spark, "sieve")
        words.write.parquet(path)
        self.words = F.broadcast(spark.read.schema(words.schema).parquet(path))

    def _bit(self, hashed: Column) -> Column:
        return F.pmod(hashed, F.lit(self.bits)).cast("int")

    def _marked(self, rows: DataFrame, hashed: Column) -> DataFrame:
        own = rows.withColumn("bit_", self._bit(hashed))
        return own.join(self.words, F.shiftright("bit_", 6) == F.col("word_"), "left")

    def among(self, rows: DataFrame, hashed: Column) -> DataFrame:
        """Rows that may be among the hashes: all that are, and few others."""
        return self._marked(rows, hashed).where("bits_ & shiftleft(1L, bit_ & 63) <> 0").select(*rows.columns)

    def not_among(self, rows: DataFrame, hashed: Column) -> DataFrame:
        """The other rows, certain not to be among the hashes."""
        out = "bits_ IS NULL OR bits_ & shiftleft(1L, bit_ & 63) = 0"
        return self._marked(rows, hashed).where(out).select(*rows.columns)
