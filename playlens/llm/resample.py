"""Importance resampling towards a target corpus, on hashed runs of words found by prefix CRCs.

A text is brought to one form in which each word follows one space, and scanned once, keeping the running
CRC-32 at the end of each word. The CRC of a run of words follows from two of them: CRC is linear over
GF(2), so the CRC of the bytes before the run, shifted over the run's length, cancels out of
the CRC at its end. So runs of any number of words cost a few table look-ups each and no second scan.

A run's bucket is its CRC modulo the number of buckets. Counts of the buckets in the corpus and in the
target give each bucket a gain, a document's weight is the sum over its runs, and Gumbel noise from a
hash of its number makes the highest scores a draw without replacement.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import bounded_batches, stored
from playlens.llm.ranking import placed

BUCKETS = 10_000
BLOCK = 1 << 20  # bytes split into words at a time
POLY = 0xEDB88320  # fixed value: the reflected CRC-32 polynomial


def _form_table() -> bytes:
    """Letters and digits of ASCII (A-Z lower-cased) and all other bytes from 0x80 stay; the rest separates."""
    keep = lambda b: b >= 0x80 or chr(b).isalnum()
    return bytes(ord(chr(b).lower()) if b < 0x80 and keep(b) else b if keep(b) else 0x20 for b in range(256))


FORM = _form_table()


def _byte_steps() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> np.uint32(1) ^ np.uint32(POLY), table >> np.uint32(1))
    return table


STEP = _byte_steps()


def _zero_shift() -> np.ndarray:
    """Look-up tables of the linear map of a CRC over one zero byte: 4 places x 256 values."""
    value = np.arange(256, dtype=np.uint32)
    tables = [value << np.uint32(8 * k) for k in range(4)]
    return np.stack([t >> np.uint32(8) ^ STEP[t & np.uint32(255)] for t in tables])


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    low = np.uint32(255)
    out = tables[0][crc & low]
    for k in range(1, 4):
        out = out ^ tables[k][crc >> np.uint32(8 * k) & low]
    return out


SHIFTS = [_zero_shift()]  # SHIFTS[k]: over 2**k zero bytes


def shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs moved over so many zero bytes, one doubling at a time."""
    out, k = crc.copy(), 0
    while (lengths >> k).any():
        if k == len(SHIFTS):
            SHIFTS.append(np.stack([_apply(SHIFTS[-1], t) for t in SHIFTS[-1]]))
        odd = (lengths >> k & 1).astype(bool)
        out[odd] = _apply(SHIFTS[k], out[odd])
        k += 1
    return out


def prefix_crcs(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The running CRC at the end of each word, and its offset, of a text's one form."""
    raw = text.encode().translate(FORM) if text else b""
    crcs, sizes, last, at = [], [], 0, 0
    while at < len(raw):
        end = len(raw) if at + BLOCK >= len(raw) else raw.rfind(b" ", at, at + BLOCK)
        if end < at:  # a word longer than a block
            end = raw.find(b" ", at + BLOCK)
            end = len(raw) if end < 0 else end
        words = [b" " + w for w in raw[at:end].split()]
        if words:
            found = list(accumulate(words, lambda crc, word: zlib.crc32(word, crc), initial=last))[1:]
            crcs.append(np.array(found, np.uint32))
            sizes.append(np.fromiter(map(len, words), np.int64, len(words)))
            last = found[-1]
        at = end + 1
    if not crcs:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    return np.concatenate(crcs), np.cumsum(np.concatenate(sizes))


def run_crcs(ends: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """CRC-32 of every run of ``size`` words joined by one space, from the CRCs at the words' ends."""
    if len(ends) < size:
        return np.empty(0, np.uint32)
    # The CRC before a word's first byte is that of the word before it, one space on.
    space, full = np.uint32(0x20), np.uint32(0xFFFFFFFF)
    before = np.r_[np.uint32(0), ends[:-1]] ^ full
    before = (before >> np.uint32(8) ^ STEP[(before ^ space) & np.uint32(255)]) ^ full
    starts = np.r_[0, offsets[:-1]] + 1
    count = len(ends) - size + 1
    lengths = offsets[size - 1 :] - starts[:count]
    return ends[size - 1 :] ^ shifted(before[:count], lengths)


def features(docs: DataFrame, low: int, high: int, buckets: int) -> DataFrame:
    """``(number, n_words, n_features, runs)``: each document's buckets, repeats included, as 32-bit numbers."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            words, counts, runs = [], [], []
            for text in rows.column("text").to_pylist():
                ends, offsets = prefix_crcs(text)
                found = [run_crcs(ends, offsets, size) for size in range(low, high + 1)]
                found = np.concatenate([np.empty(0, np.uint32), *found]) % np.uint32(buckets)
                words.append(len(ends))
                counts.append(len(found))
                runs.append(found.astype("<u4").tobytes())
            columns = [rows.column("number"), pa.array(words, pa.int64()), pa.array(counts, pa.int64()), pa.array(runs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["number", "n_words", "n_features", "runs"])

    return bounded_batches(docs).mapInArrow(scan, "number long, n_words long, n_features long, runs binary")


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs; a task sends one row for each bucket it holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for rows in batches:
            for runs in rows.column("runs"):
                total += np.bincount(np.frombuffer(runs.as_buffer(), "<u4"), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    sums = found.select("runs").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():  # a row for each bucket at most
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of how much likelier each bucket is in the target, rounded down."""
    buckets = len(source)
    ratio = (target + 1.0) * (float(source.sum()) + buckets) / ((source + 1.0) * (float(target.sum()) + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def resample(
    docs: DataFrame,
    target: DataFrame,
    low: int = 1,
    high: int = 1,
    buckets: int = BUCKETS,
    percent: int = 10,
    min_words: int = 20,
    seed: str = "2024",
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` for each row of ``docs(doc_id, text, …)``.

    Of the documents with at least ``min_words`` words, ``percent`` of a hundred (rounded down) are drawn: those
    of highest score, ties to the smaller number; ``rank`` counts them from 1 and is NULL for all others. ``target`` has a
    column ``text``. NULL and empty texts have no words and weight 0; very long texts are read
    whole, a block at a time. Repeated rows are documents of their own and come back alike but for their
    ranks; a NULL number is hashed as empty text and stands last among ties. Other columns are neither read nor
    returned. An empty table gives no rows; an empty target makes rare runs likelier than frequent ones.
    """
    own = features(docs.select(F.col("doc_id").cast("long").alias("number"), "text"), low, high, buckets)
    found = stored(own, "features")
    wanted = features(target.select(F.lit(None).cast("long").alias("number"), "text"), low, high, buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets))
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    @F.arrow_udf("long")
    def weight(runs: pa.Array) -> pa.Array:
        return pa.array([int(shared.value[np.frombuffer(r.as_buffer(), "<u4")].sum()) for r in runs], pa.int64())

    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("number").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = found.select("number", "n_words", "n_features", weight("runs").alias("weight"))
    scored = scored.select("number", "n_features", "weight", (F.col("weight") + noise).alias("score"),
                           (F.col("n_words") >= min_words).alias("may_"), F.monotonically_increasing_id().alias("row_"))
    scored = stored(scored, "scored")
    drawn = scored.where("may_").count() * percent // 100
    order = [F.col("may_").desc(), F.col("score").desc(), F.col("number").asc_nulls_last(), F.col("row_")]
    ranked = placed(scored, order, "place_")
    rank = F.when(F.col("place_") <= drawn, F.col("place_"))
    return ranked.select(F.col("number").alias("doc_id"), "n_features", "weight", "score", rank.alias("rank"))
