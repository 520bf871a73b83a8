"""Spelling variants: words one code point apart, found by PartEnum signatures of letter multisets.

A word is a binary vector with a dimension for each (segment, letter, how-manieth): the multisets of the letters in its
``SEGMENTS`` parts. An inserted or deleted code point changes one dimension, a replaced one two, and all of
them lie in one segment. So the vectors are partitioned by segment and every choice of all segments but
one is enumerated: words one edit apart agree exactly on the choice that leaves the edited segment out. The choice's
hash is a signature, signatures are joined for equality and each pair is verified by its edit distance.

Segments are cut by the length of the shorter word: each word has signatures for its own length, and
as the longer of two, with all after the segment left out one place further on. Lengths are part of the signature.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.llm.common import bounded_batches, stored

RUN = re.compile("[a-zÀ-ÿ]+")
SEGMENTS = 5
LONG = 64  # code points
HELD_WORDS = 200_000  # of a task, before they are sent on
# Odd multipliers (a common 64-bit mixer's).
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def word_counts(docs: DataFrame, min_length: int, every: int) -> DataFrame:
    """``(word, n)``: runs of letters with one code point deleted from those whose hash ``every`` divides."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for rows in batches:
            for number, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()):
                if not text:
                    continue
                start = zlib.crc32(f"{'' if number is None else number}:".encode())
                found = Counter(m.group() for m in RUN.finditer(text.encode().lower().decode()))
                for word, n in found.items():
                    if len(word) < min_length:
                        continue
                    h = zlib.crc32(word.encode(), start)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < min_length:
                            continue
                    held[word] += n
                if len(held) > HELD_WORDS:
                    yield out()
        yield out()

    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(MIX[1])
    x = (x ^ (x >> np.uint64(29))) * np.uint64(MIX[2])
    return x ^ (x >> np.uint64(32))


def signatures(words: list[str], segments: int = SEGMENTS) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of each word, as the shorter (or equal) and as the longer word of a pair: words x segments."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    sums = np.r_[np.uint64(0), np.cumsum(_mixed((points + np.uint64(1)) * np.uint64(MIX[0])))]
    begin = np.cumsum(lengths) - lengths
    factors = _mixed(np.arange(1, segments + 1, dtype=np.uint64) * np.uint64(MIX[0])) | np.uint64(1)

    def made(size: np.ndarray, later: int) -> np.ndarray:
        cuts = begin[:, None] + size[:, None] * np.arange(segments + 1) // segments
        plain = (sums[cuts[:, 1:]] - sums[cuts[:, :-1]]) * factors
        after = (sums[cuts[:, 1:] + later] - sums[cuts[:, :-1] + later]) * factors
        left = np.cumsum(plain, axis=1) - plain
        right = after.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(after, axis=1)
        place = size.astype(np.uint64)[:, None] * np.uint64(segments) + np.arange(segments, dtype=np.uint64)
        return _mixed(left + right + _mixed((place + np.uint64(1)) * np.uint64(MIX[1])))

    return made(lengths, 0), made(np.maximum(lengths - 1, 0), 1)


def _signature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        words = rows.column("word").to_pylist()
        if not words:
            continue
        size = np.fromiter(map(len, words), np.int64, len(words))
        short, long = signatures(words)
        of_word = np.repeat(np.arange(len(words)), SEGMENTS)
        grows = np.repeat(size > 0, SEGMENTS)
        index = pa.array(np.r_[of_word, of_word[grows]])
        sign = np.r_[short.ravel(), long.ravel()[grows]].view(np.int64)
        longer = np.r_[np.zeros(len(of_word), bool), np.ones(int(grows.sum()), bool)]
        columns = [pa.array(sign), pa.array(longer), rows.column("word").take(index), rows.column("n").take(index)]
        yield pa.RecordBatch.from_arrays(columns, ["signature", "longer", "word", "n"])


def one_edit_apart(a: str, b: str) -> bool:
    """Whether an inserted, deleted or replaced code point makes one the other."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    low, high = 0, min(len(a), len(b))  # the length of what both begin with, by halving
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return a[low + (len(a) >= len(b)) :] == b[low + (len(b) >= len(a)) :]


@F.arrow_udf(T.BooleanType())
def _one_edit(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([one_edit_apart(x.as_py(), y.as_py()) for x, y in zip(a, b)], pa.bool_())


def near_pairs(words: DataFrame) -> DataFrame:
    """``(word, n, other, other_n)``: each pair of ``words(word, n)`` one edit apart, in both directions.

    The built-in edit distance takes time with the square of a word's length, so words of more than
    ``LONG`` code points are compared in Python.
    """
    rows = words.mapInArrow(_signature_rows, "signature long, longer boolean, word string, n long")
    rows = stored(rows, "spelling-signatures")
    shorter = F.length("word") - F.col("longer").cast("int")
    found = []
    for part, test in ((shorter <= LONG, F.levenshtein("word", "other", 1) == 1), (shorter > LONG, _one_edit("word", "other"))):
        a = rows.where(part & ~F.col("longer")).select("signature", "word", "n")
        b = rows.where(part).select("signature", "longer", F.col("word").alias("other"), F.col("n").alias("other_n"))
        pairs = a.join(b, "signature").where(F.col("longer") | (F.col("word") < F.col("other")))
        found.append(pairs.where(test).select("word", "n", "other", "other_n"))
    # An insertion beside an equal letter is found in two segments.
    once = stored(found[0].union(found[1]).distinct(), "spelling-pairs")
    return once.union(once.select("other", "other_n", "word", "n"))


def spelling_variants(docs: DataFrame, min_length: int = 7, min_count: int = 2, ratio: int = 10, every: int = 31) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each word of ``docs(doc_id, text, …)``.

    Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) with only A-Z lower-cased; from a run whose CRC with
    its document's number ``every`` divides, one code point is deleted. They have ``min_length`` code points and
    ``min_count`` occurrences or more. ``form`` is the most frequent word one inserted, deleted or replaced code
    point away (ties: the least), if it is ``ratio`` times as frequent or more; ``root`` is where forms lead
    to. NULL and empty texts have no words, very long ones are read whole; repeated rows count
    again; a NULL number is empty text. Other columns are not read. No words, no rows.
    """
    words = stored(word_counts(docs, min_length, every).where(F.col("n") >= min_count), "spelling-words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= F.col("n") * ratio
    linked = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    linked = stored(linked, "spelling-forms")
    # Each step of a chain multiplies n by ``ratio``, so chains are short; each round halves them.
    chain = linked.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        ahead = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = chain.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        further = stored(further, "spelling-roots")
        chain = further.select("word", "root")
        if further.where("moved").isEmpty():
            break
    rooted = linked.join(chain, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
