"""Repeated byte strings removed by prefix doubling over sampled positions.

The rank of a position is the name of the string of a given length that starts there. Names double
locally: that of 2n bytes is made of two names of n bytes at an offset of n, so names of any length need no
shuffle. Equality across documents does, and a sort of every position would move many times the
input. So positions are thinned out, and Spark sorts pairs of ranks at growing lengths:

* Of the strings of 36 bytes within a string of 100 bytes, the one of least name is its
  anchor. Equal strings have equal anchors at equal distances, so only anchors are sorted:
  one position in about 30. An anchor stands for a run of starts, those of the strings it is the
  anchor of, and carries a second rank: that of all bytes these strings cover.
* Spark sorts by the pair of ranks. Where the first is unique, no string repeats. Where a pair
  repeats, all strings of the run started earlier. What is left are runs with equal first and different
  second ranks, as at the edges of passages.
* Their runs are cut into runs of nine starts, which have 92 bytes in common; these give the first rank of the
  next round. The last round has single starts and ranks of 100 bytes, past the threshold.

The sorts are by ranges of rank pairs and places, so the positions of one frequent passage may spread over
many tasks. Documents with no candidates, as a bitmap of hashes tells, are not shuffled.

Documents are told apart by their numbers. Where some number, or none, stands beside several texts, all texts get
numbers of their own first, in the order of number and text hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.llm.common import bounded_batches, discard, stored
from playlens.llm.ranking import placed
from playlens.operators.sieve import Sieve

LENGTH = 100
GRAM = 36
CUTS = (9, 1)  # starts in a run in the rounds after the first
WINDOW = LENGTH - GRAM + 1
BLOCK = 1 << 20  # bytes ranked at a time
PLACE_BITS, RUN_BITS = 31, 7
SHIFT = 2 * RUN_BITS
RANK_MASK = np.uint64(0xFFFFFFFFFFFF0000)
# Odd multipliers of the doubling steps (a common 64-bit mixer's).
STEPS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def _joined(a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """Names of two strings in a row from their names."""
    out = a * np.uint64(step)
    out ^= out >> np.uint64(32)
    out += b
    out *= np.uint64(STEPS[1])
    out ^= out >> np.uint64(29)
    return out


def _byte_names() -> np.ndarray:
    return _joined(np.arange(1, 257, dtype=np.uint64), np.uint64(STEPS[2]), STEPS[0])


def names_of_16(raw: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Names of the 16-byte strings at each position."""
    name = table[raw]
    for step, size in zip(STEPS, (1, 2, 4, 8)):
        name = _joined(name[:-size], name[size:], step)
    return name


def named(of_16: np.ndarray, at: np.ndarray | None, length: int) -> np.ndarray:
    """Names of longer strings at some positions, or at all of them."""
    count = len(of_16) - length + 16
    name = of_16[:count] if at is None else of_16[at]
    for offset in (*range(16, length - 16, 16), length - 16):
        name = _joined(name, of_16[offset : offset + count] if at is None else of_16[at + offset], STEPS[3])
    return name


def _all_rank(of_16: np.ndarray, low: np.ndarray, high: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Names of all bytes that the strings of runs of starts cover, with the runs' places."""
    both = _joined(named(of_16, low, LENGTH), named(of_16, high, LENGTH), STEPS[0])
    return _joined(both, (most << RUN_BITS | least).astype(np.uint64), STEPS[2])


def _least(keys: np.ndarray, size: int) -> np.ndarray:
    """Least of each ``size`` keys in a row, by doubling."""
    done = 1
    while 2 * done <= size:
        keys = np.minimum(keys[:-done], keys[done:])
        done *= 2
    rest = size - done
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def anchors(raw: np.ndarray, ends: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, ...]:
    """(position, first start, last start, rank, rank of all bytes) within texts end to end.

    ``ends`` are the ends of the texts in ``raw``; no string crosses one.
    """
    of_16 = names_of_16(raw, table)
    of_gram = named(of_16, None, GRAM)
    # Name first, then position: the least key is the leftmost string of least name.
    keys = (of_gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(of_gram), dtype=np.uint64)
    place = (_least(keys, WINDOW) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    whole = np.ones(len(place) + LENGTH, bool)
    for end in ends[:-1].tolist():
        whole[max(0, end - LENGTH + 1) : end] = False
    starts = np.flatnonzero(whole[: len(place)])
    if not len(starts):
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    own = place[starts]
    new = np.r_[True, (np.diff(starts) != 1) | (np.diff(own) != 0)]
    first = np.flatnonzero(new)
    low, high, at = starts[first], starts[np.r_[first[1:], len(starts)] - 1], own[first]
    return at, low, high, of_gram[at], _all_rank(of_16, low, high, at - low, at - high)


def _blocks(lengths: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first text, last text + 1, first byte, first byte of the next block's starts) of blocks.

    Short texts share a block; a long text is cut into blocks of starts, with the byte
    range counted within it (last value -1: to its end).
    """
    at, count = 0, len(lengths)
    while at < count:
        if lengths[at] > BLOCK:
            for low in range(0, int(lengths[at]), BLOCK):
                yield at, at + 1, low, low + BLOCK if low + BLOCK < lengths[at] else -1
            at += 1
            continue
        end, size = at, 0
        while end < count and lengths[end] <= BLOCK and (end == at or size + lengths[end] <= BLOCK):
            size += lengths[end]
            end += 1
        yield at, end, 0, -1
        at = end


def _packed(place: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Place, and the most and least distance of a start before it."""
    return place << SHIFT | high << RUN_BITS | low


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _byte_names()
    for rows in batches:
        texts = [t.as_buffer() for t in rows.column("text").cast(pa.large_binary())]
        lengths = np.array([t.size if t is not None else 0 for t in texts], np.int64)
        used = np.flatnonzero(lengths >= LENGTH)
        texts, lengths = [texts[i] for i in used.tolist()], lengths[used]
        for a, b, low, high in _blocks(lengths):
            stop = high + LENGTH - 1 if high >= 0 else None
            raw = np.concatenate([np.frombuffer(t, np.uint8) for t in texts[a:b]])[low:stop]
            if len(raw) < LENGTH:
                continue
            ends = np.cumsum(lengths[a:b]) if b - a > 1 else np.array([len(raw)])
            at, first, last, rank, all_rank = anchors(raw, ends, table)
            text = np.searchsorted(ends, first, "right")
            begin = np.r_[0, ends[:-1]][text] - low
            place = _packed(at - begin, at - first, at - last)
            numbers = rows.column("doc_id").take(pa.array(used[a:b][text]))
            columns = [(rank & RANK_MASK).view(np.int64), all_rank.view(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns), numbers, pa.array(place)], ["rank", "all_rank", "doc_id", "at"]
            )


def _reranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated anchors of a stream sorted by rank pairs: ``late`` or still to be judged.

    Of a first rank with one second rank only, the earliest anchor needs no judging. Runs at the ends
    of the stream may go on in another task, so theirs is judged.
    """
    rank, all_rank, head = None, None, None  # of the row before; where its pair of ranks was first
    waiting = None  # the only second rank's earliest anchor, while it is the only one
    edge = True  # still in the stream's first run

    def out(rows: pa.RecordBatch, index: np.ndarray, late: bool) -> pa.RecordBatch:
        part = rows.take(pa.array(index))
        flags = pa.array(np.full(len(index), late))
        ranks = [part.column(c) if not late else pa.nulls(len(index), pa.int64()) for c in ("rank", "all_rank")]
        columns = [*ranks, part.column("doc_id"), part.column("at"), flags]
        return pa.RecordBatch.from_arrays(columns, ["rank", "all_rank", "doc_id", "at", "late"])

    for rows in batches:
        if not rows.num_rows:
            continue
        ranks, alls = rows.column("rank").to_numpy(), rows.column("all_rank").to_numpy()
        new_rank = np.r_[rank is None or ranks[0] != rank, ranks[1:] != ranks[:-1]]
        new_pair = new_rank | np.r_[all_rank is None or alls[0] != all_rank, alls[1:] != alls[:-1]]
        heads = np.flatnonzero(new_pair)
        # Rows at the very place of their pair's first row are that row again.
        ids = rows.column("doc_id")
        where = np.column_stack((ids.is_valid().to_numpy(False), ids.fill_null(0).to_numpy(), rows.column("at").to_numpy()))
        firsts = where[heads] if head is None or new_pair[0] else np.vstack((head, where[heads]))
        of_first = np.cumsum(new_pair) - (1 if head is None or new_pair[0] else 0)
        again = (where == firsts[of_first]).all(axis=1)
        head = firsts[-1]
        yield out(rows, np.flatnonzero(~new_pair & ~again), True)
        run = np.cumsum(new_rank)[heads]  # 0: the run of the batch before goes on
        counts = np.bincount(run, minlength=int(run[-1]) + 1 if len(run) else 1)
        if counts[0] and waiting is not None:
            yield waiting
            waiting = None
        if new_rank.any():
            if waiting is not None and edge:
                yield waiting
            waiting = None
        several = counts >= 2
        several[0] = True
        # Single heads of runs that end within this batch are done with.
        judged = heads[several[run]] if len(heads) else heads
        if rank is None and len(heads) and not several[1]:
            judged = np.r_[heads[:1], judged]  # the stream's first run
        yield out(rows, judged, False)
        last = int(new_rank.sum())
        if last:
            edge = rank is None and last == 1
            if not several[last]:
                waiting = None if rank is None and last == 1 else out(rows, heads[-1:], False)
        rank, all_rank = ranks[-1], alls[-1]
    if waiting is not None:
        yield waiting


def _cut_rows(width: int):
    """The runs of a document's open positions cut into runs of ``width`` starts.

    Cuts lie at multiples of ``width`` before the anchor, so equal strings fall into runs of equal
    place; the first rank names the bytes that all strings of a full run have in common.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, common = _byte_names(), LENGTH - width + 1
        for rows in batches:
            texts = [t.as_buffer() for t in rows.column("text").cast(pa.large_binary())]
            lengths = np.array([t.size for t in texts], np.int64)
            places = rows.column("places")
            packed, doc = places.flatten().to_numpy(), np.repeat(np.arange(len(texts)), np.diff(places.offsets))
            most, least = packed >> RUN_BITS & (1 << RUN_BITS) - 1, packed & (1 << RUN_BITS) - 1
            place = packed >> SHIFT & (1 << PLACE_BITS) - 1
            for a, b, low, high in _blocks(lengths):
                own = np.arange(*np.searchsorted(doc, (a, b)))
                own = own[(place[own] >= low) & (place[own] < (high if high >= 0 else 1 << PLACE_BITS))]
                if not len(own):
                    continue
                base = max(0, low - WINDOW)
                stop = high + LENGTH if high >= 0 else None
                raw = np.concatenate([np.frombuffer(t, np.uint8) for t in texts[a:b]])[base:stop]
                of_16 = names_of_16(raw, table)
                begin = np.cumsum(lengths[a:b]) - lengths[a:b] - base
                first = least[own] // width
                count = most[own] // width - first + 1
                own, first = np.repeat(own, count), np.repeat(first, count)
                run = first + np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
                top = np.minimum(most[own], run * width + width - 1)
                bottom = np.maximum(least[own], run * width)
                at = place[own] + begin[doc[own] - a]
                rank = _joined(named(of_16, at - run * width, common), run.astype(np.uint64), STEPS[4])
                columns = [
                    pa.array(rank.view(np.int64)),
                    pa.array(_all_rank(of_16, at - top, at - bottom, top, bottom).view(np.int64)),
                    rows.column("doc_id").take(pa.array(doc[own])),
                    pa.array(_packed(place[own], top, bottom)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["rank", "all_rank", "doc_id", "at"])

    return cut


RANKED = "rank long, all_rank long, doc_id long, at long"


def _sorted_ranks(ranked: DataFrame, label: str) -> DataFrame:
    order = ("rank", "all_rank", "doc_id", "at")
    ranked = stored(ranked, "ranks")  # a sort by ranges reads its input twice
    dealt = ranked.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(dealt.mapInArrow(_reranked, f"{RANKED}, late boolean"), label)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)``: what starts earlier elsewhere, as ``first << 8 | length`` numbers."""
    found = _sorted_ranks(docs.select("doc_id", "text").mapInArrow(_anchor_rows, RANKED), "anchors")
    same = F.col("d.doc_id").eqNullSafe(F.col("o.doc_id"))
    late = found.where("late").select("doc_id", "at")
    for width in CUTS:
        left = found.where("NOT late").groupBy("doc_id").agg(F.collect_set("at").alias("places"))
        left = stored(left, "open")
        held = Sieve(left.select(F.xxhash64("doc_id"))).among(docs, F.xxhash64("doc_id")).alias("d")
        texts = held.join(left.alias("o"), same).select("d.doc_id", "d.text", "o.places")
        found = _sorted_ranks(texts.mapInArrow(_cut_rows(width), RANKED), "runs")
        discard(left)
        late = late.union(found.where("late").select("doc_id", "at"))
    # What is open now are the first and last of each task, which may repeat across two tasks.
    ends = found.where("NOT late").drop("late")
    least = ends.groupBy("rank", "all_rank").agg(F.min(F.struct("doc_id", "at")).alias("first"))
    ends = ends.join(least, ["rank", "all_rank"]).where(F.struct("doc_id", "at") > F.col("first"))
    late = late.union(ends.select("doc_id", "at"))
    place = F.shiftright("at", SHIFT).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    run = F.lit((1 << RUN_BITS) - 1)
    most, fewest = F.shiftright("at", RUN_BITS).bitwiseAND(run), F.col("at").bitwiseAND(run)
    spans = late.select("doc_id", (F.shiftleft(place - most, 8) + most - fewest + LENGTH).alias("span"))
    return stored(spans.groupBy("doc_id").agg(F.collect_list("span").alias("spans")), "spans")


CUT = (
    T.StructType()
    .add("n_bytes", T.LongType())
    .add("n_removed", T.LongType())
    .add("n_spans", T.LongType())
    .add("kept", T.BinaryType())
)


@F.arrow_udf(CUT)
def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, found in zip(texts.cast(pa.large_binary()), spans):
        raw = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.empty(0, np.uint8)
        gone = np.zeros(len(raw) + 1, np.int64)
        if found.is_valid:
            packed = found.values.to_numpy()
            np.add.at(gone, packed >> 8, 1)
            np.add.at(gone, (packed >> 8) + (packed & 255), -1)
        hit = gone[:-1].cumsum() > 0
        edges = int(hit[:1].sum() + (hit[1:] & ~hit[:-1]).sum())
        out.append((len(raw), int(hit.sum()), edges, raw[~hit].tobytes()))
    columns = list(zip(*out)) or [(), (), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = ["n_bytes", "n_removed", "n_spans", "kept"]
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows(number, text)`` with ``doc_id``: the number, or one for each text where numbers have several."""
    hashed = F.xxhash64("text").alias("hash")
    texts = rows.select("number", hashed).groupBy("number").agg(F.min("hash").alias("a"), F.max("hash").alias("b"))
    if texts.where("a <> b").isEmpty():
        return rows.withColumn("doc_id", F.col("number"))
    keys = rows.select("number", hashed).distinct()
    order = [F.col("number").asc_nulls_first(), F.col("hash")]
    keys = placed(keys, order, "doc_id").select(F.col("number").alias("own"), F.col("hash").alias("key"), "doc_id")
    both = rows.withColumn("hash", hashed).join(keys, F.col("number").eqNullSafe(F.col("own")) & (F.col("hash") == F.col("key")))
    return stored(both.select("number", "text", "doc_id"), "numbered")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)`` for each row of ``docs``.

    A byte goes if a string of 100 bytes that covers it also starts earlier: in a document of
    smaller number, or earlier in the same one. Strings are judged on the input and never
    cross documents; ``kept`` are the remaining bytes. NULL texts count as empty, texts
    below 100 bytes stay whole, very long ones are ranked in blocks, and a NULL number is smaller than all
    others. Repeated rows of one number and text count as one document and come back alike; any number of
    different texts of one number, or of none, are documents in the order of a 64-bit hash. Other columns are neither
    read nor returned; an empty table gives no rows.
    """
    rows = bounded_batches(docs).select(F.col(id_col).cast("long").alias("number"), F.col(text_col).alias("text"))
    rows = _numbered(rows)
    spans = repeated_spans(rows)
    sieve, hashed = Sieve(spans.select(F.xxhash64("doc_id"))), F.xxhash64("doc_id")
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id"))
    judged = sieve.among(rows, hashed).alias("d").join(spans.alias("s"), same, "left").select("d.number", "d.text", "s.spans")
    judged = judged.withColumn("cut", _cut("text", "spans")).select(F.col("number").alias("doc_id"), "cut.*")
    size, none = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"), F.lit(0).cast("long")
    whole = sieve.not_among(rows, hashed).select(
        F.col("number").alias("doc_id"),
        size.alias("n_bytes"),
        none.alias("n_removed"),
        none.alias("n_spans"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("kept"),
    )
    return judged.union(whole)
