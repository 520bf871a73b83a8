"""Near-duplicate groups by SimHash fingerprints and deletion-variant signatures.

A fingerprint of 64 bits is cut into so few segments that, for two fingerprints at
most ``max_bits`` apart, one segment differs in one bit at most. Each segment is
indexed once per bit position with that bit as a wildcard; two such segments then share
a signature. Rows with equal signatures meet through one shuffle and are verified on
all 64 bits.

Distinct fingerprints are indexed, not documents, so a group of equal texts of any
size is one row. Within a signature a breadth-first search over the fingerprints not yet reached
gives a spanning forest of its links, never all pairs. A signature with more than
``RUN_LIMIT`` fingerprints is not held by one task: it is cut into blocks and each pair
of blocks is verified on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import bounded_batches, stored
from playlens.llm.components import connected_components

BITS = 64
SEED = 42
RUN_LIMIT = 1 << 17
VOTE_ROWS = 1 << 16


def text_fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint as an unsigned number; 0 for a text without words.

    Words are runs of bytes other than ASCII white space, with A-Z lower-cased. A text
    of fewer than ``shingle`` words is one shingle.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = len(words) - size + 1
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, np.int64)
    for low in range(0, count, VOTE_ROWS):
        high = min(count, low + VOTE_ROWS)
        spans = zip(starts[low:high].tolist(), ends[low + size - 1 : high + size - 1].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > count, bitorder="little").tobytes(), "little")


def fingerprint(text: str | Column, shingle: int = 3) -> Column:
    """SimHash of a text column as a (signed) long; NULL and empty texts have 0."""

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        found = [text_fingerprint(t, shingle) for t in texts.to_pylist()]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return simhash(text)


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the fewest segments of which one differs by one bit at most."""
    count = (max_bits + 2) // 2
    cuts = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def signatures(fingerprints: DataFrame, max_bits: int) -> DataFrame:
    """``(signature, fp)``: every segment once per wildcard position."""
    parts = []
    for first, width in _segments(max_bits):
        for bit in range(width):
            mask = ((1 << width) - 1) & ~(1 << bit)
            signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
            kept = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit(signed))
            wide = width > BITS // 2  # no room for the position beside the segment
            parts.append(F.xxhash64(F.lit(first + bit), kept) if wide else kept + F.lit((first + bit) << width))
    return fingerprints.select(F.explode(F.array(*parts)).alias("signature"), "fp")


def forest(fps: np.ndarray, max_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that span the components of a few fingerprints, found breadth first."""
    left, right = [], []
    rest = fps
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            near = np.bitwise_count(rest ^ node) <= max_bits
            if near.any():
                reached = rest[near]
                rest = rest[~near]
                left.append(np.full(len(reached), node))
                right.append(reached)
                queue.extend(reached)
    return left, right


def _links_of_runs(max_bits: int, run_limit: int):
    """Verifies runs of equal signatures in a sorted stream of (signature, fp)."""

    def batch(a, b, signature=None):
        known = pa.nulls(len(a), pa.int64()) if signature is None else pa.array(signature)
        arrays = [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), known]
        return pa.RecordBatch.from_arrays(arrays, ["a", "b", "signature"])

    def verified(fps: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        pairs = starts[sizes == 2]
        a, b = fps[pairs], fps[pairs + 1]
        near = np.bitwise_count(a ^ b) <= max_bits
        left, right = [a[near]], [b[near]]
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            more = forest(fps[start : start + size], max_bits)
            left += more[0]
            right += more[1]
        return batch(np.concatenate(left), np.concatenate(right))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        postponed = None  # the signature whose run outgrew the limit
        for rows in batches:
            signatures = np.concatenate((signatures, rows.column(0).to_numpy()))
            fps = np.concatenate((fps, rows.column(1).to_numpy().view(np.uint64)))
            if not len(signatures):
                continue
            cut = int(np.searchsorted(signatures, signatures[-1]))  # the last run may go on
            whole, done = signatures[:cut], fps[:cut]
            signatures, fps = signatures[cut:], fps[cut:]
            if postponed is not None and len(whole):
                end = int(np.searchsorted(whole, postponed, "right"))
                if end:
                    yield batch(done[:end], done[:end], whole[:end])
                whole, done = whole[end:], done[end:]
                postponed = None
            if len(whole):
                starts = np.flatnonzero(np.r_[True, whole[1:] != whole[:-1]])
                yield verified(done, starts, np.diff(np.r_[starts, len(whole)]))
            if postponed is not None or len(fps) > run_limit:
                postponed = signatures[-1]
                yield batch(fps, fps, signatures)
                signatures, fps = signatures[:0], fps[:0]
        if len(fps):
            if postponed is not None and signatures[-1] == postponed:
                yield batch(fps, fps, signatures)
            else:
                yield verified(fps, np.array([0]), np.array([len(fps)]))

    return verify


def _links_of_blocks(postponed: DataFrame, max_bits: int, run_limit: int) -> DataFrame:
    """Links of over-long runs: each pair of blocks of a signature is one small group."""
    counts = postponed.groupBy("signature").agg(
        F.ceil(F.count("*") * 2 / F.lit(run_limit)).cast("int").alias("blocks")
    )
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    rows = (
        postponed.join(counts, "signature")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("signature", "fp", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    )

    def verify(group: pa.Table) -> pa.Table:
        fps = np.unique(group.column("fp").to_numpy().view(np.uint64))
        left, right = forest(fps, max_bits)
        empty = np.empty(0, np.uint64)
        a, b = np.concatenate([empty, *left]), np.concatenate([empty, *right])
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return rows.groupBy("signature", "low", "high").applyInArrow(verify, "a long, b long")


def fingerprint_links(fingerprints: DataFrame, max_bits: int = 3, run_limit: int = RUN_LIMIT) -> DataFrame:
    """``(a, b)``: links that span the components of distinct fingerprints (column ``fp``)."""
    runs = signatures(fingerprints, max_bits).repartition("signature").sortWithinPartitions("signature")
    found = stored(
        runs.mapInArrow(_links_of_runs(max_bits, run_limit), "a long, b long, signature long"), "simhash-links"
    )
    links = found.where("signature IS NULL").select("a", "b")
    postponed = found.where("signature IS NOT NULL").select("signature", F.col("a").alias("fp"))
    if not postponed.isEmpty():
        links = links.union(_links_of_blocks(postponed, max_bits, run_limit))
    return links


def near_duplicates(
    docs: DataFrame, max_bits: int = 3, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, fp, component_id)`` for each row of ``docs``.

    ``component_id`` is the least number among all documents that links reach. NULL and
    empty texts have fingerprint 0 and are linked like any other. Repeated rows come
    back as often as they were given. A row without a number is linked like any other,
    but a component of such rows alone has a NULL ``component_id``. Other columns are
    neither read nor returned. Very long texts are read whole, their votes counted in blocks. An empty table
    gives no rows.
    """
    prints = stored(
        bounded_batches(docs).select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), shingle).alias("fp")), "simhash"
    )
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    links = fingerprint_links(nodes.select("fp"), max_bits)
    roots = stored(connected_components(links, "a", "b"), "simhash-roots")
    # Fingerprints without a link are their own component; no row is sent for them.
    linked = roots.join(nodes, roots.node == nodes.fp).select("fp", "root", "first_id")
    least = linked.groupBy("root").agg(F.min("first_id").alias("linked_id"))
    of_linked = linked.join(least, "root").select("fp", "linked_id")
    classes = nodes.join(of_linked, "fp", "left").select("fp", F.coalesce("linked_id", "first_id").alias("component_id"))
    # Written first, so that the last join is one that can split a hot fingerprint.
    classes = stored(classes, "simhash-classes")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def near_texts(texts: DataFrame, max_bits: int = 3, shingle: int = 3) -> DataFrame:
    """``(low, high, hub)``: pairs of keys that span the near-duplicate groups of ``texts(key, text)``.

    Equal keys are equal texts. Texts of one fingerprint are paired with the least key of it (the hub), and those
    keys along the links of the fingerprints, so copies of any number bring one pair each. NULL and empty
    texts have fingerprint 0, repeated rows count once; an empty table gives no rows.
    """
    prints = bounded_batches(texts).select("key", fingerprint("text", shingle).alias("fp"))
    prints = stored(prints.distinct(), "simhash-texts")
    nodes = stored(prints.groupBy("fp").agg(F.min("key").alias("first")), "simhash-nodes")
    equal = prints.join(nodes, "fp").where("key <> first").select("key", F.col("first").alias("hub"))
    links = fingerprint_links(nodes.select("fp"), max_bits)
    ends = nodes.select(F.col("fp").alias("b"), F.col("first").alias("key"))
    linked = links.distinct().join(nodes.withColumnRenamed("fp", "a"), "a").join(ends, "b").select("key", F.col("first").alias("hub"))
    pairs = equal.union(linked).where("key <> hub")
    return pairs.select(F.least("key", "hub").alias("low"), F.greatest("key", "hub").alias("high"), "hub")
