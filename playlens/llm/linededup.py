"""Repeated lines dropped by probing a sharded minimal perfect hash.

One pass counts the documents of every line key; keys found in enough documents go into
an index: per shard a minimal perfect hash (levels of bits without collisions, ranked
by population counts) and, in its order, compact arrays of fingerprints, document
counts and the document that keeps the line. A second pass over the documents probes
the arrays; no line is joined or moved.

The index is written to the shared folder and handed out in groups of shards of at
most ``INDEX_BYTES``. A larger index takes more passes, each over what the last one
wrote, so a task never holds more than one group.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.llm.common import bounded_batches, split_count, stored

# The white space that a key has stripped at both ends.
LINE_SPACE = " \t\n\x0b\x0c\r"
SHARD_KEYS = 1 << 16
INDEX_BYTES = 64 << 20
SPACING = 2.0
MAX_LEVELS = 40


def line_key(line: str, min_chars: int) -> bytes | None:
    """Key of a line as bytes, or None where it is too short to count."""
    if len(line) < min_chars:
        return None
    key = line.strip(LINE_SPACE)
    return key.encode().lower() if len(key) >= min_chars else None


def key_hashes(keys: list[bytes]) -> np.ndarray:
    """128 bits for each key: column 0 finds the slot, column 1 is the fingerprint."""
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join(map(digest, keys)), "<i8").reshape(-1, 2)


def _mixed(hashes: np.ndarray, level: int) -> np.ndarray:
    """Multipliers of a common 64-bit finaliser."""
    x = hashes.view(np.uint64) + np.uint64(((level + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit keys; other keys get any slot or -1."""

    def __init__(self, keys: np.ndarray):
        self.bits: list[np.ndarray] = []
        self.ranks: list[np.ndarray] = []
        self.sizes: list[int] = []
        rest, taken = keys, 0
        while len(rest) and len(self.sizes) < MAX_LEVELS:
            size = 64 * max(1, int(np.ceil(SPACING * len(rest) / 64)))
            place = (_mixed(rest, len(self.sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            words = np.packbits(alone, bitorder="little").view(np.uint64)
            ones = np.bitwise_count(words).astype(np.int64)
            self.bits.append(words)
            self.ranks.append(taken + np.cumsum(ones) - ones)
            self.sizes.append(size)
            taken += int(ones.sum())
            rest = rest[~alone[place]]
        self.last = np.sort(rest)  # keys no level could place: practically none
        self.taken = taken

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                return out
            place = _mixed(keys[open_], level) % np.uint64(size)
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            words = self.bits[level][word]
            hit = (words >> bit) & np.uint64(1) == 1
            below = words[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[open_[hit]] = self.ranks[level][word[hit]] + np.bitwise_count(below)
            open_ = open_[~hit]
        if len(open_) and len(self.last):
            at = np.minimum(np.searchsorted(self.last, keys[open_]), len(self.last) - 1)
            hit = self.last[at] == keys[open_]
            out[open_[hit]] = self.taken + at[hit]
        return out


class Shard:
    """One shard of the index: the hash and its arrays. ``keeper`` -2**63 is no document."""

    def __init__(self, hashes: np.ndarray, prints: np.ndarray, counts: np.ndarray, keepers: np.ndarray):
        self.hash = PerfectHash(np.unique(hashes))
        slots = self.hash.slots(hashes)
        # Two keys with the same first half share a slot: the arrays keep the slot's
        # first key, the others stand beside them.
        first = np.unique(slots, return_index=True)[1]
        self.prints, self.counts, self.keepers = prints[first], counts[first], keepers[first]
        more = np.setdiff1d(np.arange(len(slots)), first)
        self.more = {(int(hashes[i]), int(prints[i])): (int(counts[i]), int(keepers[i])) for i in more}

    def dump(self) -> bytes:
        """Plain arrays only, so that a task can read them without this module."""
        return pickle.dumps((vars(self.hash), {k: v for k, v in vars(self).items() if k != "hash"}))

    @classmethod
    def load(cls, blob: bytes) -> Shard:
        shard, shard_hash = cls.__new__(cls), PerfectHash.__new__(PerfectHash)
        of_hash, own = pickle.loads(blob)
        vars(shard_hash).update(of_hash)
        vars(shard).update(own, hash=shard_hash)
        return shard

    def probe(self, hashes: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts (0 if not in the index) and keepers."""
        counts, keepers = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        slots = self.hash.slots(hashes)
        hit = slots >= 0
        hit[hit] = self.prints[slots[hit]] == prints[hit]
        counts[hit], keepers[hit] = self.counts[slots[hit]], self.keepers[slots[hit]]
        if self.more:
            for i in np.flatnonzero(~hit):
                counts[i], keepers[i] = self.more.get((int(hashes[i]), int(prints[i])), (0, 0))
        return counts, keepers


NO_DOC = -(2**63)


def line_counts(docs: DataFrame, min_chars: int, by_number: bool = False) -> DataFrame:
    """``(h, print, n_docs, keeper)`` of every line key of ``docs(doc_id, text)``.

    ``by_number``: rows of one number are one document, rows without a number one each.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found, owner = [], []
            for i, text in enumerate(rows.column("text").to_pylist()):
                if text:
                    own = {line_key(x, min_chars) for x in text.split("\n")} - {None}
                    found += own
                    owner += [i] * len(own)
            hashes = key_hashes(found)
            ids = rows.column("doc_id").take(pa.array(owner, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), ids], ["h", "print", "doc_id"]
            )

    rows = docs.mapInArrow(keys, "h long, print long, doc_id long")
    if not by_number:
        return rows.groupBy("h", "print").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
    once = rows.groupBy("h", "print", "doc_id").agg(F.count("*").alias("n_"))
    n_docs = F.sum(F.when(F.col("doc_id").isNull(), F.col("n_")).otherwise(1)).alias("n_docs")
    return once.groupBy("h", "print").agg(n_docs, F.max("doc_id").alias("keeper"))


def build_index(counts: DataFrame, keys: int, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``(shard, bytes, blob)``: a dumped ``Shard`` for each of the shards of the keys."""
    shards = split_count(keys, shard_keys)

    def build(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
        columns = [rows.column(c).to_numpy() for c in ("h", "print", "n_docs")]
        keepers = rows.column("keeper").fill_null(NO_DOC).to_numpy()
        blob = Shard(*columns, keepers).dump()
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "bytes": [len(blob)], "blob": [blob]})

    numbered = counts.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    return numbered.groupBy("shard").applyInArrow(build, "shard int, bytes long, blob binary")


APPLIED = (
    T.StructType().add("text", T.StringType()).add("n_lines", T.LongType()).add("n_dropped", T.LongType())
)


def _applied(texts: pa.Array, states: list[bytes | None]) -> pa.StructArray:
    """Texts without the lines whose bits are set."""
    kept, total, dropped = [], [], []
    for text, state in zip(texts.to_pylist(), states):
        lines = text.split("\n") if text else [""]
        total.append(len(lines))
        if state:
            bits = np.unpackbits(np.frombuffer(state, np.uint8), count=len(lines)).tolist()
            lines = [line for line, bit in zip(lines, bits) if not bit]
            text = "\n".join(lines)
        kept.append(text)
        dropped.append(total[-1] - len(lines))
    return pa.StructArray.from_arrays(
        [pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(dropped, pa.int64())],
        ["text", "n_lines", "n_dropped"],
    )


def _probe(
    docs: DataFrame, state: str, group: dict[int, bytes], shards: int, min_docs: int, min_chars: int, last: bool
) -> DataFrame:
    """The state column with the positions of dropped lines added, as bits.

    The last pass drops the lines: its state is the kept text with the numbers of lines.
    """
    shared = docs.sparkSession.sparkContext.broadcast(group)

    @F.arrow_udf(APPLIED if last else T.BinaryType())
    def probed(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        index = {shard: Shard.load(blob) for shard, blob in shared.value.items()}
        for ids, texts, states in parts:
            keys, row, place, sizes = [], [], [], []
            for i, text in enumerate(texts.to_pylist()):
                lines = text.split("\n") if text else [""]
                sizes.append(len(lines))
                for j, line in enumerate(lines):
                    key = line_key(line, min_chars)
                    if key is not None:
                        keys.append(key)
                        row.append(i)
                        place.append(j)
            out = states.to_pylist()
            if keys:
                hashes, row, place = key_hashes(keys), np.array(row), np.array(place)
                owners = ids.fill_null(NO_DOC).to_numpy()[row]
                shard = (hashes[:, 0] % shards).astype(np.int64)
                drop = np.zeros(len(keys), bool)
                for number in np.unique(shard):
                    if number in index:
                        at = np.flatnonzero(shard == number)
                        counts, keepers = index[number].probe(hashes[at, 0], hashes[at, 1])
                        drop[at] = (counts >= min_docs) & (keepers != owners[at])
                hit = np.flatnonzero(drop)
                for i in np.unique(row[hit]):
                    bits = np.zeros(sizes[i], bool)
                    bits[place[hit[row[hit] == i]]] = True
                    new = np.packbits(bits)
                    old = np.frombuffer(out[i], np.uint8) if out[i] else np.zeros(len(new), np.uint8)
                    out[i] = (new | old).tobytes()
            yield _applied(texts, out) if last else pa.array(out, pa.binary())

    return docs.withColumn(state, probed("doc_id", "text", state))


def dedup_lines(
    docs: DataFrame,
    min_docs: int = 5,
    min_chars: int = 40,
    index_bytes: int = INDEX_BYTES,
    shard_keys: int = SHARD_KEYS,
    by_number: bool = False,
) -> DataFrame:
    """``docs(doc_id, text, …)`` with repeated lines dropped, plus ``n_lines``, ``n_dropped``.

    A line's key is the line without white space at its ends and with A-Z lower-cased.
    Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents lose
    their lines everywhere but in the largest ``doc_id`` that holds them. NULL and empty texts
    are one empty line and stay as they are; a text all of whose lines go becomes
    empty; very long texts are split whole. Repeated rows count as documents of their own, or with ``by_number`` as one document
    (rows without a number one each), and all rows of the keeping number keep the line. A row without a number keeps a line only if no holder has
    one. Other columns stay; ``n_lines`` and ``n_dropped`` replace columns so named. An
    empty table gives no rows.
    """
    plain = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = stored(line_counts(plain, min_chars, by_number).where(F.col("n_docs") >= min_docs), "lines")
    keys = counts.count()
    index = stored(build_index(counts, keys, shard_keys), "line-index")
    shards = split_count(keys, shard_keys)
    names = [c for c in docs.columns if c not in ("doc_id", "text", "n_lines", "n_dropped")]
    columns = ["doc_id", "text", *(f"c{i}" for i in range(len(names)))]
    out = docs.select("doc_id", "text", *(F.col(f"`{c}`").alias(a) for c, a in zip(names, columns[2:])))
    out = out.withColumn("state", F.lit(None).cast("binary"))
    groups, size = [[]], 0
    for row in index.select("shard", "bytes").orderBy("shard").toLocalIterator():
        if size and size + row["bytes"] > index_bytes:
            groups.append([])
            size = 0
        groups[-1].append(row["shard"])
        size += row["bytes"]
    for number, group in enumerate(groups):
        blobs = {}
        if group:
            wanted = index.where(F.col("shard").between(group[0], group[-1]))
            blobs = {r["shard"]: bytes(r["blob"]) for r in wanted.select("shard", "blob").collect()}
        out = stored(out, "lines-pass") if number else out
        out = _probe(out, "state", blobs, shards, min_docs, min_chars, last=number == len(groups) - 1)
    back = [F.col(a).alias(c) for c, a in zip(names, columns[2:])]
    return out.select("doc_id", F.col("state.text").alias("text"), *back, "state.n_lines", "state.n_dropped")
