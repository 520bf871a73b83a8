"""Token sequences written in training order as binary shards of fixed stride.

Documents become token sequences of one length. A keyed Feistel network permutes the
numbers 0 to n - 1: it is a permutation of the next power of four, and numbers that fall
outside are sent through it again until they fall inside (cycle walking). A sequence's slot is a
function of its number and the key, so nothing is sorted and no random state is kept.
Each shard holds a range of slots; slot s lies at byte ``(s % per_shard) * stride`` of shard
``s // per_shard``, so a run reads on from any step without an index.

The sequences are tokenised once and kept, compressed, in the shared folder; each shard
is then written by one task under a temporary name and renamed, so a task can be
repeated or run twice.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.llm.common import bounded_batches, split_count, stored
from playlens.llm.tokens import Encoder
from playlens.session import scratch_dir

LENGTH = 2048
PER_SHARD = 4096
PART_BYTES = 256 << 20  # of sequences a task writes, where the session's shuffle partitions would be larger
CHUNK = 64  # sequences compressed together
BUFFER = 2048  # sequences a task sorts by shard at a time
ROUNDS = 6
MANIFEST = (
    "sequence_id long, slot long, shard long, byte_offset long, n_tokens long, ids_crc32 long, path string"
)


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """Multipliers of a common 64-bit finaliser."""
    x = x + np.uint64(key)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _keys(key: int) -> list[int]:
    return [((key + 1) * 0x9E3779B97F4A7C15 * (r + 1)) % 2**64 for r in range(ROUNDS)]


def _network(x: np.ndarray, half: int, keys: list[int]) -> np.ndarray:
    mask, width = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> width, x & mask
    for k in keys:
        left, right = right, left ^ (_mixed(right, k) & mask)
    return right << width | left  # swapped, so that reversed keys undo it


def _half(count: int) -> int:
    return max(1, -(-(max(1, count - 1)).bit_length() // 2))


def permuted(numbers: np.ndarray, count: int, key: int, back: bool = False) -> np.ndarray:
    """Slots of sequence numbers below ``count``; numbers of slots if ``back``."""
    keys, half = _keys(key), _half(count)
    keys = keys[::-1] if back else keys
    x = _network(numbers.astype(np.uint64), half, keys)
    while (outside := np.flatnonzero(x >= np.uint64(count))).size:
        x[outside] = _network(x[outside], half, keys)
    return x.astype(np.int64)


def token_chunks(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """``(part, first, count, tokens, width, blob)``: compressed runs of sequences of each input split."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pack = Encoder(tokenizer), zstandard.ZstdCompressor(level=3)
        kind = np.dtype("<u2" if encoder.size <= 1 << 16 else "<u4")
        part, whole = TaskContext.get().partitionId(), CHUNK * length
        held, size, first = [], 0, 0

        def chunk(ids: np.ndarray) -> pa.RecordBatch:
            nonlocal first
            count = -(-len(ids) // length)
            values = ([part], [first], [count], [len(ids)], [kind.itemsize], [pack.compress(ids.tobytes())])
            first += count
            kinds = [pa.int64()] * 5 + [pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds)], ["part", "first", "count", "tokens", "width", "blob"]
            )

        for rows in batches:
            for text in rows.column(0):
                held.append(encoder.document(text.as_py()).astype(kind))
                size += len(held[-1])
                if size >= whole:
                    ids = np.concatenate(held)
                    end = size // whole * whole
                    for low in range(0, end, whole):
                        yield chunk(ids[low : low + whole])
                    held, size = [ids[end:]], size - end
        if size:
            yield chunk(np.concatenate(held))

    schema = "part long, first long, count long, tokens long, width long, blob binary"
    return bounded_batches(docs).select("text").mapInArrow(cut, schema)


def write_training_order(
    docs: DataFrame, tokenizer: str, key: int, path: str | None = None, length: int = LENGTH, per_shard: int = PER_SHARD
) -> DataFrame:
    """Writes the shards below ``path`` and returns the manifest, a row for each sequence.

    Documents (ids and an end mark; NULL and empty texts: the mark alone) follow each other in
    the order of the input splits and are cut every ``length`` ids; the last sequence of a
    split is short and filled up with 0, ``n_tokens`` says how far. Ids are stored as
    little-endian 16-bit numbers where the vocabulary fits, else 32-bit. ``ids_crc32`` is that of the
    sequence's bytes in the shard without the filling. Only ``text`` is read; repeated rows are written each, very long texts in as many sequences as they take;
    an empty table writes nothing. ``path`` must be a folder that all executors share (default: below
    ``spark.checkpoint.dir``).
    """
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "training-order")
    staged = stored(token_chunks(docs, tokenizer, length), "token-chunks")
    # One number for each input split.
    sums = staged.groupBy("part").agg(F.sum("count").alias("n"), F.max("width").alias("width")).collect()
    starts, total = {}, 0
    for r in sorted(sums):
        starts[r["part"]] = total
        total += r["n"]
    if not total:
        return spark.createDataFrame([], MANIFEST)
    shards = split_count(total, per_shard)
    kind = np.dtype(f"<u{sums[0]['width']}")
    by_size = split_count(total * length * kind.itemsize, PART_BYTES)
    parts = min(shards, max(by_size, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    shared = spark.sparkContext.broadcast(starts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        numbers, lengths, rows = [], [], []

        def sent() -> pa.RecordBatch:
            number, used, ids = np.concatenate(numbers), np.concatenate(lengths), np.concatenate(rows)
            slot = permuted(number, total, key)
            order = np.argsort(slot)
            cuts = np.flatnonzero(np.diff(slot[order] // per_shard)) + 1
            groups = np.split(order, cuts)
            shard = np.array([slot[g[0]] // per_shard for g in groups])
            columns = [
                pa.array(shard * parts // shards, pa.int32()),
                pa.array(shard),
                *(pa.array([v[g].tobytes() for g in groups], pa.binary()) for v in (number, slot, used)),
                pa.array([pack.compress(ids[g].tobytes()) for g in groups], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["target", "shard", "numbers", "slots", "lengths", "blob"])

        held = 0
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.zeros(r["count"] * length, kind)
                raw = unpack.decompress(r["blob"], max_output_size=r["tokens"] * kind.itemsize)
                ids[: r["tokens"]] = np.frombuffer(raw, kind)
                rows.append(ids.reshape(-1, length))
                numbers.append(shared.value[r["part"]] + r["first"] + np.arange(r["count"]))
                lengths.append(np.minimum(length, r["tokens"] - length * np.arange(r["count"])))
                held += r["count"]
                if held >= BUFFER:
                    yield sent()
                    numbers, lengths, rows, held = [], [], [], 0
        if held:
            yield sent()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        unpack = zstandard.ZstdDecompressor()
        files, root = FileSystem.from_uri(path)
        files.create_dir(root, recursive=True)
        stride = length * kind.itemsize

        def shard_written(shard: int, held: list[dict]) -> pa.RecordBatch:
            count = min(per_shard, total - shard * per_shard)
            content = np.zeros((count, length), kind)
            number, slot, used = (
                np.concatenate([np.frombuffer(r[c], np.int64) for r in held]) for c in ("numbers", "slots", "lengths")
            )
            low = 0
            for r in held:
                raw = unpack.decompress(r["blob"], max_output_size=len(r["slots"]) // 8 * stride)
                ids = np.frombuffer(raw, kind).reshape(-1, length)
                content[slot[low : low + len(ids)] - shard * per_shard] = ids
                low += len(ids)
            name = f"{root}/shard-{shard:08d}.bin"
            partial = f"{root}/_{shard:08d}-{TaskContext.get().taskAttemptId()}"
            with files.open_output_stream(partial) as out:
                out.write(content.tobytes())
            files.move(partial, name)
            at = slot - shard * per_shard
            sums = [zlib.crc32(content[i, :n].tobytes()) for i, n in zip(at.tolist(), used.tolist())]
            columns = [number, slot, np.full(len(slot), shard), at * stride, used, np.array(sums, np.int64)]
            arrays = [*map(pa.array, columns), pa.array([f"{path}/shard-{shard:08d}.bin"] * len(slot))]
            names = ["sequence_id", "slot", "shard", "byte_offset", "n_tokens", "ids_crc32", "path"]
            return pa.RecordBatch.from_arrays(arrays, names)

        shard, held = -1, []
        for batch in batches:
            for r in batch.to_pylist():
                if held and r["shard"] != shard:
                    yield shard_written(shard, held)
                    held = []
                shard = r["shard"]
                held.append(r)
        if held:
            yield shard_written(shard, held)

    schema = "target int, shard long, numbers binary, slots binary, lengths binary, blob binary"
    dealt = staged.mapInArrow(deal, schema).repartitionById(parts, "target").sortWithinPartitions("shard")
    return stored(dealt.drop("target").mapInArrow(write, MANIFEST), "manifest")


def read_slots(
    spark: SparkSession, path: str, first: int, last: int, width: int = 2, length: int = LENGTH, per_shard: int = PER_SHARD
) -> DataFrame:
    """``(slot, ids)`` of slots ``first`` to ``last`` - 1, read from their shards only."""
    shards = range(first // per_shard, max(first, last - 1) // per_shard + 1)
    files = spark.read.format("binaryFile").load([f"{path}/shard-{s:08d}.bin" for s in shards])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = np.frombuffer(content, f"<u{width}").reshape(-1, length)
                slots = int(name[-12:-4]) * per_shard + np.arange(len(rows))
                keep = np.flatnonzero((slots >= first) & (slots < last))
                ids = pa.array(rows[keep].astype(np.int64).tolist(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(slots[keep]), ids], ["slot", "ids"])

    return files.select("path", "content").mapInArrow(cut, "slot long, ids array<long>")
