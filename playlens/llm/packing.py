"""Order-preserving packing of documents into windows by dynamic programming.

The documents form one stream in the order of their numbers. A window ends where a
document or a sentence ends. Cuts minimise padding plus a penalty for each document cut
in two: ``f[j] = penalty[j] + min(f[i] + window - (p[j] - p[i]))`` over the boundaries
``i`` within one window before ``j``. The term in ``i`` alone, ``f[i] + p[i]``, is kept in a
monotone queue, so each boundary is pushed and dropped once.

Spark deals the documents into ranges of numbers and sorts them; every range is one stream,
tokenised and cut block by block. The stretch after a block's last good cut starts the next
block, so blocks cost no padding and memory holds one block and one document.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import bounded_batches
from playlens.llm.tokens import Encoder

WINDOW = 2048
SENTENCE_PENALTY = 2
HARD_PENALTY = 6
LONGEST_RUN = 16  # tokens without a sentence end after which a cut is allowed at a price
BLOCK_TOKENS = 1 << 19
SEQUENCE_BITS = 40

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def sentence_ends(pieces: list[bytes]) -> np.ndarray:
    """Which token ids end a sentence or a line."""
    return np.array([p.rstrip(b" ").endswith((b".", b"!", b"?", b"\n")) and bool(p) for p in pieces], bool)


def boundaries(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions a window may end at, 0 first, and what a cut there costs."""
    kind = np.zeros(len(ids) + 1, np.int64)
    kind[1:][ends[ids]] = SENTENCE_PENALTY
    marked = kind > 0
    marked[0] = True
    marked[doc_ends] = True
    at = np.flatnonzero(marked)
    gaps = np.diff(at)
    long = np.flatnonzero(gaps > run)
    hard = [np.arange(at[i] + run, at[i + 1], run) for i in long.tolist()]
    if hard:
        marked[np.concatenate(hard)] = True
        kind[np.concatenate(hard)] = HARD_PENALTY
    kind[doc_ends] = 0
    at = np.flatnonzero(marked)
    return at, kind[at]


def best_cuts(at: np.ndarray, penalty: np.ndarray, window: int, last: bool) -> list[int]:
    """Indexes of the chosen boundaries, the first 0.

    The last cut is the final boundary if ``last``, else the best one within a window of it.
    """
    position, price = at.tolist(), penalty.tolist()
    cost, before = [0] * len(position), [0] * len(position)
    queue = deque([(0, 0)])  # (f[i] + p[i], i), rising
    for j in range(1, len(position)):
        here = position[j]
        while position[queue[0][1]] < here - window:
            queue.popleft()
        value, i = queue[0]
        before[j] = i
        cost[j] = own = value + window - here + price[j]
        own += here
        while queue and queue[-1][0] >= own:
            queue.pop()
        queue.append((own, j))
    end = len(position) - 1
    if not last:
        first = int(np.searchsorted(at, at[-1] - window, "right"))
        end = min(range(max(first, 1), len(position)), key=lambda j: (cost[j], -j))
    cuts = [end]
    while cuts[-1]:
        cuts.append(before[cuts[-1]])
    return cuts[::-1]


def powers(length: int) -> list[int]:
    """The length as falling powers of two: windows that need no padding."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


class _Stream:
    """Tokens of documents not yet packed."""

    def __init__(self, ends: np.ndarray, window: int, first_sequence: int):
        self.ends, self.window, self.sequence = ends, window, first_sequence
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple] = []  # (doc_id, all tokens, tokens before this stretch, tokens here)
        self.size = 0

    def add(self, doc_id, tokens: np.ndarray) -> None:
        self.ids.append(tokens)
        self.docs.append((doc_id, len(tokens), 0, len(tokens)))
        self.size += len(tokens)

    def pack(self, last: bool) -> pa.RecordBatch:
        ids = np.concatenate(self.ids)
        here = np.array([d[3] for d in self.docs])
        doc_ends = np.cumsum(here)
        at, penalty = boundaries(ids, doc_ends, self.ends, min(LONGEST_RUN, self.window))
        cuts = at[best_cuts(at, penalty, self.window, last)]
        if last:
            # The rest of the range is a window too short: cut so that it needs no padding.
            tail = cuts[-2] + np.cumsum(powers(int(cuts[-1] - cuts[-2])))
            cuts = np.concatenate((cuts[:-1], tail))
        end = int(cuts[-1])
        breaks = np.union1d(cuts, doc_ends[doc_ends < end])
        begin, length = breaks[:-1], np.diff(breaks)
        of_doc = np.searchsorted(doc_ends, begin, "right")
        of_window = np.searchsorted(cuts, begin, "right") - 1
        doc_starts = doc_ends - here
        skipped = np.array([d[2] for d in self.docs])
        totals = np.array([d[1] for d in self.docs])
        numbers = pa.array([d[0] for d in self.docs], pa.int64()).take(pa.array(of_doc))
        raw = pa.py_buffer(ids[:end].astype("<u4").tobytes())
        offsets = pa.py_buffer((breaks * 4).astype(np.int32).tobytes())
        out = pa.RecordBatch.from_arrays(
            [
                numbers,
                pa.array(begin - doc_starts[of_doc] + skipped[of_doc]),
                pa.array(length),
                pa.array(totals[of_doc]),
                pa.array(self.sequence + of_window),
                pa.array(begin - cuts[of_window]),
                pa.Array.from_buffers(pa.binary(), len(length), [None, offsets, raw]),
            ],
            ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
        )
        self.sequence += len(cuts) - 1
        rest = int(np.searchsorted(doc_ends, end, "right"))
        self.docs = self.docs[rest:]
        if self.docs:
            number, total, skip, held = self.docs[0]
            gone = end - int(doc_starts[rest])
            self.docs[0] = (number, total, skip + gone, held - gone)
        self.ids, self.size = [ids[end:]], len(ids) - end
        return out


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    block_tokens: int = BLOCK_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of documents in windows of at most ``window`` tokens.

    ``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``: ``ids`` are the
    piece's token ids as little-endian unsigned 32-bit numbers; each document's ids end
    with the end mark. NULL and empty texts have the end mark alone. Pieces of a window
    follow each other without gaps, in the order of document numbers (NULL first; equal
    numbers by text hash); repeated rows are packed each, very long texts in as many windows as they take. Windows are cut at document
    ends, else at sentence or line ends, else, in runs without any, every
    ``LONGEST_RUN`` tokens. The short rest of a range is cut into powers of two. Other
    columns are neither read nor returned; an empty table gives no rows.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        stream = _Stream(sentence_ends(encoder.pieces), window, TaskContext.get().partitionId() << SEQUENCE_BITS)
        for rows in batches:
            for number, text in zip(rows.column(0).to_pylist(), rows.column(1)):
                stream.add(number, encoder.document(text.as_py()))
                if stream.size >= block_tokens:
                    yield stream.pack(last=False)
        if stream.size:
            yield stream.pack(last=True)

    rows = bounded_batches(docs).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie")
    )
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return ordered.select("doc_id", "text").mapInArrow(pack, PIECES)
