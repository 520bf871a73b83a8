"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a text are shares of byte classes and the shape and repetition of its
words and lines, computed on the whole text. The trees are fitted on the driver with numpy on a
bounded sample of labelled rows: values become bin numbers once, and each level of a
tree needs one histogram of gradients per node. A fitted model is three arrays; complete
trees of fixed depth lie in them as heaps, so a batch of documents walks all trees with
array operations only.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.llm.common import bounded_batches, held_out

TRAIN_ROWS = 20_000
TREES, DEPTH, BINS = 40, 4, 64
RATE, LEAST_HESSIAN, RIDGE = 0.2, 0.5, 1.0

# Byte classes whose shares are statistics.
CLASSES = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"abcdefghijklmnopqrstuvwxyz",
    b"0123456789",
    b" \t\r\x0b\x0c",
    b"\n",
    b".",
    b",;:",
    b"!?",
    b"|",
    b"#$%&*@^~=+_\\",
    b"<>{}[]()/",
    b"\"'`-",
    bytes(range(0x80, 0x100)),
)
FEATURES = len(CLASSES) + 10


def _class_matrix() -> np.ndarray:
    matrix = np.zeros((256, len(CLASSES)))
    for j, members in enumerate(CLASSES):
        matrix[list(members), j] = 1.0
    return matrix


def statistics(text: str | None, matrix: np.ndarray) -> np.ndarray:
    """The statistics of one text; all 0 for NULL and empty texts."""
    out = np.zeros(FEATURES)
    raw = text.encode() if text else b""
    if not raw:
        return out
    out[: len(CLASSES)] = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ matrix / len(raw)
    words, lines = raw.split(), raw.split(b"\n")
    count = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    kinds = set(words)
    upper, lower = out[0], out[1]
    out[len(CLASSES) :] = (
        np.log1p(len(raw)),
        np.log1p(len(words)),
        lengths.mean(),
        lengths.std(),
        len(kinds) / count,
        np.log1p(len(words) / max(1, len(kinds))),
        sum(map(eq, words, words[1:])) / count,
        len(set(lines)) / len(lines),
        len(raw) / len(lines) / (1 + len(raw) / len(lines)),
        upper / (upper + lower) if upper + lower else 0.0,
    )
    return out


def features(text: str | Column) -> Column:
    """Statistics of a text column as an array of doubles."""
    matrix = _class_matrix()

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def computed(texts: pa.Array) -> pa.Array:
        rows = [statistics(t, matrix) for t in texts.to_pylist()]
        flat = np.concatenate(rows) if rows else np.empty(0)
        offsets = np.arange(len(rows) + 1, dtype=np.int32) * FEATURES
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return computed(text)


class Forest(NamedTuple):
    """``feature`` and ``threshold``: trees x inner nodes; ``value``: trees x leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float


def _bins(x: np.ndarray) -> list[np.ndarray]:
    """Rising cut values for each column; a value's bin is the number of cuts below it."""
    shares = np.linspace(0, 1, BINS + 1)[1:-1]
    return [np.unique(np.quantile(column, shares)) for column in x.T]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosted trees for the chance that ``y`` is 1; without rows every chance is a half."""
    inner, leaves = (1 << DEPTH) - 1, 1 << DEPTH
    feature = np.zeros((TREES, inner), np.int64)
    threshold = np.full((TREES, inner), np.inf)
    value = np.zeros((TREES, leaves))
    mean = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(mean / (1 - mean)))
    if not len(y):
        return Forest(feature, threshold, value, base)
    cuts, columns = _bins(x), x.shape[1]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)], axis=1)
    flat = binned + np.arange(columns) * BINS
    margin = np.full(len(y), base)
    for tree in range(TREES):
        chance = _sigmoid(margin)
        gradient, hessian = chance - y, chance * (1 - chance)
        node = np.zeros(len(y), np.int64)  # within the level
        for level in range(DEPTH):
            nodes = 1 << level
            at = (node[:, None] * (columns * BINS) + flat).ravel()
            shape = (nodes, columns, BINS)
            size = nodes * columns * BINS
            g = np.bincount(at, np.repeat(gradient, columns), size).reshape(shape).cumsum(axis=2)
            h = np.bincount(at, np.repeat(hessian, columns), size).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            score = g**2 / (h + RIDGE) + (all_g - g) ** 2 / (all_h - h + RIDGE) - all_g**2 / (all_h + RIDGE)
            score[(h < LEAST_HESSIAN) | (all_h - h < LEAST_HESSIAN)] = 0
            best = score.reshape(nodes, -1).argmax(axis=1)
            gain = score.reshape(nodes, -1)[np.arange(nodes), best]
            column, cut = np.divmod(best, BINS)
            for n in range(nodes):
                if gain[n] > 1e-9 and cut[n] < len(cuts[column[n]]):
                    feature[tree, nodes - 1 + n] = column[n]
                    threshold[tree, nodes - 1 + n] = cuts[column[n]][cut[n]]
            own = nodes - 1 + node
            node = 2 * node + (x[np.arange(len(y)), feature[tree, own]] > threshold[tree, own])
        g, h = np.bincount(node, gradient, leaves), np.bincount(node, hessian, leaves)
        value[tree] = -RATE * g / (h + RIDGE)
        margin += value[tree, node]
    return Forest(feature, threshold, value, base)


def predict(forest: Forest, x: np.ndarray) -> np.ndarray:
    """Chances for a batch: all rows walk a tree level by level."""
    margin, rows = np.full(len(x), forest.base), np.arange(len(x))
    for feature, threshold, value in zip(forest.feature, forest.threshold, forest.value):
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
        margin += value[node - len(threshold)]
    return _sigmoid(margin)


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", rows: int = TRAIN_ROWS) -> Forest:
    """A forest from at most ``rows`` labelled documents that are not held out.

    The sample is the labelled rows of least hash, so it is the same on every run and
    its size does not grow with the table. Of a number with several texts the one of least hash
    is taken. Rows without a label or a number are left out.
    """
    known = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    sample = known.select(F.col("doc_id").alias("labelled_id"), F.col(target).cast("double").alias("label"))
    sample = sample.orderBy(F.xxhash64("labelled_id"), "labelled_id", "label").limit(rows)
    ids = sample.select("labelled_id").distinct()
    joined = bounded_batches(docs).join(F.broadcast(ids), docs.doc_id == ids.labelled_id)  # bounded by ``rows``
    least = joined.groupBy("labelled_id").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least"))
    single = least.select("labelled_id", features(F.col("least.text")).alias("features"))
    found = single.join(F.broadcast(sample), "labelled_id").select("labelled_id", "features", "label").collect()
    found.sort()
    x = np.array([r["features"] for r in found]).reshape(-1, FEATURES)
    return fit(x, np.array([r["label"] for r in found]))


def quality_scores(docs: DataFrame, forest: Forest, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher is better) and ``predicted`` (1 from ``threshold`` on).

    Only ``text`` is read for a score. NULL and empty texts are scored by statistics that
    are all 0. Very long texts are read whole. Repeated rows score alike; other columns stay, but for those named
    ``score`` or ``predicted``; an empty table gives no rows.
    """
    matrix = _class_matrix()
    arrays = tuple(forest)

    @F.arrow_udf("double")
    def scored(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Forest(*arrays)
        for texts in parts:
            rows = [statistics(t, matrix) for t in texts.to_pylist()]
            yield pa.array(predict(model, np.array(rows).reshape(-1, FEATURES)))

    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")]
    with_score = bounded_batches(docs).select(*rest, scored(F.col("text")).alias("score"))
    return with_score.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
