"""Language identification with a byte convolutional network.

Filters of several widths run over windows of bytes; each filter's maximum over a window,
through a ReLU, goes into a softmax over the languages. A filter on one-hot bytes is a table
with a value for each byte at each place, so a convolution is a sum of look-ups; for
prediction the tables of two neighbouring places are added up to one over byte pairs.

The network is trained in numpy on the driver, on a bounded number of documents of each
language. Every window of a text is judged and the mean of their chances decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from playlens.llm.common import bounded_batches, held_out, stored

TRAIN_ROWS = 600  # documents of each language
TRAIN_TOTAL = 60_000  # documents of all languages, and languages, at most
TRAIN_WINDOWS = 8  # windows of each such document, evenly spread
WIDTHS, FILTERS, WINDOW = (2, 3, 4), 16, 256
STEPS, BATCH, RATE, DECAY = 240, 128, 0.02, 1e-4
CHUNK = 128
OVERSAMPLE = 8
UNKNOWN = "und"


def windows(text: str) -> np.ndarray:
    """All bytes of a text as rows of ``WINDOW`` bytes, the last one filled up with 0."""
    raw = np.frombuffer(text.encode(), np.uint8)
    rows = np.zeros((max(1, -(-len(raw) // WINDOW)), WINDOW), np.uint8)
    rows.ravel()[: len(raw)] = raw
    return rows


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


class Network(NamedTuple):
    """``tables[i]``: places x bytes x filters of width ``WIDTHS[i]``."""

    tables: tuple[np.ndarray, ...]
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray
    languages: tuple[str, ...]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _pooled(tables, batch: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Maxima of all filters, and where each was reached."""
    tops, places = [], []
    for table, width in zip(tables, WIDTHS):
        last = WINDOW - width + 1
        total = sum(table[k][batch[:, k : k + last]] for k in range(width))
        places.append(total.argmax(axis=1))
        tops.append(np.take_along_axis(total, places[-1][:, None], axis=1)[:, 0])
    return np.concatenate(tops, axis=1), places


def fit(x: np.ndarray, y: np.ndarray, languages: tuple[str, ...], steps: int = STEPS) -> Network:
    """Trains on windows ``x`` of languages number ``y`` by Adam; gradients pass the maxima only."""
    rng = np.random.default_rng(7)
    count = FILTERS * len(WIDTHS)
    params = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    for p in params:
        p[:, 0] = -1.0  # the filling never makes a maximum of its own
    params += [np.zeros(count, np.float32)]
    params += [rng.normal(0, 0.1, (count, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    balance = len(y) / (len(languages) * np.maximum(1, np.bincount(y, minlength=len(languages))))
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(y), BATCH)
        batch, want = x[pick], y[pick]
        tops, places = _pooled(params[:3], batch)
        hidden = np.maximum(tops + params[3], 0)
        delta = _softmax(hidden @ params[4] + params[5])
        delta[np.arange(BATCH), want] -= 1
        delta *= balance[want][:, None] / BATCH
        back = (delta @ params[4].T) * (hidden > 0)
        grads = [np.zeros_like(p) for p in params[:3]]
        rows = np.arange(BATCH)[:, None]
        for i, width in enumerate(WIDTHS):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            for k in range(width):
                hit = batch[rows, places[i] + k]
                np.add.at(grads[i][k], (hit, np.arange(FILTERS)[None, :]), part)
        grads += [back.sum(axis=0), hidden.T @ delta, delta.sum(axis=0)]
        for p, g, m, v in zip(params, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + DECAY * p)
    return Network(tuple(params[:3]), params[3], params[4], params[5], languages)


class Predictor:
    """A network with the tables of neighbouring places merged."""

    def __init__(self, network: Network):
        two, three, four = network.tables
        pair = lambda a, b: (a[:, None] + b[None]).reshape(65536, FILTERS)
        self.two, self.three, self.third = pair(*two), pair(three[0], three[1]), three[2]
        self.four, self.fourth = pair(four[0], four[1]), pair(four[2], four[3])
        self.network = network

    def chances(self, batch: np.ndarray) -> np.ndarray:
        out = []
        for low in range(0, len(batch), CHUNK):
            b = batch[low : low + CHUNK]
            pairs = b[:, :-1].astype(np.int32) << 8 | b[:, 1:]
            a = self.two.take(pairs, axis=0).max(axis=1)
            total = self.three.take(pairs[:, :-1], axis=0)
            total += self.third.take(b[:, 2:], axis=0)
            c = total.max(axis=1)
            total = self.four.take(pairs[:, :-2], axis=0)
            total += self.fourth.take(pairs[:, 2:], axis=0)
            tops = np.concatenate((a, c, total.max(axis=1)), axis=1)
            net = self.network
            out.append(_softmax(np.maximum(tops + net.bias, 0) @ net.weights + net.offset))
        return np.concatenate(out)


def _chosen(known: DataFrame, per_language: int, total: int) -> DataFrame:
    """``(doc_id, lang, own)``: the documents to learn from, with the hash of the text that counts."""
    one = stored(known.groupBy("lang", "doc_id").agg(F.min(F.xxhash64("text")).alias("own")), "labelled")
    counts = one.groupBy("lang").agg(F.count("*").alias("n_"))
    counts = stored(counts.orderBy(F.desc("n_"), "lang").limit(total), "languages")
    languages = counts.count()
    each = max(1, min(per_language, total // max(1, languages)))
    counts = F.broadcast(counts)  # ``total`` rows at most
    # The least hashes of a language lie among those below about OVERSAMPLE times its share, so only these are
    # ranked; should they not be enough, all are.
    rank = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    known = one.join(counts, "lang").withColumn("rank_", rank)
    few = known.where(F.col("rank_") / F.lit(2.0**63) * F.col("n_") <= OVERSAMPLE * each)
    enough = few.groupBy("lang").count().where(F.col("count") >= each)
    small = one.join(counts, "lang").where(F.col("n_") * 1.0 <= OVERSAMPLE * each).select("lang").distinct()
    if enough.select("lang").union(small).distinct().count() < languages:
        few = known
    order = Window.partitionBy("lang").orderBy("rank_", "doc_id")
    ids = few.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each)
    return ids.select("doc_id", "lang", "own")


def train(docs: DataFrame, per_language: int = TRAIN_ROWS, total: int = TRAIN_TOTAL) -> Network | None:
    """A network from ``docs(doc_id, text, lang)``; None if there is nothing to learn from.

    ``per_language`` documents of each language are taken, or all it has: those of least hash that have a number, are
    not held out and have a letter; ``TRAIN_WINDOWS`` windows of each, spread over its whole text. With many
    languages each has an equal share of ``total``; of more than ``total`` languages the most frequent are
    learned. A document counts once however often its row is repeated, with the text of least hash if it has
    several, and once for each language it is labelled with.
    """
    known = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    known = known.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    known = known.where(F.col("text").rlike(r"\p{L}"))
    ids = _chosen(known, per_language, total)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            numbers, langs, parts = [], [], []
            for number, lang, text in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "lang", "text"))):
                every = windows(text)
                spread = np.unique(np.linspace(0, len(every) - 1, TRAIN_WINDOWS).astype(int))
                parts += [every[i].tobytes() for i in spread]
                numbers += [number] * len(spread)
                langs += [lang] * len(spread)
            columns = [pa.array(numbers, pa.int64()), pa.array(langs, pa.string()), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "part"])

    # ``total`` rows at most. Repeated rows are one before they leave their task.
    of_ids = known.withColumn("own", F.xxhash64("text")).join(F.broadcast(ids), ["doc_id", "lang", "own"])
    chosen = of_ids.groupBy("doc_id", "lang").agg(F.first("text").alias("text"))
    rows = sorted(tuple(r) for r in chosen.mapInArrow(cut, "doc_id long, lang string, part binary").collect())
    languages = tuple(sorted({r[1] for r in rows}))
    if not languages:
        return None
    x = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, WINDOW)
    y = np.array([languages.index(r[1]) for r in rows])
    return fit(x, y, languages)


def predict_language(text: str | Column, network: Network | None) -> Column:
    """Struct ``(lang, score)`` for each whole text.

    ``und`` with score 0 where a text is NULL or has no letter, or nothing was learned.
    """
    kind = T.StructType().add("lang", T.StringType()).add("score", T.DoubleType())
    fields = None if network is None else tuple(network)

    @F.arrow_udf(kind)
    def judged(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = None if fields is None else Predictor(Network(*fields))
        for texts in parts:
            langs, scores = [], []
            for text in texts.to_pylist():
                if model is None or not has_letter(text):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                mean = model.chances(windows(text)).mean(axis=0, dtype=np.float64)
                langs.append(model.network.languages[int(mean.argmax())])
                scores.append(min(1.0, float(mean.max())))
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"]
            )

    return judged(text)


def identify_languages(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` from the whole text alone.

    Repeated rows are judged alike, very long texts window by window; other columns stay, but for those named as an added
    one; an empty table gives no rows.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    found = bounded_batches(docs).select(*rest, predict_language(F.col("text"), network).alias("lang_"))
    return found.select(*rest, F.col("lang_.lang").alias("lang_pred"), F.col("lang_.score").alias("score"))
