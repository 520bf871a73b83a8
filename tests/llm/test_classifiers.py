from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from playlens.llm import langid, quality
from playlens.llm.common import held_out

from .helpers import frame, odd_documents, sentence


def labelled(count=400):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(count):
        good = rng.random() < 0.7
        text = " ".join(sentence(rng, rng.randint(5, 20)) for _ in range(rng.randint(1, 9)))
        docs.append((i, text if good else " ".join(w + "###" for w in text.upper().split()), "x"))
        labels.append((i, int(good)))
    return docs, labels


def held(number):
    return zlib.crc32(str(number).encode()) % 5 == 0


def test_a_repeated_number_is_one_example(spark):
    one, two = [n for n in range(20) if not held(n)][:2]
    docs = [(one, f"text {i}", "x") for i in range(40)] + [(two, "another", "x")]
    labels = spark.createDataFrame([(one, 1), (two, 0)], "doc_id long, quality int")
    forests = [quality.train(frame(spark, d).coalesce(1), labels, rows=2) for d in (docs, docs[::-1])]
    assert forests[0].base == forests[1].base == 0  # one good and one bad, whatever comes first


def test_quality_of_held_out_documents(spark):
    docs, labels = labelled()
    # Wrong labels on everything held out: they must not matter.
    known = [(n, 1 - y if held(n) else y) for n, y in labels] + [(None, 1), (3, None), (99_999, 1)]
    table = frame(spark, docs + odd_documents()[40:], "score")
    forest = quality.train(table, spark.createDataFrame(known, "doc_id long, quality int"))
    found = quality.quality_scores(table, forest)
    assert found.columns == ["doc_id", "text", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == len(docs) + len(odd_documents()) - 40
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    truth = dict(labels)
    tested = [r.predicted == truth[r.doc_id] for r in rows if r.doc_id in truth and held(r.doc_id)]
    assert np.mean(tested) > 0.97


def test_trees_walk_as_plain_loops():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 5)).round(1)
    x[:, 4] = 1.0
    y = (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(float)
    forest = quality.fit(x, y)
    for row, chance in zip(x[:60], quality.predict(forest, x[:60])):
        margin = forest.base
        for feature, threshold, value in zip(forest.feature, forest.threshold, forest.value):
            node = 0
            for _ in range(quality.DEPTH):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            margin += value[node - len(threshold)]
        assert chance == pytest.approx(1 / (1 + np.exp(-margin)))
    assert ((quality.predict(forest, x) >= 0.5) == y).mean() > 0.95


def test_quality_without_anything(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    forest = quality.train(frame(spark, []), none)
    assert quality.quality_scores(frame(spark, []), forest).collect() == []
    assert [r.score for r in quality.quality_scores(frame(spark, [(1, None, "x")]), forest).collect()] == [0.5]


WORDS = {"aa": "the of and that with for this".split(), "bb": "ñandú está qué más allí niño".split()}


def spoken(count=120):
    rng = random.Random(4)
    rows = []
    for i in range(count):
        lang = rng.choice(sorted(WORDS))
        rows.append((i, " ".join(rng.choices(WORDS[lang], k=rng.choice([3, 30, 400]))), lang))
    return rows


def test_languages_of_whole_texts(spark):
    rows = spoken()
    docs = frame(spark, rows + [(500, None, "aa"), (501, "12 !?", "bb"), (502, "the of", None), (None, "the", "aa")], "lang")
    network = langid.train(docs, per_language=60)
    assert network.languages == ("aa", "bb")
    clash = docs.withColumnRenamed("lang", "lang_pred")
    found = langid.identify_languages(clash, network)
    assert found.columns == ["doc_id", "text", "lang_pred", "score"]
    rows_found = {r.doc_id: r for r in found.collect() if r.doc_id is not None}
    assert len(rows_found) == len(rows) + 3
    truth = {n: lang for n, _, lang in rows}
    assert np.mean([rows_found[n].lang_pred == truth[n] for n in truth]) > 0.97
    assert {rows_found[n].lang_pred for n in (500, 501)} == {"und"} and rows_found[500].score == 0
    assert all(0 <= r.score <= 1 for r in rows_found.values())


def learned(monkeypatch):
    """What a training run hands to the network."""
    got = {}

    def fit(x, y, languages, **_):
        got.update(windows=len(x), counts=np.bincount(y).tolist(), languages=languages)

    monkeypatch.setattr(langid, "fit", fit)
    return got


def test_repeated_rows_are_learned_once(spark, monkeypatch):
    """One number, and one lang, hold more than half of all rows."""
    got = learned(monkeypatch)
    rows = [(i, WORDS["aa"][0], "aa") for i in range(40)] + [(2, "the other text of two", "aa")] * 300 + [(i, "ein", "bb") for i in range(40)]
    langid.train(frame(spark, rows, "lang"), per_language=30)
    assert got["languages"] == ("aa", "bb") and got["counts"] == [30, 30]


def test_rows_that_teach_nothing_do_not_push_others_out(spark, monkeypatch):
    got = learned(monkeypatch)
    rows = [(i, None if i % 50 else "the word", "aa") for i in range(10_000)] + [(i, "1 2 3", "bb") for i in range(9000)]
    rows += [(20_000 + i, "wort", "bb") for i in range(20)]
    docs = frame(spark, rows, "lang")
    may = lambda some: docs.where(some & F.col("text").rlike("[a-z]") & ~held_out("doc_id")).count()
    langid.train(docs, per_language=100)
    assert got["counts"] == [min(100, may(F.col("lang") == "aa")), may(F.col("lang") == "bb")]


def test_many_languages_share_the_bound(spark, monkeypatch):
    got = learned(monkeypatch)
    docs = frame(spark, [(i, "word", f"l{i % 40:02d}") for i in range(800)], "lang")
    langid.train(docs, per_language=100, total=80)
    assert got["counts"] == [2] * 40
    langid.train(docs, per_language=100, total=10)
    assert len(got["counts"]) == 10 and set(got["counts"]) == {1}


def test_the_end_of_a_text_counts(spark):
    network = langid.train(frame(spark, spoken(), "lang"), per_language=60)
    late = "1 " * 100 + " ".join(WORDS["bb"] * 400)
    found = langid.identify_languages(frame(spark, [(1, late, "x")]), network).first()
    assert found.lang_pred == "bb"


def test_languages_without_anything(spark):
    assert langid.train(frame(spark, [(1, "the", None)], "lang")) is None
    found = langid.identify_languages(frame(spark, [(1, "the", "x")]), None).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)]
    assert langid.identify_languages(frame(spark, []), None).collect() == []


def test_merged_tables_give_the_same_chances():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 256, (40, langid.WINDOW)).astype(np.uint8)
    network = langid.fit(x, np.arange(40) % 3, ("a", "b", "c"), steps=3)
    tops, _ = langid._pooled(network.tables, x)
    scores = np.maximum(tops + network.bias, 0) @ network.weights + network.offset
    plain = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
    assert np.allclose(langid.Predictor(network).chances(x), plain, atol=1e-4)
