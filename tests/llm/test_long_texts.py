"""One text of over a megabyte per operator, beside short ones."""

from __future__ import annotations

import random

import numpy as np
import pytest

from playlens.llm import langid, quality
from playlens.llm.decontaminate import decontaminate
from playlens.llm.linededup import dedup_lines
from playlens.llm.packing import pack_documents
from playlens.llm.simhash import near_duplicates, text_fingerprint
from playlens.llm.tokens import default_tokenizer
from playlens.llm.trainorder import write_training_order

from .helpers import frame, texts
from .test_classifiers import WORDS, labelled, spoken
from .test_decontaminate import plain as plain_hits
from .test_linededup import plain as plain_lines
from .test_packing import LIBRARY


@pytest.fixture(scope="module")
def long():
    rng = random.Random(12)
    lines = [" ".join(f"{rng.choice(WORDS['aa'])}{rng.randrange(3000)}" for _ in range(12)) for _ in range(15_000)]
    text = "\n".join(lines)
    assert len(text) > 1_000_000
    return text


def test_fingerprints(spark, long):
    rows = [(1, long, "x"), (2, long + " more", "x"), *[(10 + i, t, "x") for i, t in enumerate(texts(1, 5))]]
    found = {r.doc_id: r for r in near_duplicates(frame(spark, rows)).collect()}
    assert found[2].component_id == 1 and found[1].fp == int(np.uint64(text_fingerprint(long, 3)).view(np.int64))


def test_lines(spark, long):
    shared = "a line that many documents have, over forty characters long"
    rows = [(i, f"{shared}\n{i}", "x") for i in range(6)] + [(3000, long + "\n" + shared, "x"), (3001, shared, "x")]
    found = dedup_lines(frame(spark, rows), min_docs=5, min_chars=40, by_number=True).collect()
    want = sorted((n, t) for n, t, *_ in plain_lines([(r[0], r[1]) for r in rows], 5, 40))
    assert sorted((r.doc_id, r.text) for r in found) == want


def test_windows(spark, long):
    words = long.split()
    items = [(1, " ".join(words[-14:])), (2, " ".join(words[90_000:90_013])), (3, "not in there")]
    rows = [(1, long, "x"), (2, " ".join(words[-14:]), "x")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate(frame(spark, rows), benchmark).collect()
    want = {r[0]: tuple(r[1:5]) for r in plain_hits([(r[0], r[1]) for r in rows], items, 13)}
    assert {r.doc_id: (r.n_hit > 0, r.contaminated) for r in found} == {n: (w[1] > 0, bool(w[3])) for n, w in want.items()}
    assert {r.doc_id: (r.n_words, r.n_hit) for r in found} == {n: (w[0], w[1]) for n, w in want.items()}


def test_tokens(spark, long):
    rows = [(1, long, "x"), (2, "short", "x")]
    count = len(LIBRARY.encode(long, add_special_tokens=False).ids) + 1
    pieces = pack_documents(frame(spark, rows), default_tokenizer()).where("doc_id = 1").collect()
    assert sum(p.length for p in pieces) == count and {p.doc_tokens for p in pieces} == {count}
    written = write_training_order(frame(spark, rows), default_tokenizer(), key=3).collect()
    assert sum(r.n_tokens for r in written) == count + len(LIBRARY.encode("short", add_special_tokens=False).ids) + 1


def test_models(spark, long):
    docs, labels = labelled()
    forest = quality.train(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int"))
    network = langid.train(frame(spark, spoken(), "lang"), per_language=60)
    late = "1 " * 100_000 + " ".join(WORDS["bb"] * 60_000)
    rows = frame(spark, [(1, late, "x"), (2, long, "x")])
    scores = {r.doc_id: r.score for r in quality.quality_scores(rows, forest, threshold=0.3).collect()}
    assert len(scores) == 2 and all(0 <= s <= 1 for s in scores.values())
    assert {r.doc_id: r.lang_pred for r in langid.identify_languages(rows, network).collect()}[1] == "bb"
