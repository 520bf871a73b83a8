from __future__ import annotations

import random
import re

import pytest

from playlens.llm import decontaminate as decontaminate_module
from playlens.llm.decontaminate import decontaminate

from .helpers import frame, odd_documents, sentence

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, items, window):
    known = {}
    for number, text in items:
        own = words(text)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            known.setdefault(tuple(own[i : i + size]), set()).add(number)
    sizes = {len(k) for k in known}
    out = []
    for number, text, *_ in rows:
        own, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                if (key := tuple(own[i : i + size])) in known:
                    hit |= set(range(i, i + size))
                    found |= known[key]
        listed = sorted(str(x) for x in found if x is not None)
        out.append((number, len(own), len(hit), listed, len(hit) > 0 and 20 * len(hit) >= len(own)))
    return out


def tables():
    rng = random.Random(3)
    items = [(i, sentence(rng, rng.randint(14, 30))) for i in range(12)]
    items += [(90, "Only three words"), (91, "zebra"), (92, None), (93, "?!"), (None, sentence(rng, 20)), (1, items[1][1])]
    rows = odd_documents()
    for i, (_, text) in enumerate(items[:12]):
        filler = sentence(rng, rng.choice([5, 40, 900]))
        own = text.upper().replace(" ", rng.choice([" ", ", ", "\n"]))
        rows.append((3000 + i, f"{filler} {own} {filler}", "x"))
    cut = " ".join(items[2][1].split()[:12])
    rows += [(3100, cut, "x"), (3101, "Ézebra zebra_zebra", "x"), (3102, "only THREE words", "x"), (3103, items[16][1], "x")]
    return rows, items


def judged(spark, rows, items, **options):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return decontaminate(frame(spark, rows, "n_hit"), benchmark, **options)


ORDER = lambda row: tuple((v is not None, v) for v in row)


@pytest.mark.parametrize("block", [50_000, 40])
def test_hits_as_in_plain_python(spark, block):
    rows, items = tables()
    found = judged(spark, rows, items, block=block).select("doc_id", "n_words", "n_hit", "items", "contaminated")
    expected = plain(rows, items, 13)
    assert sorted(map(tuple, found.collect()), key=ORDER) == sorted(expected, key=ORDER)
    assert {r[4] for r in expected} == {True, False} and any(r[2] and not r[4] for r in expected)


def test_removal(spark):
    rows, items = tables()
    kept = judged(spark, rows, items, remove="documents")
    clean = [r for r in plain(rows, items, 13) if not r[4]]
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(r[0] or -1 for r in clean)
    cut = {r.doc_id: r.text for r in judged(spark, rows, items, remove="spans").collect()}
    hits = {r[0]: r[2] for r in plain(rows, items, 13)}
    for number, text, _ in rows:
        if number is not None and number != 7:
            assert len(words(cut[number])) == len(words(text)) - hits[number]
            assert hits[number] or cut[number] == text


def test_nothing_to_find(spark):
    rows, items = tables()
    assert judged(spark, [], items).collect() == []
    assert not any(r.n_hit for r in judged(spark, rows, []).collect())


def test_the_plan_that_holds_all_windows_goes_once_it_has_run(spark, monkeypatch):
    seen, kept = [], decontaminate_module.stored
    monkeypatch.setattr(decontaminate_module, "stored", lambda df, label: seen.append(label) or kept(df, label))
    monkeypatch.setattr(decontaminate_module, "drop_shuffles", lambda spark: seen.append("collected"))
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    decontaminate_module.decontaminate(docs, docs.withColumnRenamed("doc_id", "item_id")).collect()
    assert seen[seen.index("found") + 1] == "collected"
