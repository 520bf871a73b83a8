from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from playlens.llm import setjoin
from playlens.llm.setjoin import Rule, first_elements, similar_documents

from .helpers import frame, odd_documents
from .test_simhash import components

RULE = Rule(4, 85, 100)


def plain_set(text, shingle):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))) if words else frozenset()


def near_copies(rule, seed=3):
    """Copies with one to many words changed, around and beyond the bound, and a passage all share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    passage = " ".join(word() for _ in range(30))
    rows, number = [], 0
    for size in (8, 30, 120, 400):
        for _ in range(12):
            base = [word() for _ in range(size)]
            for changes in (0, 1, 1, size // 60, size // 40, size // 25):
                new = base[:]
                for at in rng.sample(range(size), changes):
                    new[at] = word()
                number += 1
                rows.append((number, " ".join(new) + (" " + passage if number % 3 else ""), "x"))
    rng.shuffle(rows)
    return rows


def expected(rows, rule):
    """(doc_id, set size, least number of the group) by comparing all pairs of different texts."""
    sets = {r[1]: plain_set(r[1], rule.shingle) for r in rows}
    names = sorted(sets, key=str)
    alike = lambda a, b: a == b or rule.den * len(a & b) >= rule.num * len(a | b)
    place = components(list(range(len(names))), lambda i, j: alike(sets[names[i]], sets[names[j]]))
    of_text = {t: place[i] for i, t in enumerate(names)}
    least = {}
    for number, text, *_ in rows:
        if number is not None:
            least[of_text[text]] = min(number, least.get(of_text[text], number))
    return sorted(((r[0], len(sets[r[1]]), least.get(of_text[r[1]])) for r in rows), key=str)


def found(spark, rows, rule):
    got = similar_documents(frame(spark, rows, "fp"), rule).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abAB \n\t\x1cé\U0001f600", max_size=40), st.integers(1, 9))
def test_hashes_of_words(text, block):
    """Equal words have equal hashes wherever they stand, other words have others."""
    plain = text.encode().lower().split()
    old, setjoin.BLOCK = setjoin.BLOCK, block
    try:
        hashes = setjoin.word_hashes(text).tolist()
    finally:
        setjoin.BLOCK = old
    assert len(hashes) == len(plain) and len(set(zip(hashes, plain))) == len(set(plain)) == len(set(hashes))
    assert hashes == setjoin.word_hashes(" ".join(w.decode() for w in plain)).tolist()


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 60), st.integers(0, 12))
def test_alike_sets_share_a_first_element_in_every_order(seed, size, changes):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
    b = np.unique(np.r_[a[: max(0, len(a) - changes)], rng.integers(0, 1 << 63, rng.integers(0, 3), dtype=np.uint64)])
    both = len(np.intersect1d(a, b))
    weights = rng.integers(0, 3, (setjoin.ORDERS, 1 << setjoin.SLOT_BITS)).astype(np.uint64)
    if both and RULE.den * both >= RULE.num * (len(a) + len(b) - both):
        for order in range(setjoin.ORDERS):
            x, y = (first_elements(s, order, weights, RULE.prefix(len(s))) for s in (a, b))
            assert len(np.intersect1d(x, y))


@pytest.mark.parametrize("rule", [RULE, Rule(5, 4, 5)])
def test_groups_equal_brute_force(spark, monkeypatch, rule):
    monkeypatch.setattr(setjoin, "OFTEN", 3)
    rows = near_copies(rule)
    rows += [rows[0]] * 9 + [rows[7]] * 2
    rows += [((n or 0) + 10_000 if n is not None else None, t, s) for n, t, s in odd_documents()]
    assert found(spark, rows, rule) == expected(rows, rule)


def test_the_driver_gets_each_counter_once(spark, monkeypatch):
    rows = near_copies(RULE)
    texts, sent = frame(spark, rows, "fp").repartition(5), []
    kind = type(texts)
    collect = kind.collect

    def counted(df):
        out = collect(df)
        sent.append(sum(len(value) for row in out for value in row if isinstance(value, (bytes, bytearray))))
        return out

    monkeypatch.setattr(kind, "collect", counted)
    counts = setjoin._frequencies(texts, RULE)
    total = np.zeros_like(counts)
    parts = texts.select("text").rdd.glom().map(lambda part: {r.text for r in part}).collect()
    for text in (t for part in parts for t in part):
        elements = setjoin.shingles(setjoin.word_hashes(text), RULE.shingle)
        for order in range(setjoin.ORDERS):
            total[order] += np.bincount(setjoin._slots(elements, order), minlength=1 << setjoin.SLOT_BITS)
    assert (counts == total).all() and total.any()
    assert sent == [8 * setjoin.ORDERS << setjoin.SLOT_BITS]


def test_long_groups_are_cut_into_blocks(spark, monkeypatch):
    """Copies of one text that are alike only through it, more than a task holds, and windows of one partner."""
    monkeypatch.setattr(setjoin, "HELD", 16)
    monkeypatch.setattr(setjoin, "CENTRES", 2)
    monkeypatch.setattr(setjoin, "WINDOWS", ((0, 1), (1, 4), (4, 1 << 62)))
    rng = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    rows = [(500, " ".join(base), "x")]
    for i in range(120):
        new = base[:]
        for at in rng.sample(range(150), rng.choice([2, 3, 5, 8])):
            new[at] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(new), "x"))
    rows += [(1000 + i, " ".join(base[:40] + [f"own{i}x{k}" for k in range(30)]), "x") for i in range(60)]
    rng.shuffle(rows)
    assert found(spark, rows, RULE) == expected(rows, RULE)


def test_a_pair_comes_up_once_however_many_groups_share_it(spark, monkeypatch):
    """Near copies of one text share many first elements, each with other members."""
    kept, made = setjoin.stored, []

    def counted(df, label):
        out = kept(df, label)
        if label == "alike-candidates":
            made.extend((r.low, r.high) for r in out.where("low IS NOT NULL").collect())
        return out

    monkeypatch.setattr(setjoin, "stored", counted)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        new = base[:]
        for at in rng.sample(range(300), rng.choice([1, 2, 8, 14])):
            new[at] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(new), "x"))
    assert found(spark, rows, RULE) == expected(rows, RULE)
    assert len(made) <= 2 * len(set(made))


def test_sets_a_little_too_far_apart_are_told_by_sketches(spark, monkeypatch):
    """Texts of one frame, each with words of its own in another place: no pair is alike, and few are compared whole."""
    kept, made = setjoin.stored, {"alike-candidates": 0, "alike-passing": 0}

    def counted(df, label):
        out = kept(df, label)
        if label in made:
            made[label] += out.where("low IS NOT NULL" if "low" in out.columns else "a IS NOT NULL").count()
        return out

    monkeypatch.setattr(setjoin, "stored", counted)
    base, rows = [f"w{i}" for i in range(420)], []
    for i in range(14):
        new = base[:]
        new[30 * i : 30 * i + 30] = [f"n{i}x{k}" for k in range(30)]
        rows.append((i, " ".join(new), "x"))
    assert found(spark, rows, RULE) == expected(rows, RULE) == [(i, 417, i) for i in sorted(range(14), key=str)]
    assert made["alike-candidates"] <= 10 and made["alike-passing"] == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 4000), st.floats(0, 0.3), st.integers(0, 400))
def test_sketches_never_tell_more_than_the_difference(seed, size, gone, new):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
    b = np.unique(np.r_[a[rng.random(len(a)) >= gone], rng.integers(0, 1 << 64, new + 1, dtype=np.uint64)])
    x, y = (setjoin.sketch_of(s)[None, :] for s in (a, b))
    assert setjoin._apart(x, np.array([len(a)]), y, np.array([len(b)]))[0] <= len(np.setxor1d(a, b))
    fine = [setjoin.parity_of(s, setjoin.fine_bits(len(s))).tobytes() for s in (a, b)]
    both = len(np.intersect1d(a, b))
    if RULE.den * both >= RULE.num * (len(a) + len(b) - both):
        assert setjoin._may_be_alike(RULE, *fine, len(a) + len(b)) and setjoin._may_be_alike(RULE, *fine[::-1], len(a) + len(b))


def test_a_third_of_all_rows_and_a_long_text(spark):
    rng = random.Random(5)
    long = [f"w{rng.randrange(10**6)}" for _ in range(150_000)]  # over 1 MB
    rows = [(i, "the same text in many rows of the table", "x") for i in range(100)]
    rows += [(200 + i, f"text number {i} with words of its own {i * i}", "x") for i in range(200)]
    rows += [(900, " ".join(long), "x"), (901, " ".join(long[:-3000]), "x"), (902, " ".join(long[:75_000]), "x")]
    of = {n: c for n, _, c in found(spark, rows, RULE)}
    assert {of[i] for i in range(100)} == {0} and all(of[200 + i] == 200 + i for i in range(200))
    assert (of[900], of[901], of[902]) == (900, 900, 902)


def test_no_rows(spark):
    assert found(spark, [], RULE) == []
