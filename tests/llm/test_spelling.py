from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from playlens.llm.spelling import one_edit_apart, signatures, spelling_variants

from .helpers import frame, odd_documents


def near(a, b):
    """Whether one inserted, deleted or replaced code point makes a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


WORDS = st.text(alphabet="abcé", min_size=1, max_size=9)


@settings(max_examples=300, deadline=None)
@given(WORDS, st.integers(0, 9), st.sampled_from("abcé"), st.sampled_from(["insert", "replace"]))
def test_words_one_edit_apart_share_a_signature(word, at, letter, kind):
    at = min(at, len(word) if kind == "insert" else len(word) - 1)
    other = word[:at] + letter + word[at + (kind == "replace") :]
    short, long = signatures([word, other])
    own = set(short[0].tolist())
    assert own & set((long if kind == "insert" else short)[1].tolist())


@settings(max_examples=300, deadline=None)
@given(WORDS, WORDS)
def test_edits_are_judged(a, b):
    assert one_edit_apart(a, b) == near(a, b)


def expected(rows, min_length, min_count, ratio, every):
    counts = Counter()
    for number, text, *_ in rows:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for word in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if number is None else number}:{word}".encode())
            if h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= min_length:
                counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= min_count}
    out = {}
    for word, n in counts.items():
        others = [w for w in counts if abs(len(w) - len(word)) <= 1 and near(w, word)]
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        out[word] = (best if best is not None and counts[best] >= ratio * n else None, n, len(others))
    rows = []
    for word, (form, n, many) in out.items():
        root = word
        while out[root][0] is not None:
            root = out[root][0]
        rows.append((word, form, root, n, many, counts[form] if form else None))
    return sorted(rows, key=str)


def misspelt(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdeéùÿ", k=rng.randint(4, 9))) for _ in range(12)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(40):
            word = rng.choice(base)
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(word))
                word = rng.choice([word[:at] + word[at + 1 :], word[:at] + "x" + word[at:], word[:at] + "É" + word[at + 1 :]]) or "a"
            words.append(word.upper() if rng.random() < 0.2 else word)
        rows.append((i, rng.choice([" ", "-", "\n"]).join(words), "x"))
    return rows


def test_equals_brute_force(spark):
    rows = odd_documents(count=30) + misspelt(4) + [(5, "Ω×÷ß aaaaaaa", "x")] * 3
    for min_length, min_count, ratio, every in ((7, 2, 10, 31), (4, 1, 2, 3)):
        found = spelling_variants(frame(spark, rows, "form"), min_length, min_count, ratio, every).collect()
        assert sorted(map(tuple, found), key=str) == expected(rows, min_length, min_count, ratio, every)


def test_a_long_text_and_a_long_word(spark):
    rows = [(1, "wordsmith " * 150_000 + "wordsmiths wordsmiths " + ("ab" * 60_000 + " ") * 2 + "ab" * 60_000 + "a " + "ab" * 60_000 + "a", "x")]
    found = {r.word: r for r in spelling_variants(frame(spark, rows), every=1 << 40).collect()}
    assert (found["wordsmiths"].form, found["wordsmith"].n) == ("wordsmith", 150_000)
    assert len(found) == 4 and sorted(r.n_near for r in found.values()) == [1, 1, 1, 1]


def test_no_words(spark):
    assert spelling_variants(frame(spark, [])).collect() == []
    assert spelling_variants(frame(spark, [(1, None, "x"), (2, "", "x"), (3, "short", "x")])).collect() == []
