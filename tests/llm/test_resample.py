from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from playlens.llm import resample as module
from playlens.llm.resample import prefix_crcs, resample, run_crcs

from .helpers import frame, odd_documents, texts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain_runs(text, low, high):
    words = plain_words(text)
    return [zlib.crc32(" ".join(words[i : i + n]).encode()) for n in range(low, high + 1) for i in range(len(words) - n + 1)]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abZ09 \n\t.é\U0001f600_Ÿ", max_size=60), st.integers(1, 4), st.integers(1, 12))
def test_crcs_of_runs(text, size, block):
    old, module.BLOCK = module.BLOCK, block
    try:
        ends, offsets = prefix_crcs(text)
    finally:
        module.BLOCK = old
    assert run_crcs(ends, offsets, size).tolist() == plain_runs(text, size, size)


def expected(rows, target, low, high, buckets, percent, min_words):
    runs = [[h % buckets for h in plain_runs(r[1], low, high)] for r in rows]
    s, t = Counter(b for r in runs for b in r), Counter(h % buckets for x in target for h in plain_runs(x, low, high))
    ratio = lambda b: (t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))
    out, may = [], []
    for row, found in zip(rows, runs):
        weight = sum(math.floor(1000 * math.log(ratio(b))) for b in found)
        h = int(hashlib.sha256(f"2024:{'' if row[0] is None else row[0]}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296.0)))
        out.append([row[0], len(found), weight, score, None])
        if len(plain_words(row[1])) >= min_words:
            may.append(out[-1])
    may.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(may[: percent * len(may) // 100], 1):
        row[4] = place
    return sorted(map(tuple, out), key=str)


def test_equals_a_plain_count(spark):
    rows = odd_documents(count=60) + [(9000 + i, "same words again " * 9, "x") for i in range(40)]
    rows += [(70, "tie " * 25, "x")] * 8
    target = [*texts(5, 6), None, ""]
    wanted = spark.createDataFrame([(t, "x") for t in target], "text string, rank string")
    for low, high, buckets, percent in ((1, 1, 10_000, 10), (1, 3, 50, 60)):
        found = resample(frame(spark, rows, "rank"), wanted, low, high, buckets, percent, min_words=20).collect()
        assert sorted(map(tuple, found), key=str) == expected(rows, target, low, high, buckets, percent, 20)


def test_a_long_text(spark):
    rng = random.Random(2)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(400_000))  # over 2 MB, several blocks
    rows = [(1, long, "x"), (2, "w1 " * 30, "x")]
    found = resample(frame(spark, rows), spark.createDataFrame([(long[:500],)], "text string"), percent=50).collect()
    assert sorted(map(tuple, found), key=str) == expected(rows, [long[:500]], 1, 1, 10_000, 50, 20)


def test_no_rows(spark):
    none = spark.createDataFrame([], "text string")
    assert resample(frame(spark, []), none).collect() == []
    assert len(resample(frame(spark, odd_documents()), none).collect()) == len(odd_documents())
