from __future__ import annotations

import random

import pytest
import xxhash

from playlens.llm import substrings
from playlens.llm.substrings import remove_repeats

from .helpers import frame, odd_documents, texts


def plain(rows):
    """Rows in order of number, NULL first, and text hash; repeated rows judged once."""
    seen, out = {}, {}
    signed = lambda t: int.from_bytes(xxhash.xxh64_digest(t or "", 42), "big", signed=True)
    ordered = sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1])))
    for number, text in ordered:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            else:
                seen[raw[i : i + 100]] = True
        runs = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(gone)))
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out[number, text] = (len(raw), sum(gone), runs, kept)
    return sorted(((r[0], *out[r[0], r[1]]) for r in rows), key=order)


def order(row):
    return tuple((v is not None, v) for v in row)


def rows_with_passages():
    rng = random.Random(11)
    passages = [" ".join(texts(i, 1, 60))[: rng.choice([99, 100, 101, 180, 400])] for i in range(20, 26)]
    rows = odd_documents(count=15)
    for i, text in enumerate(texts(8, 40, 20)):
        at = rng.randrange(len(text))
        rows.append((4000 + i, text[:at] + rng.choice(passages) + text[at:], "x"))
    edited = rows[-1][1]
    rows += [(5000 + i, edited[: 30 * i] + "#" + edited[30 * i + 1 :], "x") for i in range(8)]
    return rows + [(6000, "ab" * 400, "x"), (6001, "abc" * 300, "x"), (6002, "ab" * 60, "x")]


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_bytes_go_as_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(substrings, "BLOCK", block)
    rows = rows_with_passages()
    found = remove_repeats(frame(spark, rows, "n_bytes")).collect()
    assert sorted((tuple(r[:4]) + (bytes(r[4]),) for r in found), key=order) == plain(rows)


def test_runs_that_span_tasks(spark):
    """One passage in most documents: its anchors are spread over several sort ranges."""
    passage = " ".join(texts(70, 1, 80))[:300]
    rows = [(i, f"{i:04d}" * (i % 7) + passage + f"{i * 31:05d}" * (i % 5), "x") for i in range(300)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = remove_repeats(frame(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert sorted((tuple(r[:4]) + (bytes(r[4]),) for r in found), key=order) == plain(rows)


def test_many_texts_of_one_number_or_none(spark):
    rng = random.Random(4)
    passage = " ".join(texts(71, 1, 80))[:120]
    rows = []
    for number in (None, 7):
        for i in range(5000):
            own = "".join(rng.choices("abcdefgh", k=rng.randint(0, 110)))
            rows.append((number, own + (passage if i % 3 else "") + own[:20], "x"))
    rows += [(n, rows[5][1], "x") for n in (8, 8, None)] + [(9, None, "x"), (None, None, "x")]
    found = remove_repeats(frame(spark, rows)).collect()
    assert sorted((tuple(r[:4]) + (bytes(r[4]),) for r in found), key=order) == plain(rows)


def test_a_long_text_and_no_rows(spark):
    rng = random.Random(6)
    long = "".join(rng.choices("abcdefgh ", k=1_200_000))
    found = remove_repeats(frame(spark, [(1, long, "x"), (2, "z" + long[700_000:700_300] + "z", "x")])).collect()
    assert sorted(tuple(r[:4]) for r in found) == [(1, 1_200_000, 0, 0), (2, 302, 300, 1)]
    assert remove_repeats(frame(spark, [])).collect() == []
