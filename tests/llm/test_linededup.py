from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from playlens.llm.linededup import PerfectHash, Shard, dedup_lines
from playlens.llm.queries import op9_line_dedup

from .helpers import frame, odd_documents, texts


def plain(rows, min_docs, min_chars):
    space = " \t\n\x0b\x0c\r"
    lower = lambda s: s.encode().lower().decode()
    holders = {}
    for number, text, *_ in rows:
        keys = {lower(line.strip(space)) for line in (text or "").split("\n")}
        for key in keys:
            holders.setdefault(key, []).append(number)
    out = []
    for number, text, *_ in rows:
        kept, lines = [], (text or "").split("\n")
        for line in lines:
            key = lower(line.strip(space))
            known = [n for n in holders[key] if n is not None]
            heavy = len(key) >= min_chars and len(holders[key]) >= min_docs
            if not heavy or number == max(known, default=None):
                kept.append(line)
        out.append((number, text if len(kept) == len(lines) else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def rows_with_boilerplate():
    rng = random.Random(5)
    common = [f"{'All rights reserved by the owner of this page'} {i}." for i in range(30)]
    rows = odd_documents()
    for i, text in enumerate(texts(9, 60)):
        lines = text.split("\n") + rng.sample(common, 3)
        rng.shuffle(lines)
        lines[0] = rng.choice(["", "  ", "\t"]) + lines[0] + rng.choice(["", " ", "\r"])
        rows.append((2000 + i, "\n".join(lines).replace("All", rng.choice(["All", "ALL"])), "x"))
    return rows + [(None, common[0] + "\n" + common[1], "x"), (2001, common[2], "x")]


@pytest.mark.parametrize(("index_bytes", "shard_keys"), [(64 << 20, 1 << 16), (1, 4)])
def test_lines_go_as_in_plain_python(spark, index_bytes, shard_keys):
    rows = rows_with_boilerplate()
    found = dedup_lines(frame(spark, rows, "n_lines"), 3, 20, index_bytes, shard_keys)
    assert found.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    order = lambda row: tuple((v is not None, v) for v in row)
    assert sorted(map(tuple, found.collect()), key=order) == sorted(plain(rows, 3, 20), key=order)
    assert any(r[3] for r in plain(rows, 3, 20))


def test_other_columns_stay(spark):
    found = dedup_lines(frame(spark, [(1, "a", "x"), (2, None, None)], "dropped_bits"))
    assert sorted(map(tuple, found.select("doc_id", "text", "dropped_bits").collect())) == [(1, "a", "x"), (2, None, None)]
    assert dedup_lines(frame(spark, [])).collect() == []


def test_repeated_rows_count_once(spark, tmp_path):
    line = "a line of some length that several documents hold"
    rows = [(i, f"{line}\nown {i}", "x") for i in (1, 2, 3, 4, 4, 4)]

    def dropped(table):
        path = f"{tmp_path}/{len(table)}"
        frame(spark, table).write.parquet(f"{path}/documents.parquet")
        return sorted((r.doc_id, r.n_dropped) for r in op9_line_dedup(spark, path).collect())

    assert not any(n for _, n in dropped(rows))
    staged = corpus_pipeline.drop_repeated_lines(spark, frame(spark, rows), "")
    assert all(line in r.text for r in staged.collect())
    assert dropped([*rows, (5, line, "x")]) == [(1, 1), (2, 1), (3, 1), (4, 1), (4, 1), (4, 1), (5, 0)]


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(1).integers(-(2**63), 2**63, 5000)
    slots = PerfectHash(np.unique(keys)).slots(np.unique(keys))
    assert sorted(slots.tolist()) == list(range(len(np.unique(keys))))


def test_shard_tells_keys_of_one_slot_apart():
    shard = Shard.load(Shard(np.array([5, 5, 9]), np.array([1, 2, 3]), np.array([6, 7, 8]), np.array([0, 1, 2])).dump())
    counts, keepers = shard.probe(np.array([5, 5, 9, 9, 4]), np.array([1, 2, 3, 4, 1]))
    assert counts.tolist() == [6, 7, 8, 0, 0] and keepers[:3].tolist() == [0, 1, 2]
