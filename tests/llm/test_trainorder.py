from __future__ import annotations

import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from playlens.llm.tokens import Encoder, default_tokenizer
from playlens.llm.trainorder import permuted, read_slots, write_training_order

from .helpers import frame, odd_documents


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**40))
def test_slots_are_a_permutation_that_can_be_undone(count, key):
    slots = permuted(np.arange(count), count, key)
    assert sorted(slots.tolist()) == list(range(count))
    assert permuted(slots, count, key, back=True).tolist() == list(range(count))


def test_the_key_decides():
    assert permuted(np.arange(500), 500, 1).tolist() != permuted(np.arange(500), 500, 2).tolist()


def test_shards_hold_the_stream(spark, tmp_path):
    rows = odd_documents()
    docs = frame(spark, rows, "slot")
    path = str(tmp_path / "shards")
    found = write_training_order(docs, default_tokenizer(), 9, path, length=32, per_shard=20).collect()
    count = len(found)
    assert sorted(r.slot for r in found) == sorted(r.sequence_id for r in found) == list(range(count))
    assert all(r.shard == r.slot // 20 and r.byte_offset == r.slot % 20 * 64 for r in found)
    stored = {r.slot: r.ids for r in read_slots(spark, path, 0, count, length=32, per_shard=20).collect()}
    for r in found:
        assert zlib.crc32(np.array(stored[r.slot][: r.n_tokens], "<u2").tobytes()) == r.ids_crc32
        assert not any(stored[r.slot][r.n_tokens :])
    encoder = Encoder(default_tokenizer())
    stream = [x for r in sorted(found, key=lambda r: r.sequence_id) for x in stored[r.slot][: r.n_tokens]]
    assert stream == np.concatenate([encoder.document(r[1]) for r in rows]).tolist()
    later = read_slots(spark, path, 25, 47, length=32, per_shard=20).collect()
    assert sorted(r.slot for r in later) == list(range(25, 47))
    assert {r.slot: r.ids for r in later} == {s: stored[s] for s in range(25, 47)}


def test_a_second_run_writes_the_same(spark, tmp_path):
    docs = frame(spark, odd_documents())
    runs = []
    for name in ("a", "b"):
        path = tmp_path / name
        write_training_order(docs, default_tokenizer(), 9, str(path), length=32, per_shard=20).count()
        runs.append({p.name: p.read_bytes() for p in path.iterdir() if p.name.startswith("shard")})
    assert runs[0] == runs[1] and runs[0]


def test_no_rows(spark):
    assert write_training_order(frame(spark, []), default_tokenizer(), 1).collect() == []
