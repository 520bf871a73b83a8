from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from playlens.llm import packing
from playlens.llm.packing import best_cuts, pack_documents, powers
from playlens.llm.tokens import Encoder, default_tokenizer

from .helpers import frame, odd_documents

LIBRARY = Tokenizer.from_file(default_tokenizer())


@settings(max_examples=150, deadline=None)
@given(st.text() | st.text(alphabet=" \n\t'sA.1é<|>") | st.sampled_from(["<|endoftext|>", "a<|endoftext|> b", "x" * 500]))
def test_ids_are_those_of_the_file(text):
    encoder = test_ids_are_those_of_the_file.__dict__.setdefault("encoder", Encoder(default_tokenizer()))
    assert encoder.encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 8), st.sampled_from([0, 2, 6])), min_size=1, max_size=14))
def test_cuts_are_the_cheapest(steps):
    window = 8
    at = np.cumsum([0] + [s for s, _ in steps])
    penalty = np.array([0] + [p for _, p in steps])
    cost = {0: 0}
    for j in range(1, len(at)):
        cost[j] = penalty[j] + min(cost[i] + window - (at[j] - at[i]) for i in range(j) if at[j] - at[i] <= window)
    cuts = best_cuts(at, penalty, window, last=True)
    assert cuts[0] == 0 and cuts[-1] == len(at) - 1
    spent = sum(window - (at[b] - at[a]) + penalty[b] for a, b in zip(cuts, cuts[1:]))
    assert all(at[b] - at[a] <= window for a, b in zip(cuts, cuts[1:])) and spent == cost[len(at) - 1]


def test_powers():
    assert powers(11) == [8, 2, 1] and powers(1) == [1] and powers(64) == [64]


@pytest.mark.parametrize("block", [1 << 19, 200])
def test_pieces_cover_every_id_once(spark, block):
    window = 64
    rows = odd_documents()
    pieces = pack_documents(frame(spark, rows, "sequence_id"), default_tokenizer(), window, block).collect()
    expected = defaultdict(int)
    for number, text, _ in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]
        expected[number, tuple(ids)] += 1
    of_doc, of_window = defaultdict(list), defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        of_doc[p.doc_id].append(p)
        of_window[p.sequence_id].append(p)
        assert p.length > 0 and len(p.ids) == 4 * p.length
    for own in of_window.values():
        assert [p.offset for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        assert sum(p.length for p in own) <= window
    found = defaultdict(int)
    for number, own in of_doc.items():
        ids, left = [], 0
        for p in own:  # pieces of a row follow each other, rows of a number too
            left = left or p.doc_tokens
            assert p.start == p.doc_tokens - left
            ids += np.frombuffer(p.ids, "<u4").tolist()
            left -= p.length
            if not left:
                found[number, tuple(ids)] += 1
                ids = []
    assert found == expected
    lengths = [sum(p.length for p in own) for own in of_window.values()]
    padding = sum(window - n for n in lengths if n & (n - 1))
    assert padding < 0.2 * sum(lengths)


def test_no_rows(spark):
    assert pack_documents(frame(spark, []), default_tokenizer()).collect() == []


def test_streams_are_cut_where_sentences_end():
    ids = np.arange(10)
    ends = np.zeros(10, bool)
    ends[[2, 5]] = True
    at, price = packing.boundaries(ids, np.array([8, 10]), ends, 4)
    assert at.tolist() == [0, 3, 6, 8, 10] and price.tolist() == [0, 2, 2, 0, 0]
