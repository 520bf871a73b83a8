from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from playlens.llm import common
from playlens.llm.components import connected_components
from playlens.llm.simhash import fingerprint_links, near_duplicates, near_texts, text_fingerprint

from .helpers import frame, odd_documents, texts


def plain_fingerprint(text, size=3):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, linked):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in values:
        for b in values:
            if a < b and linked(a, b):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {v: find(v) for v in values}


@pytest.mark.parametrize("text", [None, "", " \t", "one", "One two", "a b c", "É Ab\x0bC  d e f g h", *texts(3, 5)])
def test_fingerprint_is_the_vote_over_shingles(text):
    assert text_fingerprint(text, 3) == plain_fingerprint(text)


def close_fingerprints(count, seed):
    rng = np.random.default_rng(seed)
    out = set()
    for base in rng.integers(0, 2**63, count, dtype=np.uint64).tolist():
        for _ in range(12):
            out.add(base)
            for bit in rng.integers(0, 64, rng.integers(1, 5)).tolist():
                base ^= 1 << bit
    return sorted(out)


@pytest.mark.parametrize(("max_bits", "limit"), [(3, 1 << 17), (3, 4), (1, 100), (5, 100)])
def test_links_span_the_components(spark, max_bits, limit):
    known = close_fingerprints(12, max_bits)
    signed = [v - 2**64 if v >= 2**63 else v for v in known]
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = fingerprint_links(nodes, max_bits, limit)
    roots = {r.node % 2**64: r.root % 2**64 for r in connected_components(links, "a", "b").collect()}
    expected = components(known, lambda a, b: (a ^ b).bit_count() <= max_bits)
    groups = {}
    for value, root in expected.items():
        groups.setdefault(root, set()).add(value)
    found = {}
    for value in known:
        found.setdefault(roots.get(value, value), set()).add(value)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_a_chain_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(50, 50), (61, 60), (60, 61), (None, 3)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r.node: r.root for r in found} == {i: 0 for i in range(41)} | {60: 60, 61: 60}


@pytest.mark.parametrize(("few", "most"), [(1 << 16, 6), (0, 10**6)])
def test_components_of_few_links_take_few_tasks(spark, monkeypatch, few, most):
    """Links left in one task's reach are finished there; more of them go through rounds, with the same result."""
    monkeypatch.setattr(common, "FEW", few)
    rng = random.Random(2)
    links = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1200)]
    tracker, group = spark.sparkContext.statusTracker(), f"components-{few}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = connected_components(spark.createDataFrame(links, "a long, b long").repartition(3), "a", "b").collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    near = {frozenset(pair) for pair in links}
    nodes = sorted({x for a, b in links if a != b for x in (a, b)})
    assert len(found) == len(nodes)
    assert {r.node: r.root for r in found} == components(nodes, lambda a, b: frozenset((a, b)) in near)
    assert len(tracker.getJobIdsForGroup(group)) <= most


def test_every_row_has_its_component(spark):
    rows = odd_documents()
    found = near_duplicates(frame(spark, rows, "component_id")).collect()
    prints = {i: plain_fingerprint(r[1]) for i, r in enumerate(rows)}
    of_print = components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            key = of_print[prints[i]]
            least[key] = min(least.get(key, row[0]), row[0])
    expected = [(r[0], prints[i], least.get(of_print[prints[i]])) for i, r in enumerate(rows)]
    order = lambda row: tuple(-1 if v is None else v for v in row)
    assert sorted(((r[0], r[1] % 2**64, r[2]) for r in found), key=order) == sorted(expected, key=order)


def test_pairs_of_texts_span_the_groups(spark):
    rows = [(i, t) for i, (_, t, _) in enumerate(odd_documents(3, 60))]
    rows += [(500 + i, rows[i][1] + " tail") for i in range(60)] + [rows[3]] * 4
    pairs = near_texts(spark.createDataFrame(rows, "key long, text string"), max_bits=3, shingle=5).collect()
    prints = {k: plain_fingerprint(t, 5) for k, t in rows}
    expected = components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    found = components(sorted(prints), lambda a, b: (a, b) in linked or (b, a) in linked) if (linked := {(r.low, r.high) for r in pairs}) else {}
    assert found == expected and all(r.low < r.high and r.hub in (r.low, r.high) for r in pairs)
    assert len(linked) <= len(pairs) < 200


def test_no_rows(spark):
    assert near_texts(spark.createDataFrame([], "key long, text string")).collect() == []
    assert near_duplicates(frame(spark, [])).collect() == []
