from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playlens.llm.sharding import balanced_shards, numbered, quotas, split_groups

from .helpers import frame, odd_documents

SIZE = 4
COUNTS = st.lists(st.lists(st.integers(0, 20), min_size=SIZE, max_size=SIZE), min_size=SIZE, max_size=SIZE)


@settings(max_examples=200, deadline=None)
@given(COUNTS, st.lists(st.integers(0, 30), min_size=SIZE, max_size=SIZE))
def test_quotas_keep_counts(want, free):
    want = [[0 if i == j else n for j, n in enumerate(row)] for i, row in enumerate(want)]
    moves, flows = quotas(want, free)
    for j in range(SIZE):
        sent = [end for end, _ in flows[j]]
        assert sent == sorted(sent) and (not sent or sent[-1] <= free[j])
        out = sum(moves[j]) + (sent[-1] if sent else 0)
        back = sum(e - (flows[i][n - 1][0] if n else 0) for i in range(SIZE) for n, (e, to) in enumerate(flows[i]) if to == j)
        assert out == sum(moves[i][j] for i in range(SIZE)) + back
        assert all(0 <= moves[i][j] <= want[i][j] for i in range(SIZE))


def dealt(spark, rows, **options):
    docs = frame(spark, rows, "slot")
    found = balanced_shards(docs, F.when(F.col("text").isNotNull(), F.xxhash64("text")), **options).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in found) == sorted((r[0] or -1, r[1] or "") for r in rows)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return found, slots


def test_counts_differ_by_one_and_copies_meet(spark):
    rows = odd_documents(count=100) + [(5000 + i, f"copy {i % 20}", "x") for i in range(60)]
    found, slots = dealt(spark, rows, shards=4)
    sizes = [len(slots[s]) for s in range(4)]
    assert max(sizes) - min(sizes) <= 1
    places = defaultdict(set)
    for r in found:
        if r.text is not None:
            places[r.text].add(r.shard)
    assert all(len(p) == 1 for p in places.values())


def test_a_group_with_a_third_of_all_rows(spark):
    rows = [(i, "same" if i % 3 == 0 else f"text {i // 2 * 2}", "x") for i in range(600)]
    found, slots = dealt(spark, rows, shards=8)
    assert {len(s) for s in slots.values()} == {75}
    hot = Counter(r.shard for r in found if r.text == "same")
    assert len(hot) <= 7 and max(hot.values()) >= 18


def test_pairs_are_not_split(spark):
    """A perfect split exists: no pair may stay in two shards."""
    rows = [(i, f"pair {i // 2}", "x") for i in range(4000)]
    found, slots = dealt(spark, rows, shards=16)
    assert {len(s) for s in slots.values()} == {250}
    places = defaultdict(set)
    for r in found:
        places[r.text].add(r.shard)
    assert sum(len(p) > 1 for p in places.values()) == 0


def test_few_groups_are_split_where_counts_are_tight(spark):
    """Moves along circles of shards leave fewer split groups than there are shards."""
    rng = random.Random(3)
    rows = [(i * 100 + k, f"group {i}", "x") for i in range(300) for k in range(rng.randint(2, 30))]
    rows += [(90_000 + i, f"alone {i}", "x") for i in range(40)]
    docs = frame(spark, rows, "slot")
    group = F.xxhash64("text")
    found = balanced_shards(docs, group, shards=16)
    split = split_groups(found, F.col("text")).collect()
    assert len(split) <= 16, (len(split), sum(r.n for r in split))


def test_small_cases_equal_the_best_of_all_splits(spark):
    """Two shards: as few groups are split as the best choice of whole groups allows."""
    rng = random.Random(9)
    for _ in range(3):
        sizes = [rng.randint(2, 4) for _ in range(12)]  # none above a quarter of a shard
        rows = [(i * 10 + k, f"g{i}", "x") for i, n in enumerate(sizes) for k in range(n)]
        halves = {sum(s) for n in range(13) for s in combinations(sizes, n)}
        best = 0 if halves & {len(rows) // 2, -(-len(rows) // 2)} else 1
        found = balanced_shards(frame(spark, rows, "slot"), F.xxhash64("text"), shards=2, patience=6)
        assert best <= split_groups(found, F.col("text")).count() <= best + 1


def test_repeated_rows(spark):
    rows = [(1, "same", "x")] * 300 + [(i, f"text {i}", "x") for i in range(100)]
    found, slots = dealt(spark, rows, shards=4)
    assert {len(s) for s in slots.values()} == {100}


def test_fewer_rows_than_shards_and_none(spark):
    assert max(len(s) for s in dealt(spark, [(1, "a", "x"), (2, "a", "x"), (None, None, None)], shards=16)[1].values()) == 1
    assert dealt(spark, [], shards=16)[0] == []


def test_numbers_are_gapless(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), "id")
    found = numbered(df, ["k"], F.xxhash64("id"), ["id"], 500_000, "n").collect()
    for key in range(3):
        assert sorted(r.n for r in found if r.k == key) == list(range(sum(r.k == key for r in found)))
