from __future__ import annotations

import math

import numpy as np
import pytest

from playlens.llm import mtree

SCHEMA = "vec_id long, embedding array<double>, score string"


def plain(rows, queries, k):
    def usable(row):
        vector = row[1]
        return row[0] is not None and vector and all(x is not None and math.isfinite(x) for x in vector)

    whole = [(r[0], [math.floor(1024 * x) for x in r[1]]) for r in rows if usable(r)]
    asked = sorted({(r[0], tuple(math.floor(1024 * x) for x in r[1])) for r in queries if usable(r)})
    out = []
    for number, query in asked:
        scores = [
            (-sum(a * b for a, b in zip(query, v)), i) for i, v in whole if i != number and len(v) == len(query)
        ]
        out += [(number, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def vectors(count, size, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, size))
    rows = [(i, (centres[i % 5] + rng.normal(size=size) * 0.2).round(2).tolist(), "x") for i in range(count)]
    same = rows[3][1]
    rows += [(count + i, same, "x") for i in range(count // 3)]  # a third of all rows is one vector
    rows += [(-100, rows[0][1], "x"), (9000, None, None), (9100, [], "x"), (9200, [None] * size, "x")]
    rows += [(9300, [float("nan")] * size, "x"), (9400, [float("inf")] + [0.0] * (size - 1), "x"), (None, same, "x")]
    return rows + [(9500, [1.0, 2.0], "x"), (9501, [0.5, 2.0], "x"), (9600, [0.0] * size, "x"), (5, same, "x")]


@pytest.mark.parametrize(("tree_rows", "round_queries"), [(1 << 14, 20_000), (50, 3)])
def test_scores_as_by_brute_force(spark, monkeypatch, tree_rows, round_queries):
    monkeypatch.setattr(mtree, "TREE_ROWS", tree_rows)
    monkeypatch.setattr(mtree, "ROUND_QUERIES", round_queries)
    rows = vectors(300, 6, 1)
    table = spark.createDataFrame(rows, SCHEMA)
    found = mtree.top_k(table, table.where("vec_id % 100 = 0"), k=7)
    expected = plain(rows, [r for r in rows if r[0] is not None and r[0] % 100 == 0], 7)
    assert sorted(map(tuple, found.collect())) == expected


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**19 + i), float(2**19 - i), 1.0], "x") for i in range(30)]
    table = spark.createDataFrame(rows, SCHEMA)
    found = mtree.top_k(table, table.where("vec_id = 0"), k=3)
    assert sorted(map(tuple, found.collect())) == plain(rows, rows[:1], 3)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(100, [1.0], "x")], SCHEMA)
    assert mtree.top_k(none, none).collect() == [] and mtree.top_k(some, none).collect() == []
    assert mtree.top_k(some, some).collect() == []


def test_stored_distances_bound_their_subtrees():
    rng = np.random.default_rng(2)
    whole = rng.integers(-1000, 1000, (700, 4))
    tree = mtree.build_tree(np.arange(700), whole)
    assert sorted(tree["ids"].tolist()) == list(range(700))
    norms = (tree["vectors"].astype(float) ** 2).sum(axis=1)
    points = np.column_stack((tree["vectors"], np.sqrt(tree["top"] - norms)))
    for n in range(len(tree["leaf_radius"])):
        own = points[tree["leaf_at"][n] : tree["leaf_at"][n + 1]]
        far = np.sqrt(((own - tree["leaf_centre"][n]) ** 2).sum(axis=1))
        assert far.max() <= tree["leaf_radius"][n] + 1e-6
