"""Exact top-k inner-product search with M-trees.

Within a set of vectors, one more component makes all of them equally long; the nearest
vectors to a query are then those of the highest inner product, so a metric tree serves.
A tree is paged: inner nodes hold leaves, leaves hold vectors, and each has a centre, a
covering radius and, for each child, the stored distance to its centre. A query visits nodes best first. By
the triangle inequality, the stored distances alone rule out most children before a distance
to them is computed; what remains is ruled out by its covering radius.

Vectors are dealt by the nearest of a few sampled pivots, so a tree covers a small region
and whole trees can be ruled out. Every vector is in exactly one tree of at most ``TREE_ROWS``
vectors, one row of the index. Queries are handed out in rounds of at most ``ROUND_QUERIES``;
a task carries the best of a round from tree to tree.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playlens.llm.common import split_count, stored

SCALE = 1024
PIVOTS = 256
TREE_ROWS = 1 << 14
PAGE, FANOUT = 128, 24
ROUND_QUERIES = 20_000
EXACT = 2**52  # products below this are exact in doubles


def quantised(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Usable rows of a list column, their lengths, and floor(1024 x) of their components in a row."""
    sizes = np.diff(column.offsets.to_numpy()).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ok = column.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0)
    sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), sizes, 0)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    scaled = np.floor(flat * SCALE)
    # Beyond the range of longs a component cannot be scored and counts as not finite.
    bad = owner[~(np.abs(scaled) < 2**62)]
    ok[bad] = False
    return np.flatnonzero(ok), sizes[ok], scaled[ok[owner]].astype(np.int64)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def _deal(points: np.ndarray, centres: np.ndarray, most: int) -> list[tuple[int, np.ndarray]]:
    """(centre, members) pages of at most ``most`` points, by nearest centre."""
    near = _distances(points, points[centres]).argmin(axis=1)
    order = np.argsort(near, kind="stable")
    pages = []
    for members in np.split(order, np.flatnonzero(np.diff(near[order])) + 1):
        centre = int(centres[near[members[0]]])
        pages += [(centre, members[i : i + most]) for i in range(0, len(members), most)]
    return pages


def build_tree(ids: np.ndarray, vectors: np.ndarray) -> dict:
    """A tree as plain arrays; ``vectors`` are whole numbers."""
    exact = vectors.astype(np.float64)
    norms = (exact * exact).sum(axis=1)
    top = float(norms.max())
    points = np.column_stack((exact, np.sqrt(top - norms)))
    rng = np.random.default_rng(len(ids))
    seeds = np.sort(rng.choice(len(ids), -(-2 * len(ids) // PAGE), replace=False))
    leaves = _deal(points, seeds, PAGE)
    centres = points[[c for c, _ in leaves]]
    some = np.sort(rng.choice(len(leaves), -(-2 * len(leaves) // FANOUT), replace=False))
    groups = _deal(centres, some, FANOUT)
    order, entry, leaf_at, leaf_radius, leaf_parent, leaf_order = [], [], [0], [], [], []
    inner_at, inner_radius = [0], []
    for centre, members in groups:
        radius = 0.0
        for leaf in members.tolist():
            own = leaves[leaf][1]
            distance = _distances(points[own], centres[[leaf]])[:, 0]
            order.append(own)
            entry.append(distance)
            leaf_at.append(leaf_at[-1] + len(own))
            leaf_radius.append(distance.max())
            leaf_parent.append(float(_distances(centres[[leaf]], centres[[centre]])[0, 0]))
            leaf_order.append(leaf)
            radius = max(radius, float(_distances(points[own], centres[[centre]]).max()))
        inner_at.append(inner_at[-1] + len(members))
        inner_radius.append(radius)
    place = np.concatenate(order)
    small = np.abs(vectors).max() < 2**31
    return {
        "ids": ids[place],
        "vectors": vectors[place].astype(np.int32) if small else vectors[place],
        "top": top,
        "entry": np.concatenate(entry),
        "leaf_at": np.array(leaf_at),
        "leaf_centre": centres[leaf_order],
        "leaf_radius": np.array(leaf_radius),
        "leaf_parent": np.array(leaf_parent),
        "inner_at": np.array(inner_at),
        "inner_centre": centres[[c for c, _ in groups]],
        "inner_radius": np.array(inner_radius),
    }


class Best:
    """The best ``k`` of a query so far, ties to smaller numbers."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids))
        keep = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[keep], ids[keep]

    def reach(self, square: float) -> float:
        """The distance beyond which no vector of a tree can be among the best."""
        if len(self.scores) < self.k:
            return np.inf
        return float(np.sqrt(max(0.0, square - 2.0 * float(self.scores[-1]))))


def search_tree(tree: dict, numbers: np.ndarray, queries: np.ndarray, best: list[Best]) -> None:
    """Betters ``best`` of each query (rows of whole numbers) by the vectors of a tree."""
    vectors, ids = tree["vectors"], tree["ids"]
    largest = float(np.abs(vectors).max()) * float(np.abs(queries).max()) * vectors.shape[1]
    kind = np.float64 if largest < EXACT else np.int64
    vectors, exact = vectors.astype(kind), queries.astype(kind)
    points = np.column_stack((queries.astype(np.float64), np.zeros(len(queries))))
    to_inner = _distances(points, tree["inner_centre"])
    leaf_at, leaf_centre, inner_at = tree["leaf_at"], tree["leaf_centre"], tree["inner_at"]
    leaf_square = (leaf_centre * leaf_centre).sum(axis=1)
    entry, radius, parent = tree["entry"], tree["leaf_radius"], tree["leaf_parent"]
    for i, (number, point, own) in enumerate(zip(numbers.tolist(), points, best)):
        norm = float(point @ point)
        square = norm + tree["top"]
        slack = 1e-6 * (1 + np.sqrt(square))
        reach = own.reach(square) + slack
        bounds = np.maximum(to_inner[i] - tree["inner_radius"], 0)
        heap = [(b, False, n, to_inner[i, n]) for n, b in enumerate(bounds.tolist()) if b <= reach]
        heapq.heapify(heap)
        while heap:
            bound, is_leaf, n, distance = heapq.heappop(heap)
            if bound > reach:
                break
            if not is_leaf:
                low, high = inner_at[n], inner_at[n + 1]
                # Stored distances first: no distance to a child is computed for these.
                left = low + np.flatnonzero(np.abs(distance - parent[low:high]) - radius[low:high] <= reach)
                far = norm + leaf_square[left] - 2 * (leaf_centre[left] @ point)
                far = np.sqrt(np.maximum(far, 0))
                least = np.maximum(far - radius[left], 0)
                for m in np.flatnonzero(least <= reach).tolist():
                    heapq.heappush(heap, (float(least[m]), True, int(left[m]), float(far[m])))
                continue
            low, high = leaf_at[n], leaf_at[n + 1]
            left = low + np.flatnonzero(np.abs(distance - entry[low:high]) <= reach)
            scores = (vectors[left] @ exact[i]).astype(np.int64)
            good = ids[left] != number
            if len(own.scores) == own.k:
                good &= scores >= own.scores[-1]
            if good.any():
                own.add(scores[good], ids[left[good]])
                reach = own.reach(square) + slack


def build_index(vectors: DataFrame, id_col: str, vector_col: str, pivots: int = PIVOTS) -> DataFrame:
    """``(dimension, tree)``: the stored M-trees over every usable row."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")
    ).where("id IS NOT NULL AND vector IS NOT NULL")
    # Pivots only decide which vectors share a tree; any choice gives right results.
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(pivots).select("vector").collect()
    known: dict[int, list] = {}
    for r in sample:
        if r["vector"] and all(x is not None and np.isfinite(x) for x in r["vector"]):
            known.setdefault(len(r["vector"]), []).append(r["vector"])
    points = {size: np.array(v) * SCALE for size, v in known.items()}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            used, sizes, flat = quantised(batch.column(1))
            ids, starts = batch.column(0).to_numpy()[used], np.cumsum(sizes) - sizes
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                block = flat[(starts[own][:, None] + np.arange(size)).ravel()].reshape(-1, size)
                near = np.zeros(len(own), np.int64)
                if size in points:
                    near = _distances(block.astype(np.float64), points[size]).argmin(axis=1)
                raw = [v.tobytes() for v in block]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), size)), pa.array(near), pa.array(ids[own]), pa.array(raw, pa.binary())],
                    ["dimension", "pivot", "id", "raw"],
                )

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tree(size: int, ids: list[np.ndarray], raw: list[bytes]) -> pa.RecordBatch:
            made = build_tree(np.concatenate(ids), np.frombuffer(b"".join(raw), np.int64).reshape(-1, size))
            return pa.RecordBatch.from_arrays(
                [pa.array([size], pa.int64()), pa.array([pickle.dumps(made)], pa.binary())], ["dimension", "tree"]
            )

        held: tuple[int, list, list] | None = None
        for batch in batches:
            sizes, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            raw = batch.column(2).to_pylist()
            cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(sizes)]
            for low, high in zip(cuts, cuts[1:]):
                while low < high:
                    if held and (held[0] != sizes[low] or len(held[2]) >= TREE_ROWS):
                        yield tree(*held)
                        held = None
                    held = held or (int(sizes[low]), [], [])
                    end = min(high, low + TREE_ROWS - len(held[2]))
                    held[1].append(ids[low:end])
                    held[2].extend(raw[low:end])
                    low = end
        if held:
            yield tree(*held)

    dealt = rows.mapInArrow(deal, "dimension long, pivot long, id long, raw binary")
    tie = F.xxhash64("id")
    ordered = dealt.repartitionByRange("dimension", "pivot", tie).sortWithinPartitions("dimension", "pivot", tie)
    return stored(ordered.select("dimension", "id", "raw").mapInArrow(grow, "dimension long, tree binary"), "m-trees")


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest inner products of each query.

    Components become floor(1024 x); scores are whole and exact as long as they fit a long. Ties go
    to the smaller number; a row is no candidate for queries of its own number. Rows whose number or vector is
    NULL, or whose vector is empty or holds a NULL or non-finite component, take no part, and vectors
    meet queries of their own length only. Repeated candidates are listed each; a
    query given twice is answered once for each different vector. No queries or no vectors, no rows.
    """
    index = build_index(vectors, id_col, vector_col)
    asked = stored(
        queries.select(
            F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")
        )
        .where("id IS NOT NULL AND vector IS NOT NULL")
        .distinct(),
        "queries",
    )
    rounds = split_count(asked.count(), ROUND_QUERIES)
    found = None
    for number in range(rounds):
        part = asked.where(F.pmod(F.xxhash64("id"), F.lit(rounds)) == number).toArrow().combine_chunks()
        answers = _round(index, part, k, number)
        answers = stored(answers, "answers") if rounds > 1 else answers
        found = answers if found is None else found.union(answers)
    best = Window.partitionBy("round", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _round(index: DataFrame, part: pa.Table, k: int, number: int) -> DataFrame:
    """The best of every task's trees for one round of queries."""
    by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    if part.num_rows:
        vectors = part.column("vector").combine_chunks()
        used, sizes, flat = quantised(vectors)
        ids, starts = part.column("id").to_numpy()[used], np.cumsum(sizes) - sizes
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            block = flat[(starts[own][:, None] + np.arange(size)).ravel()].reshape(-1, size)
            by_size[int(size)] = (own, ids[own], block)
    shared = index.sparkSession.sparkContext.broadcast(by_size)  # bounded by ROUND_QUERIES

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        best = {size: [Best(k) for _ in own] for size, (own, _, _) in known.items()}
        for batch in batches:
            for size, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if size in known:
                    search_tree(pickle.loads(blob.as_py()), known[size][1], known[size][2], best[size])
        for size, (own, ids, _) in known.items():
            counts = [len(b.ids) for b in best[size]]
            if sum(counts):
                columns = [
                    pa.array(np.full(sum(counts), number)),
                    pa.array(np.repeat(own, counts)),
                    pa.array(np.repeat(ids, counts)),
                    pa.array(np.concatenate([b.ids for b in best[size]])),
                    pa.array(np.concatenate([b.scores for b in best[size]])),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["round", "query", "query_id", "vec_id", "score"])

    return index.mapInArrow(search, "round long, query long, query_id long, vec_id long, score long")
