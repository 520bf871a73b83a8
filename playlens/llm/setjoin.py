"""Documents with alike sets of word shingles (Jaccard), found without a miss by several global orders.

If all sets are read in one order of their elements, two sets with a similarity of at least ``num / den`` share an
element among the first few of each. That holds for every order, so a pair is a candidate only if it shares
such a first element in all of ``ORDERS`` orders. Each order puts frequent elements last, by counts over all
texts that are kept in a hashed array of its own, and breaks ties by a mix of its own.

The first order is an equality join: texts that share a first element form a group, cut where sizes are
too far apart, and equal groups of different elements are one. Near copies share many groups, so each pair is left
to the largest one that both are in, as far as the ``EARLIER`` largest ones of each text tell. Inside a group pairs are held against
sketches of ``SKETCH`` bytes, which bound how many elements differ: whether each of ``8 * SKETCH`` classes has an odd number of a
set's elements, or for sets over ``LONG`` how many each of ``SKETCH`` classes has. Then they are held against finer sketches, about
a bit for each element, and what is left against the other orders' first elements (as 16-bit hashes, which only ever let a pair
through). What passes is verified on the whole sets, nearest partners first; pairs that earlier links joined already are skipped, so a
large group of near copies takes about one pair a member, while no pair in different components goes
untested. Texts are reduced to distinct sequences of words first: copies are never pairs.

Sets are never stored: they would take more room than the texts. They are made where a text is, once for the
counts, once for the first elements and once more, for the texts of candidate pairs alone, to verify.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playlens.llm.common import bounded_batches, discard, gathered, stored
from playlens.llm.components import connected_components
from playlens.operators.sieve import Sieve

ORDERS = 3
SLOT_BITS = 16  # counters of each order, whatever the number of texts
REDUCERS = 16
SKETCH = 64  # bytes
LONG = 1500  # elements of a set whose sketch counts; with more, half of ``8 * SKETCH`` odd classes would prove nothing
FINE_BITS = 20  # the finer sketch has 2**FINE_BITS classes at most
OFTEN = 100  # equal rows of one number
SMALL = 8  # members of a group whose pairs are all tried at once
HELD = 2048  # members of a group that one task holds; larger groups are cut into blocks
CENTRES = 16  # of a group cut into blocks
EARLIER = 16  # groups of a text that its pairs are left to
WINDOWS = ((0, 2), (2, 16), (16, 128), (128, 1 << 62))  # ranks of partners by nearness, tried in rounds
BATCH_BYTES = 4 << 20  # of an Arrow batch
HUB_PAIRS = 500  # pairs of one text that are verified together
# Odd multipliers (a common 64-bit mixer's).
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class Rule(NamedTuple):
    """Shingles of so many words, alike from a similarity of ``num / den`` on: whole numbers, so no rounding."""

    shingle: int
    num: int
    den: int

    def prefix(self, size: int) -> int:
        return size - -(-self.num * size // self.den) + 1


FORM = bytes(0x20 if b == 0x20 or 0x09 <= b <= 0x0D else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
BLOCK = 1 << 15  # bytes of a text hashed at a time


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(MIX[1])
    x = (x ^ (x >> np.uint64(29))) * np.uint64(MIX[2])
    return x ^ (x >> np.uint64(32))


def _powers(base: int, count: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(count, base, np.uint64)])


class _Tables:
    """A value for each byte, and powers of an odd base and of its inverse modulo 2**64."""

    def __init__(self):
        self.size = 0
        self.values = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(MIX[0]))

    def grown(self, size: int) -> "_Tables":
        if size > self.size:
            self.size = max(size, 2 * BLOCK)
            self.up, self.down = _powers(MIX[1], self.size), _powers(pow(MIX[1], -1, 1 << 64), self.size)
        return self


TABLES = _Tables()


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of a text's words, in order: runs of bytes other than ASCII white space, A-Z lower-cased.

    Sums of byte values times powers run over the text; a word's is a difference of two sums, brought
    to the same place. So no word is touched by itself.
    """
    raw = text.encode().translate(FORM) if text else b""
    out, at = [np.empty(0, np.uint64)], 0
    while at < len(raw):
        end = len(raw) if at + BLOCK >= len(raw) else raw.rfind(b" ", at, at + BLOCK)
        if end < at:  # a word longer than a block
            end = raw.find(b" ", at + BLOCK)
            end = len(raw) if end < 0 else end
        part = np.frombuffer(raw, np.uint8, end - at, at)
        blank = np.ones(len(part) + 2, bool)
        np.equal(part, 0x20, out=blank[1:-1])
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        starts, ends = edges[::2], edges[1::2]
        tables = TABLES.grown(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(tables.values[part] * tables.up[: len(part)], out=sums[1:])
        out.append(_mixed((sums[ends] - sums[starts]) * tables.down[starts] + (ends - starts).astype(np.uint64)))
        at = end + 1
    return np.concatenate(out) if len(out) != 2 else out[1]


def text_key(of_words: np.ndarray) -> int:
    """Texts of equal words have equal (signed) keys."""
    return int.from_bytes(xxhash.xxh3_64_digest(of_words.tobytes()), "big", signed=True)


def key_of(text: str | Column) -> Column:
    """The key of each text of a column."""

    @F.arrow_udf("long")
    def key(texts: pa.Array) -> pa.Array:
        return pa.array([text_key(word_hashes(t)) for t in texts.to_pylist()], pa.int64())

    return key(text)


def shingles(of_words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a text of fewer words is one shingle."""
    if not len(of_words):
        return of_words
    size = min(size, len(of_words))
    count = len(of_words) - size + 1
    out = np.full(count, size, np.uint64)
    for i in range(size):
        out = (out ^ of_words[i : i + count]) * np.uint64(MIX[0]) + (out >> np.uint64(29))
    return np.unique(_mixed(out))


def _slots(elements: np.ndarray, order: int) -> np.ndarray:
    return (elements >> np.uint64(order * SLOT_BITS) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


def _frequencies(texts: DataFrame, rule: Rule) -> np.ndarray:
    """Each order's hashed counters over all sets: of fixed size for each task, in ``REDUCERS`` pieces that are added up piece by piece.

    So the driver gets each counter once. Counts only order elements, so a text may count once for each task that holds it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((ORDERS, 1 << SLOT_BITS), np.int64)
        seen: set[int] = set()
        for rows in batches:
            sets = [np.empty(0, np.uint64)]
            for text in rows.column("text").to_pylist():
                of_words = word_hashes(text)
                key = text_key(of_words)
                if key not in seen:
                    seen.add(key)
                    sets.append(shingles(of_words, rule.shingle))
            elements = np.concatenate(sets)
            for order in range(ORDERS):
                total[order] += np.bincount(_slots(elements, order), minlength=1 << SLOT_BITS)
        if total.any():
            pieces = [x.tobytes() for x in np.split(total.astype(np.uint32).ravel(), REDUCERS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(REDUCERS), pa.int32()), pa.array(pieces)], ["piece", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for rows in batches:
            for piece, counts in zip(rows.column(0).to_pylist(), rows.column(1)):
                sums[piece] = sums.get(piece, np.int64(0)) + np.frombuffer(counts.as_buffer(), np.uint32)
        columns = [pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["piece", "counts"])

    form = "piece int, counts binary"
    counts = texts.select("text").mapInArrow(count, form)
    sums = counts.repartition(REDUCERS, "piece").mapInArrow(add, form).collect()  # REDUCERS rows
    total = np.zeros((REDUCERS, (ORDERS << SLOT_BITS) // REDUCERS), np.int64)
    for piece, of_piece in sums:
        total[piece] = np.frombuffer(of_piece, np.int64)
    return total.reshape(ORDERS, -1)


def first_elements(elements: np.ndarray, order: int, weights: np.ndarray, count: int) -> np.ndarray:
    """The first ``count`` of a set in one order, and any that tie with the last: rare ones first, then by a mix."""
    mix = _mixed(elements * np.uint64(2 * order + 3))
    key = weights[order][_slots(elements, order)] << np.uint64(48) | mix >> np.uint64(16)
    return elements[key <= np.partition(key, count - 1)[count - 1]]


def parity_of(elements: np.ndarray, bits: int) -> np.ndarray:
    """For each pattern of so many last bits whether an odd number of elements has it, packed into bytes."""
    classes = (elements & np.uint64((1 << bits) - 1)).astype(np.int64)
    return np.packbits((np.bincount(classes, minlength=1 << bits) & 1).astype(bool), bitorder="little")


def sketch_of(elements: np.ndarray) -> np.ndarray:
    """``SKETCH`` bytes: odd classes, or for sets over ``LONG`` how many elements begin with each pattern, up to 255."""
    if len(elements) <= LONG:
        return parity_of(elements, SKETCH.bit_length() + 2)
    classes = (elements >> np.uint64(65 - SKETCH.bit_length())).astype(np.int64)
    return np.minimum(np.bincount(classes, minlength=SKETCH), 255).astype(np.uint8)


def _apart(x: np.ndarray, m: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How many elements at least two sets differ in, by rows of sketches and the sizes; 0 if the sketches are of two kinds."""
    long_x, long_y = m > LONG, n > LONG
    out = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    out[long_x != long_y] = 0
    both = np.flatnonzero(long_x & long_y)
    if len(both):
        x, y = (v[both] if v.shape[0] == len(out) else v for v in (x, y))
        out[both] = np.abs(x.astype(np.int16) - y).sum(axis=1, dtype=np.int64)
    return out


def fine_bits(size: int) -> int:
    return min(FINE_BITS, max(6, size.bit_length()))


OTHERS = [f"f{order}" for order in range(1, ORDERS)]
CARD = "firsts array<long>, sketch binary, fine binary, " + ", ".join(f"{c} binary" for c in OTHERS)


def _cards(texts: DataFrame, rule: Rule) -> DataFrame:
    """``(doc_id, th, fp, size, firsts, sketch, f1, …)`` of each row of ``texts(doc_id, text, th)``.

    What is compared before a whole set is stands beside a text's first row in its task; elsewhere, and
    beside texts without words, it is NULL.
    """
    weights = (np.log2(_frequencies(texts, rule) + 1.0) * 1024).astype(np.uint64)  # below 2**16
    shared = texts.sparkSession.sparkContext.broadcast(weights)  # of fixed size

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes_of: dict[int, int] = {}
        for rows in batches:
            keys, sizes, firsts, sketches, fine, more = [], [], [], [], [], [[] for _ in OTHERS]
            for text in rows.column("text").to_pylist():
                of_words = word_hashes(text)
                key = text_key(of_words)
                keys.append(key)
                if key in sizes_of or not len(of_words):
                    sizes.append(sizes_of.get(key, 0))
                    for column in (firsts, sketches, fine, *more):
                        column.append(None)
                    continue
                elements = shingles(of_words, rule.shingle)
                sizes_of[key] = len(elements)
                sizes.append(len(elements))
                count = rule.prefix(len(elements))
                firsts.append(first_elements(elements, 0, shared.value, count).view(np.int64))
                sketches.append(sketch_of(elements).tobytes())
                fine.append(parity_of(elements, fine_bits(len(elements))).tobytes())
                for order, column in enumerate(more, 1):
                    found = first_elements(elements, order, shared.value, count)
                    column.append(np.unique((found >> np.uint64(40)).astype(np.uint16)).tobytes())
            columns = [pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), pa.array(firsts, pa.list_(pa.int64()))]
            columns += [pa.array(c, pa.binary()) for c in (sketches, fine, *more)]
            known = [rows.column("doc_id"), rows.column("th")]
            yield pa.RecordBatch.from_arrays([*known, *columns], ["doc_id", "th", "fp", "size", "firsts", "sketch", "fine", *OTHERS])

    return texts.mapInArrow(made, f"doc_id long, th long, fp long, size int, {CARD}")


def _groups_of(rule: Rule):
    """Groups in a stream of ``(e, size, fp)`` in that order: runs of one element and sizes near enough.

    A run's group is named by its members, so elements shared by the same texts give one group. Runs at the
    ends of the stream may go on in another task, and over-long ones are not held: their rows are
    ``open`` and named by the element.
    """

    def name(fps: np.ndarray) -> int:
        return int(_mixed(fps.view(np.uint64) * np.uint64(MIX[0])).sum(dtype=np.uint64).astype(np.int64))

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, ...] | None = None
        known: set[int] = set()
        first, long_run = True, False

        def rows(g, fp, size, is_open) -> pa.RecordBatch:
            columns = [pa.array(g, pa.int64()), pa.array(fp), pa.array(size), pa.array(np.full(len(fp), is_open))]
            return pa.RecordBatch.from_arrays(columns, ["g", "fp", "size", "open"])

        for batch in batches:
            own = tuple(batch.column(c).to_numpy() for c in ("e", "size", "fp"))
            if not len(own[0]):
                continue
            if held is not None:
                own = tuple(np.concatenate(x) for x in zip(held, own))
            e, size, fp = own
            again = np.r_[False, (e[1:] == e[:-1]) & (fp[1:] == fp[:-1])]
            e, size, fp = e[~again], size[~again], fp[~again]
            wide = size[:-1].astype(np.int64) * rule.den < size[1:].astype(np.int64) * rule.num
            starts = np.flatnonzero(np.r_[True, (e[1:] != e[:-1]) | wide])
            ends = np.r_[starts[1:], len(e)]
            out_g, out_at = [], []
            for a, b in zip(starts[:-1].tolist(), ends[:-1].tolist()):
                if first or long_run:
                    yield rows(e[a:b], fp[a:b], size[a:b], True)
                    first = long_run = False
                elif b - a > 1:
                    if b - a > HELD:
                        yield rows(e[a:b], fp[a:b], size[a:b], True)
                        continue
                    g = name(fp[a:b])
                    if g not in known:
                        if len(known) > 1_000_000:
                            known.clear()  # repeats are dropped later anyhow
                        known.add(g)
                        out_g.append(np.full(b - a, g))
                        out_at.append(np.arange(a, b))
            if out_at:
                at = np.concatenate(out_at)
                yield rows(np.concatenate(out_g), fp[at], size[at], False)
            low = int(starts[-1])
            if len(e) - low > HELD:
                yield rows(e[low:], fp[low:], size[low:], True)
                low, long_run = len(e) - 1, True  # the last row stays to be compared with the next
            held = tuple(x[low:] for x in (e, size, fp))
        if held is not None:
            yield rows(held[0], held[2], held[1], True)

    return groups


def _groups(cards: DataFrame, rule: Rule) -> DataFrame:
    """``(g, fp, size, earlier)``: texts that share a first element and may be alike by size; groups have two or more."""
    order = ("e", "size", "fp")
    rows = cards.select(F.explode("firsts").alias("e"), "size", "fp")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    found = stored(dealt.mapInArrow(_groups_of(rule), "g long, fp long, size int, open boolean"), "alike-runs")
    ends = found.where("open").select(F.xxhash64("g").alias("g"), "fp", "size")
    several = ends.groupBy("g").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x <> y").select("g")
    closed = found.where("NOT open").select("g", "fp", "size")
    groups = stored(closed.union(ends.join(several, "g", "left_semi")).distinct(), "alike-groups")
    once = stored(_without_repeats(groups), "alike-groups")
    discard(found, groups)
    return once


def _without_repeats(groups: DataFrame) -> DataFrame:
    """The groups ``(g, fp, size)`` that hold a pair of their own, with ``earlier``, the larger groups of a text.

    Groups stand in one order, largest first, and a pair belongs to the first one that has both texts. A group
    whose members all begin with one and the same other group lies within it and has no pair of its own. Of
    the others a text names ``EARLIER`` at most: a pair may come up again then, but none is lost.
    """
    ranked = groups.join(groups.groupBy("g").agg((-F.count("*")).alias("k")), "g")
    of_text = ranked.groupBy("fp").agg(F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("k", "g"))).alias("all"))
    rows = of_text.select("fp", "size", F.slice("all.g", 1, EARLIER).alias("top"), F.posexplode("all.g").alias("place", "g"))
    rows = rows.select("g", "fp", "size", F.get("top", F.lit(0)).alias("first"), F.expr("slice(top, 1, place)").alias("earlier"))
    rows = stored(rows, "alike-ranked")
    of_group = rows.groupBy("g").agg(F.min("first").alias("x"), F.max("first").alias("y"))
    own = of_group.where("x <> y OR x = g").select("g")
    return rows.drop("first").join(own, "g", "left_semi")


def _near(rule: Rule, sketch: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether pairs may be alike: sets differ in at least as many elements as their sketches."""
    total = size[i].astype(np.int64) + size[j]
    apart = _apart(sketch[i], size[i], sketch[j], size[j])
    return (rule.den + rule.num) * apart <= (rule.den - rule.num) * total


def _partners(rule: Rule, sketch: np.ndarray, size: np.ndarray, root: np.ndarray, earlier: tuple[np.ndarray, np.ndarray], low: int, high: int):
    """Pairs of a group whose rank by nearness is in a window, and whether later ones are left.

    ``earlier`` has the other groups that members' pairs are left to, numbered, and where each member's begin and the last end.
    """
    left, right, more = [], [], False
    size = size.astype(np.int64)
    numbers, begin = earlier
    marked = np.zeros(int(numbers.max(initial=-1)) + 1, bool)
    for i in range(len(size)):
        fit = (size[i] * rule.den >= size * rule.num) & (size * rule.den >= size[i] * rule.num)
        fit[i] = False
        if begin[i + 1] > begin[i]:
            own = numbers[begin[i] : begin[i + 1]]
            marked[own] = True
            met = np.r_[0, np.cumsum(marked[numbers])]
            fit &= met[begin[1:]] == met[begin[:-1]]
            marked[own] = False
        at = np.flatnonzero(fit)
        apart = _apart(sketch[at], size[at], sketch[i : i + 1], size[i : i + 1])
        total = size[at] + size[i]
        may = (rule.den + rule.num) * apart <= (rule.den - rule.num) * total
        at, share = at[may], apart[may] / total[may]
        ranked = at[np.argsort(share, kind="stable")]
        new = root[ranked] != root[i]
        chosen = ranked[low:high][new[low:high]]
        more = more or bool(new[high:].any())
        left.append(np.full(len(chosen), i))
        right.append(chosen)
    return np.concatenate(left), np.concatenate(right), more


def _candidates_of(rule: Rule, window: tuple[int, int]):
    """Candidate pairs in a stream of groups: ``(low, high, hub)``, or ``g`` alone where pairs are left for later."""
    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
            g, block, fp, root, size = (table.column(c).to_numpy() for c in ("g", "block", "fp", "root", "size"))
            home = table.column("home").to_numpy()
            lists = table.column("earlier").combine_chunks()
            begin = np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]
            others = lists.flatten().to_numpy()
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
            starts = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (block[1:] != block[:-1])])
            counts = np.diff(np.r_[starts, len(g)])
            left, right, left_over = [], [], []
            if window[0] == 0:
                for k in range(2, SMALL + 1):
                    own = starts[counts == k]
                    for x in range(k):
                        for y in range(x + 1, k):
                            i, j = own + x, own + y
                            new = (root[i] != root[j]) & (home[i] | home[j])
                            i, j = i[new], j[new]
                            fit = _near(rule, sketch, size, i, j)
                            for a, b in zip(i[fit].tolist(), j[fit].tolist()):
                                if not np.isin(others[begin[a] : begin[a + 1]], others[begin[b] : begin[b + 1]]).any():
                                    left.append([a])
                                    right.append([b])
            for start, k in zip(starts[counts > SMALL].tolist(), counts[counts > SMALL].tolist()):
                part = slice(start, start + k)
                if (root[part] == root[start]).all():
                    continue
                low, high = window if block[start] < 0 else (0, 1 << 62)
                numbers = np.unique(others[begin[start] : begin[start + k]], return_inverse=True)[1]
                earlier = (numbers, begin[start : start + k + 1] - begin[start])
                i, j, more = _partners(rule, sketch[part], size[part], root[part], earlier, low, high)
                i, j = np.unique(np.stack([np.minimum(i, j), np.maximum(i, j)], axis=1), axis=0).T
                use = home[part][i] | home[part][j]
                left.append(i[use] + start)
                right.append(j[use] + start)
                if more:
                    left_over.append(int(g[start]))
            empty = np.empty(0, np.int64)
            i, j = np.concatenate([empty, *left]).astype(np.int64), np.concatenate([empty, *right]).astype(np.int64)
            degree = np.bincount(np.r_[i, j], minlength=len(fp))
            low, high = np.minimum(fp[i], fp[j]), np.maximum(fp[i], fp[j])
            hub = np.where(degree[i] >= degree[j], fp[i], fp[j])
            columns = [pa.array(low), pa.array(high), pa.array(hub), pa.nulls(len(low), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["low", "high", "hub", "g"])
            if left_over:
                none = pa.nulls(len(left_over), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, none, pa.array(left_over, pa.int64())], ["low", "high", "hub", "g"])

        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            g, block = held.column("g").to_numpy(), held.column("block").to_numpy()
            last = int(np.flatnonzero((g != g[-1]) | (block != block[-1]))[-1]) + 1 if (g[0], block[0]) != (g[-1], block[-1]) else 0
            if last:
                yield from pairs(held.slice(0, last))
                held = held.slice(last).combine_chunks()
        if held is not None:
            yield from pairs(held)

    return candidates


CANDIDATE = "low long, high long, hub long, g long"


def _centre_pairs(rows: DataFrame, rule: Rule) -> DataFrame:
    """For each member of an over-long group, its two nearest of a few centres, chosen by hash."""
    order = Window.partitionBy("g").orderBy(F.xxhash64("fp"), "fp")
    centres = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= CENTRES)
    centres = centres.select("g", *[F.col(c).alias(f"{c}_c") for c in ("fp", "size", "sketch")])

    @F.arrow_udf("double")
    def apart(a: pa.Array, b: pa.Array, m: pa.Array, n: pa.Array) -> pa.Array:
        if not len(a):
            return pa.array([], pa.float64())
        x, y = (np.frombuffer(b"".join(v.to_pylist()), np.uint8).reshape(-1, SKETCH) for v in (a, b))
        total = m.to_numpy().astype(np.int64) + n.to_numpy()
        far = _apart(x, m.to_numpy(), y, n.to_numpy())
        may = (rule.den + rule.num) * far <= (rule.den - rule.num) * total
        return pa.array(np.where(may, far / total, 2.0))

    both = rows.join(centres, "g").where("fp <> fp_c").withColumn("far", apart("sketch", "sketch_c", "size", "size_c"))
    near = both.where("far < 2").groupBy("g", "fp").agg(F.min(F.struct("far", "fp_c")).alias("one"))
    pair = near.select("fp", F.col("one.fp_c").alias("hub"))
    none = F.lit(None).cast("long").alias("g")
    return pair.select(F.least("fp", "hub").alias("low"), F.greatest("fp", "hub").alias("high"), "hub", none)


def _blocks(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Over-long groups in blocks: members outside a group's main component visit every block."""
    of_root = rows.groupBy("g", "root").count()
    main = of_root.groupBy("g").agg(F.max_by("root", F.struct("count", "root")).alias("main"))
    blocks = counts.join(main, "g").select("g", "main", F.ceil(F.col("k") * 2 / F.lit(HELD)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    visited = F.when(F.col("root") == F.col("main"), F.array("own")).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = rows.drop("block", "home").join(blocks, "g").withColumn("own", own).withColumn("block", F.explode(visited))
    return dealt.withColumn("home", F.col("block") == F.col("own")).select(*rows.columns)


def _share(x: bytes, y: bytes) -> bool:
    """Whether two sorted sets of 16-bit numbers have one in common."""
    x, y = np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16)
    return bool((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).any())


def _may_be_alike(rule: Rule, x: bytes, y: bytes, total: int) -> bool:
    """False only for sets that are not: by odd classes, the longer sketch folded to the shorter one's."""
    x, y = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    apart = int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)))).sum())
    return (rule.den + rule.num) * apart <= (rule.den - rule.num) * total


def _compared(pairs: DataFrame, cards: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Stored ``pairs(a, b)`` with columns of the cards of both texts, and these cards, which are stored too."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("fp"))
    own = cards.where("sketch IS NOT NULL").select("fp", *columns).join(wanted, "fp", "left_semi")
    own = stored(own.groupBy("fp").agg(*[F.first(c).alias(c) for c in columns]), "alike-compared")
    left, right = (own.select(F.col("fp").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in columns]) for x in "ab")
    return pairs.join(left, "a").join(right, "b"), own


def _passing(pairs: DataFrame, cards: DataFrame, rule: Rule) -> DataFrame:
    """Pairs ``(a, b)`` whose fine sketches are near and that share a first element in every other order.

    First elements take most room beside a long text and tell least there, so only the pairs that sketches leave meet them.
    """

    @F.arrow_udf("boolean")
    def near(m: pa.Array, n: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
        totals = (m.to_numpy().astype(np.int64) + n.to_numpy()).tolist() if len(m) else []
        out = [_may_be_alike(rule, x[i].as_buffer(), y[i].as_buffer(), total) for i, total in enumerate(totals)]
        return pa.array(out, pa.bool_())

    @F.arrow_udf("boolean")
    def share(*firsts: pa.Array) -> pa.Array:
        both = list(zip(firsts[::2], firsts[1::2]))
        out = [all(_share(p[i].as_buffer(), q[i].as_buffer()) for p, q in both) for i in range(len(firsts[0]))]
        return pa.array(out, pa.bool_())

    both, own = _compared(pairs.select("a", "b"), cards, ["size", "fine"])
    left = stored(both.where(near("size_a", "size_b", "fine_a", "fine_b")).select("a", "b"), "alike-near")
    discard(own)
    both, own = _compared(left, cards, OTHERS)
    kept = stored(both.where(share(*[f"{c}_{x}" for c in OTHERS for x in "ab"])).select("a", "b"), "alike-passing")
    discard(left, own)
    return kept


def _sent(pairs: DataFrame, texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(a, block, b, text)``: each pair's member with its text, and (``b`` NULL) the hub's once for ``HUB_PAIRS`` of them.

    Of the copies of a text one is read, found by the number and hash that ``nodes`` name; only rows that may be among the
    wanted ones, as a bitmap tells, leave their task, so copies under other numbers stay.
    """
    many = gathered(pairs).groupBy("a").agg(F.ceil(F.count("*") / F.lit(HUB_PAIRS)).cast("int").alias("blocks"))
    many = stored(many, "alike-hubs")
    members = pairs.join(many, "a").select("a", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"), "b", F.col("b").alias("fp"))
    hubs = many.select("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("long").alias("b"), F.col("a").alias("fp"))
    needed = stored(members.union(hubs), "alike-needed")
    sent = stored(needed.join(nodes, "fp").select("a", "block", "b", "n", "doc_id", "th"), "alike-sent")
    discard(many, needed)
    row = F.xxhash64("th", "doc_id")
    some = Sieve(gathered(sent).select(row)).among(texts, row).alias("t")
    same = (F.col("t.th") == F.col("s.th")) & F.col("t.doc_id").eqNullSafe(F.col("s.doc_id"))
    found = some.join(sent.where(F.col("n") <= OFTEN).alias("s"), same).select("a", "block", "b", "text")
    often = sent.where(F.col("n") > OFTEN)
    if not often.isEmpty():  # equal rows of one number: made one before they leave their task
        once = some.join(often.select("th").distinct(), "th", "left_semi").groupBy("th").agg(F.first("text").alias("text"))
        found = found.union(once.join(often, "th").select("a", "block", "b", "text"))
    return found


def _verified(found: DataFrame, texts: DataFrame, cards: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """The candidate pairs that are alike, as links ``(a, b)``."""
    once = gathered(found.where("low IS NOT NULL")).groupBy("low", "high").agg(F.max("hub").alias("a"))
    pairs = stored(once.select("a", (F.expr("CASE WHEN a = low THEN high ELSE low END")).alias("b")), "alike-pairs")
    kept = _passing(pairs, cards, rule)
    if kept.isEmpty():
        discard(pairs)
        return kept
    dealt = _sent(kept, texts, nodes).repartition("a", "block")
    dealt = dealt.sortWithinPartitions("a", "block", F.col("b").asc_nulls_first())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_of = None, None
        for rows in batches:
            left, right = [], []
            ids = zip(rows.column("a").to_pylist(), rows.column("b").to_pylist())
            for (a, b), text in zip(ids, rows.column("text")):
                own = shingles(word_hashes(text.as_py()), rule.shingle)
                if b is None:
                    hub, hub_of = own, a
                    continue
                if a != hub_of or not len(own) or not len(hub):
                    continue
                place = np.minimum(np.searchsorted(hub, own), len(hub) - 1)
                both = int((hub[place] == own).sum())
                if rule.den * both >= rule.num * (len(hub) + len(own) - both):
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    links = stored(dealt.mapInArrow(judge, "a long, b long"), "alike-links")
    discard(pairs, kept)
    return links


def alike_links(texts: DataFrame, cards: DataFrame, nodes: DataFrame, rule: Rule, seeds: DataFrame | None = None) -> DataFrame:
    """``(node, root)`` of all texts that have a link, from ``texts(th, text)`` and their ``cards``.

    ``nodes`` name the row ``(n, doc_id, th)`` to read each text in; ``seeds`` are pairs ``(low, high, hub)`` to be tried first.
    """
    spark = texts.sparkSession
    groups = _groups(cards.where("sketch IS NOT NULL"), rule)
    counts = stored(groups.groupBy("g").agg(F.count("*").alias("k")).where(F.col("k") > HELD), "alike-long")
    any_long = not counts.isEmpty()
    in_groups = groups.select("fp").distinct()
    sketches = cards.where("sketch IS NOT NULL").select("fp", "sketch").join(in_groups, "fp", "left_semi")
    single = stored(sketches.groupBy("fp").agg(F.first("sketch").alias("sketch")), "alike-sketches")
    roots = stored(spark.createDataFrame([], "node long, root long"), "alike-roots")

    def linked(roots: DataFrame, found: DataFrame) -> DataFrame:
        """The roots after the links among ``found``, by way of the roots so far."""
        if found.where("low IS NOT NULL").isEmpty():
            return roots
        links = _verified(found, texts, cards, nodes, rule)
        if links.isEmpty():
            discard(links)
            return roots
        edges = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links)
        out = stored(connected_components(edges, "a", "b"), "alike-roots")
        discard(roots, links)
        return out

    if seeds is not None:
        roots = linked(roots, seeds)

    def rooted(groups: DataFrame) -> DataFrame:
        out = groups.select("g", "fp", "size", "earlier").join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        return out.select("g", "fp", "size", "earlier", F.coalesce("root", "fp").alias("root"))

    for number, window in enumerate(WINDOWS):
        known = groups if number else rooted(groups)
        if number:
            mixed = gathered(known.select("g", "root")).groupBy("g").agg(F.min("root").alias("x"), F.max("root").alias("y"))
            mixed = stored(mixed.where("x <> y").select("g"), "alike-mixed")
            if mixed.isEmpty():
                break
            known = known.join(mixed, "g", "left_semi")
        known = known.join(single, "fp").withColumn("block", F.lit(-1)).withColumn("home", F.lit(True))
        plain = known.join(counts, "g", "left_anti") if any_long else known
        order = ("g", "block", "fp")
        dealt = plain.select("g", "block", *[c for c in known.columns if c not in ("g", "block")])
        dealt = dealt.repartition("g").sortWithinPartitions(*order)
        found = dealt.mapInArrow(_candidates_of(rule, window), CANDIDATE)
        if any_long:
            long = known.join(counts.select("g"), "g", "left_semi")
            if number == 0:
                found = found.union(_centre_pairs(long, rule))
            elif number == 1:
                blocks = _blocks(long, counts).repartition("g", "block").sortWithinPartitions(*order)
                found = found.union(blocks.mapInArrow(_candidates_of(rule, (0, 1 << 62)), CANDIDATE))
        found = stored(found, "alike-candidates")
        left = stored(found.where("g IS NOT NULL").select("g"), "alike-left")
        roots = linked(roots, found)
        if number == 0 and any_long:
            left = left.union(counts.select("g"))
        before, groups = groups, stored(rooted(groups.join(left, "g", "left_semi")), "alike-groups")
        discard(before, found)
    discard(groups, counts, single)
    return roots


def similar_documents(docs: DataFrame, rule: Rule, seeds: DataFrame | None = None) -> DataFrame:
    """``(doc_id, n_shingles, fp, component_id, keeper)`` for each row of ``docs(doc_id, text, …)``.

    Texts are linked if the Jaccard similarity of their sets of shingles is ``rule.num / rule.den`` or more;
    ``component_id`` is the least number among all documents that links reach, NULL if none has one, and ``keeper`` the
    ``fp`` of that document (the least, if it has several in the group or none has a number). ``fp`` is a 64-bit
    hash of the text's words: equal words are one text. Texts without words (NULL, empty) have the
    same ``fp`` and ``n_shingles`` 0; a text of fewer words than a shingle is one shingle; very long texts
    are read whole. Repeated rows come back as often as they were given, and columns
    other than these two are not read. ``seeds(low, high, hub)`` are pairs of ``fp`` that another operator
    found; they are verified like all others and only spare later ones. An empty table gives no rows.
    """
    texts = bounded_batches(docs, BATCH_BYTES).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.withColumn("th", F.xxhash64("text"))
    cards = stored(_cards(texts, rule), "alike-cards")
    rows = stored(cards.select("doc_id", "fp", "size"), "alike-rows")
    equal = cards.groupBy("fp", "doc_id", "th").agg(F.count("*").alias("n"))
    nodes = equal.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.min(F.struct("n", "doc_id", "th")).alias("one"))
    nodes = stored(nodes.select("fp", "first_id", "one.*"), "alike-nodes")
    roots = alike_links(texts, cards, nodes, rule, seeds)
    linked = roots.join(nodes, roots.node == nodes.fp).select("fp", "root", "first_id")
    first = F.min_by("fp", F.struct(F.isnull("first_id"), "first_id", "fp"))
    least = linked.groupBy("root").agg(F.min("first_id").alias("linked_id"), first.alias("linked_fp"))
    of_linked = linked.join(least, "root").select("fp", "linked_id", "linked_fp")
    classes = nodes.select("fp", "first_id").join(of_linked, "fp", "left").select(
        "fp", F.coalesce("linked_id", "first_id").alias("component_id"), F.coalesce("linked_fp", "fp").alias("keeper")
    )
    # Written, so that the last join is one that can split a hot text.
    classes = stored(classes, "alike-classes")
    discard(cards, nodes)
    return rows.join(classes, "fp").select("doc_id", F.col("size").cast("long").alias("n_shingles"), "fp", "component_id", "keeper")
