"""Balanced shards by label propagation under quotas, with built-in functions only.

Documents start in shards of equal counts. In each round every group of linked documents
names the shard that holds most of it, and its members elsewhere want to move there.
How many may move between two shards is a quota: a shard takes no more than it can
make up for by sending documents without links the other way, so the counts stay as
they are. At first a group names the shard that holds most of it; where that no longer helps, any of its shards by a
hash of the round, so that opposite moves arise and cancel. The rounds end when no group is split or
``PATIENCE`` rounds in a row bring no group into fewer shards.

Sizes per group and shard are combined before they are shuffled. A group larger than a
quarter of a shard is cut into parts by a hash, so that a group with a third of all rows
fills several shards instead of blocking one. The driver sees the matrix of counts
between shards, nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playlens.llm.common import discard, split_count, stored

PART_ROWS = 100_000
PATIENCE = 10


def numbered(df: DataFrame, keys: list[str], place: Column, order: list[str], rows: int, name: str) -> DataFrame:
    """``df`` with a gapless number from 0 within each key.

    Rows of a key are spread over buckets by the hash ``place``; a bucket is numbered by
    itself and starts where the buckets before it end, so no task sorts a whole key.
    """
    buckets = split_count(rows, PART_ROWS)
    spread = df.withColumn("bucket_", F.pmod(place, F.lit(buckets)))
    own = [*keys, "bucket_"]
    counts = spread.groupBy(*own).agg(F.count("*").alias("count_"))
    before = Window.partitionBy(*keys).orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*own, F.coalesce(F.sum("count_").over(before), F.lit(0)).alias("start_"))
    within = F.row_number().over(Window.partitionBy(*own).orderBy(*order))
    match = spread.withColumn("within_", within).alias("a").join(
        starts.alias("b"), [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in own]
    )
    number = (F.col("b.start_") + F.col("within_") - 1).cast("long")
    return match.select(*[F.col(f"a.{c}") for c in df.columns], number.alias(name))


def quotas(want: list[list[int]], free: list[int]) -> tuple[list[list[int]], list[list[tuple[int, int]]]]:
    """Moves allowed between shards, and where each shard's unlinked documents go in exchange.

    The second value lists ``(end, shard)`` for each shard: its unlinked document number n
    goes to the first listed shard with n < end, or stays.
    """
    count = len(free)
    moves = [row[:] for row in want]

    def gain(j: int) -> int:
        return sum(moves[i][j] for i in range(count)) - sum(moves[j])

    while True:
        over = [(gain(j) - free[j], j) for j in range(count)]
        excess, j = max(over)
        if excess <= 0:
            break
        for i in sorted(range(count), key=lambda i: -moves[i][j]):
            cut = min(excess, moves[i][j])
            moves[i][j] -= cut
            excess -= cut
    net = [gain(j) for j in range(count)]
    flows: list[list[tuple[int, int]]] = [[] for _ in range(count)]
    for j in range(count):
        sent = 0
        for i in range(count):
            if net[j] > 0 and net[i] < 0:
                part = min(net[j], -net[i])
                net[j] -= part
                net[i] += part
                sent += part
                flows[j].append((sent, i))
    return moves, flows


def _initial(rows: DataFrame, total: int, shards: int) -> DataFrame:
    """Row, group (NULL: no links), its part key and the first shard."""
    sizes = stored(
        rows.where("group_ IS NOT NULL").groupBy("group_").agg(F.count("*").alias("n_")).where("n_ > 1"), "groups"
    )
    quarter = max(1, total // (4 * shards))
    linked = rows.join(sizes, "group_", "left")
    parts = F.ceil(F.col("n_") / F.lit(quarter))
    part = F.pmod(F.xxhash64("tie_"), parts)
    linked = linked.withColumn("unit_", F.when(F.col("n_").isNotNull(), F.xxhash64("group_", part)))
    # Members of a large unit are spread over several buckets when they are counted off.
    lanes = F.ceil(F.least(F.col("n_"), F.lit(quarter)) / F.lit(PART_ROWS))
    lane = F.pmod(F.xxhash64("tie_", F.lit(1)), lanes)
    place = F.when(F.col("unit_").isNull(), F.xxhash64("tie_")).otherwise(F.xxhash64("unit_", lane))
    linked = stored(linked.withColumn("place_", place).drop("n_"), "units")
    first = numbered(linked, [], F.xxhash64("tie_"), ["tie_"], total, "n_")
    return stored(first.withColumn("shard_", (F.col("n_") % shards).cast("int")).drop("n_"), "shards")


def balanced_shards(
    docs: DataFrame, group: Column, shards: int = 16, patience: int = PATIENCE, id_col: str = "doc_id"
) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    ``group`` links the documents that share its value; NULL links nothing. Counts of
    shards differ by one at most, whatever the links. Groups stay together unless the
    counts forbid it, they exceed a quarter of a shard, or no moves that keep the counts were found in ``patience``
    rounds; ``split_groups`` tells which did not. Repeated rows are documents of
    their own, a NULL number is one like any other, texts are not read, and an empty table gives no rows. Columns
    named ``shard`` or ``slot`` are replaced; all others stay.
    """
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    # The row number spreads repeated rows; it is written, so it stays what it is.
    tie = F.xxhash64(F.col(id_col), group, F.monotonically_increasing_id())
    rows = stored(docs.select(*columns, group.alias("group_"), tie.alias("tie_")), "to-shard")
    total = rows.count()
    state = _initial(rows, total, shards)
    discard(rows)
    full: list[int] = []
    least, stalled, number = None, 0, 0
    while True:
        held = state.where("unit_ IS NOT NULL").groupBy("unit_", "shard_").agg(F.count("*").alias("n_"))
        held = stored(held, "held")
        parts = held.agg(F.count("*") - F.count_distinct("unit_")).first()[0]
        if parts == 0:
            break
        stalled = 0 if least is None or parts < least else stalled + 1
        least = parts if least is None else min(least, parts)
        if stalled > patience:
            break
        by_majority = stalled == 0
        named = held.withColumn("parts_", F.count("*").over(Window.partitionBy("unit_")))
        # A shard without room is named only by units that are wholly in it.
        open_ = ~F.col("shard_").isin(full) if full and by_majority else F.lit(True)
        by_hash = F.xxhash64("unit_", "shard_", F.lit(number))
        best = F.max_by("shard_", F.struct("n_", by_hash) if by_majority else by_hash)
        named = named.where(open_ | (F.col("parts_") == 1))
        target = stored(named.groupBy("unit_").agg(best.alias("want_")), "targets")
        wanted = stored(state.join(target, "unit_", "left").select(*state.columns, "want_"), "wants")
        matrix = [[0] * shards for _ in range(shards)]
        free = [0] * shards
        for r in wanted.groupBy("shard_", "want_", F.isnull("unit_").alias("free_")).count().collect():
            if r["free_"]:
                free[r["shard_"]] += r["count"]
            elif r["want_"] is not None and r["want_"] != r["shard_"]:
                matrix[r["shard_"]][r["want_"]] += r["count"]
        moves, flows = quotas(matrix, free)
        number += 1
        full = [j for j in range(shards) if sum(matrix[i][j] - moves[i][j] for i in range(shards))]
        if not any(map(sum, moves)):
            discard(held, target, wanted)
            continue
        kind = F.when(F.col("unit_").isNull(), -1).otherwise(F.coalesce("want_", "shard_"))
        counted = numbered(
            wanted.withColumn("kind_", kind), ["shard_", "kind_"], F.col("place_"), ["unit_", "tie_"], total, "n_"
        )
        allowed = F.expr("array(" + ",".join(f"{m}L" for row in moves for m in row) + ")")
        goes = F.col("n_") < F.get(allowed, F.col("shard_") * shards + F.col("kind_"))
        shard = F.when((F.col("kind_") >= 0) & (F.col("kind_") != F.col("shard_")) & goes, F.col("kind_"))
        for j, ends in enumerate(flows):
            for end, to in ends:
                shard = shard.when((F.col("kind_") == -1) & (F.col("shard_") == j) & (F.col("n_") < end), to)
        moved = shard.otherwise(F.col("shard_")).cast("int")
        before, state = state, stored(counted.withColumn("shard_", moved).select(*state.columns), "shards")
        discard(before, held, target, wanted)
    slots = numbered(state, ["shard_"], F.xxhash64("tie_"), ["tie_"], total, "slot")
    back = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    return slots.select(*back, F.col("shard_").alias("shard"), "slot")


def split_groups(dealt: DataFrame, group: Column) -> DataFrame:
    """``(group, n, n_shards)`` of the groups that ended in more than one shard."""
    of_shard = dealt.where(group.isNotNull()).groupBy(group.alias("group"), "shard").agg(F.count("*").alias("n"))
    return of_shard.groupBy("group").agg(F.sum("n").alias("n"), F.count("*").alias("n_shards")).where("n_shards > 1")
