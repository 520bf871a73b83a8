"""Benchmark decontamination with built-in functions only.

The windows of the benchmark's items become a hash set that travels inside the plan: a
set of 64-bit hashes for the scan and a bucket table of the windows themselves for the
verification. Each document is split into words once and its windows are hashed in
place; no word or window row is ever made, and documents are not shuffled. Windows are
handed out in blocks of at most ``BLOCK_WINDOWS``; a larger benchmark takes more passes,
each over what the last one wrote.

A window stands for its set of items by one number, the sum of their hashes, so neither the plan nor a hit grows with
the items that share a passage. Which items these are is joined afterwards, once for every
combination of sets that occurs.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import drop_shuffles, split_count, stored

BLOCK_WINDOWS = 50_000

# The ASCII characters that separate words, upper-case letters apart.
SEPARATORS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

HITS = "array<struct<at:int,size:int,set:bigint>>"
ENTRY = "struct<h:bigint,w:string,set:bigint>"


def words(text: Column) -> Column:
    """Words with A-Z lower-cased; no words for NULL."""
    parts = F.split(F.translate(text, UPPER, LOWER), f"[{SEPARATORS}]+")
    return F.coalesce(F.array_remove(parts, ""), F.array().cast("array<string>"))


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for each row, not once for each place it stands in."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _window_hash(of_words: Column, start: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(of_words, start + i) for i in range(size)])


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """``(size, h, w, item_id)``: every window of every item once, ``w`` its words joined by blanks."""
    known = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("words"))
    known = known.where(F.size("words") > 0).withColumn("size", F.least(F.size("words"), F.lit(window)))
    at = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1))
    rows = known.select("item_id", "size", "words", at.alias("at"))
    cut = rows.select("item_id", "size", F.slice("words", F.col("at"), F.col("size")).alias("cut"))
    hashes = F.lit(None).cast("long")
    for size in range(1, window + 1):
        hashes = F.when(F.col("size") == size, _window_hash(F.col("cut"), F.lit(0), size)).otherwise(hashes)
    named = cut.select("size", hashes.alias("h"), F.array_join("cut", " ").alias("w"), "item_id")
    return named.distinct()


def item_sets(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(size, h, w, set)`` of each window, and ``(set, item_id)`` of each set."""
    one = F.xxhash64("item_id").cast("decimal(20,0)")
    total = F.xxhash64(F.sum(one), F.count(F.lit(1)))  # no list is made
    sets = stored(windows.groupBy("size", "h", "w").agg(total.alias("set")), "windows")
    members = windows.join(sets, ["size", "h", "w"]).where("item_id IS NOT NULL").select("set", "item_id").distinct()
    return sets, stored(members, "window-items")


def _scan(of_words: Column, size: int, entries: list) -> Column:
    """Verified hits of one window length within a row's words."""
    buckets: list[list] = [[] for _ in entries]
    for e in entries:
        buckets[e["h"] % len(buckets)].append({"h": e["h"], "w": e["w"], "set": e["set"]})
    kept = F.from_json(F.lit(json.dumps(buckets)), f"array<array<{ENTRY}>>")
    hashes = [e["h"] for e in entries]

    def entry(at: Column) -> Column:
        """Windows of the benchmark equal to the one here, word by word."""
        text = F.array_join(F.slice(of_words, at + 1, F.lit(size)), " ")
        bucket = F.get(kept, F.pmod(_window_hash(of_words, at, size), F.lit(len(buckets))).cast("int"))
        return F.filter(bucket, lambda e: e["w"] == text)

    def own_set(at: Column) -> Column:
        return F.get(entry(at), F.lit(0))["set"]

    starts = F.when(F.size(of_words) >= size, F.sequence(F.lit(0), F.size(of_words) - size))
    starts = F.coalesce(starts, F.array().cast("array<int>"))
    known = F.filter(starts, lambda i: _window_hash(of_words, i, size).isin(hashes))
    verified = F.filter(known, lambda i: F.size(entry(i)) > 0)
    return F.transform(verified, lambda i: F.struct(i.alias("at"), F.lit(size).alias("size"), own_set(i).alias("set")))


def _scanner(by_size: dict[int, list]):
    """Number of words and hits of a row's words."""

    def scan(of_words: Column) -> Column:
        found = [_scan(of_words, size, by_size[size]).cast(HITS) for size in sorted(by_size)]
        hits = F.concat(*found) if found else F.array().cast(HITS)
        return F.struct(F.size(of_words).cast("long").alias("n_words"), hits.alias("hits"))

    return scan


def find_hits(docs: DataFrame, windows: DataFrame, block: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with ``n_words`` and ``hits``: where item windows occur, and of which sets of items."""
    blocks = split_count(windows.count(), block)
    out = docs.withColumn("hits", F.array().cast(HITS)).withColumn("n_words", F.lit(0).cast("long"))
    for number in range(blocks):
        part = windows.where(F.pmod("h", F.lit(blocks)) == number).collect()
        by_size: dict[int, list] = {}
        for e in part:
            by_size.setdefault(e["size"], []).append(e)
        out = stored(out, "hits") if number else out
        out = out.withColumn("scan", _once(words(F.col("text")), _scanner(by_size)))
        out = out.withColumn("hits", F.concat("hits", "scan.hits")).withColumn("n_words", F.col("scan.n_words"))
        out = out.drop("scan")
    return out


def _without_spans(text: Column, hits: Column) -> Column:
    """The text without the words of the hits and what stands before each of them."""
    own = F.array_remove(F.split(text, f"[{SEPARATORS}]+"), "")
    between = F.split(text, f"[^{SEPARATORS}]+")
    gone = F.array_distinct(F.flatten(F.transform(hits, lambda x: F.sequence(x["at"], x["at"] + x["size"] - 1))))

    def rebuilt(parts: Column) -> Column:
        kept = F.transform(
            parts["own"],
            lambda w, i: F.when(F.array_contains(parts["gone"], i), "").otherwise(F.concat(F.get(parts["between"], i), w)),
        )
        return F.concat(F.array_join(kept, ""), F.element_at(parts["between"], -1))

    parts = F.struct(own.alias("own"), between.alias("between"), gone.alias("gone"))
    return F.when(F.size(hits) > 0, _once(parts, rebuilt)).otherwise(text)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    share: int = 20,
    remove: str | None = None,
    block: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``docs(doc_id, text, …)`` judged against ``benchmark(item_id, text)``.

    Added: ``n_words``, ``n_hit`` (words inside any occurrence of an item window),
    ``items`` (numbers of those items, sorted as text) and ``contaminated`` (a hit, and at
    least one word in ``share`` is hit). A window is ``window`` consecutive words of an item, or
    all words of a shorter item. ``remove="documents"`` drops contaminated rows;
    ``remove="spans"`` cuts the hit words, with what stands before each, out of every
    text that has any. NULL and empty texts have no words and stay, very long texts are scanned whole; an item without words has no
    window, an item without a number counts for hits but is not listed; repeated rows are judged
    each; an empty benchmark hits nothing. Other columns stay, but for those named as an added one. The result reads
    ``_scanned``, a stored copy of the texts, which its caller may discard once the result is written.
    """
    added = ("n_words", "n_hit", "items", "contaminated")
    names = [c for c in docs.columns if c != "text" and c not in added]
    renamed = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    windows, members = item_sets(stored(item_windows(benchmark, window), "item-windows"))
    found = find_hits(docs.select("text", *renamed), windows, block)
    found = found.withColumn("sets", F.array_sort(F.array_distinct(F.transform("hits", lambda x: x["set"]))))
    found = scanned = stored(found, "found")
    drop_shuffles(docs.sparkSession)  # and the scan's plan, which holds all windows
    # Texts hit by the same sets of items have the same items.
    sets = found.where(F.size("sets") > 0).select("sets").distinct().withColumn("set", F.explode("sets"))
    text_of_item = F.collect_set(F.col("item_id").cast("string"))
    items = stored(sets.join(members, "set").groupBy("sets").agg(F.array_sort(text_of_item).alias("items")), "hit-items")
    none = F.array().cast("array<string>").alias("items")
    clean = found.where(F.size("sets") == 0).select("*", none)
    found = found.where(F.size("sets") > 0).join(items, "sets", "left").select(*found.columns, "items").union(clean)
    covered = F.flatten(F.transform("hits", lambda x: F.sequence(x["at"], x["at"] + x["size"] - 1)))
    judged = found.withColumn("n_hit", F.size(F.array_distinct(covered)).cast("long"))
    judged = judged.withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    judged = judged.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
    if remove == "documents":
        judged = judged.where("NOT contaminated")
    text = _without_spans(F.col("text"), F.col("hits")) if remove == "spans" else F.col("text")
    back = {c: F.col(f"c{i}").alias(c) for i, c in enumerate(names)} | {"text": text.alias("text")}
    out = judged.select(*[back[c] for c in docs.columns if c in back], *added)
    out._scanned = scanned
    return out
