"""Which parameters the events really carry, against what the game declares (PR16, PR17, K3).

The split keeps declared parameters only, and reads numbers and texts from whatever slot they are in. So a
parameter that a new app version adds, drops or moves to another slot goes unseen. One pass counts every (event, key,
filled slot), combined before the shuffle, and a comparison with the ``Game`` tells what to declare.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.config import DEFAULT_GAME, Game

SLOTS = {"string": "string_value", "int": "int_value", "double": "double_value", "float": "float_value"}


def key_census(raw: DataFrame) -> DataFrame:
    """``(event_name, key, slot, n_rows)``: entries by the slot that is filled, ``none`` or ``several``."""
    value = F.col("entry.value")
    filled = F.array_compact(F.array(*[F.when(value[field].isNotNull(), F.lit(name)) for name, field in SLOTS.items()]))
    slot = F.when(F.size(filled) == 0, "none").when(F.size(filled) > 1, "several").otherwise(F.get(filled, F.lit(0)))
    entries = raw.select("event_name", F.explode("event_params").alias("entry"))
    rows = entries.select("event_name", F.col("entry.key").alias("key"), slot.alias("slot"))
    return rows.groupBy("event_name", "key", "slot").agg(F.count(F.lit(1)).alias("n_rows"))


def compare_census(census: DataFrame, game: Game = DEFAULT_GAME) -> DataFrame:
    """``(event_name, key, status, slots, n_rows)`` of every declared or seen parameter of the game's events.

    ``status`` is ``undeclared`` (seen, not kept by the split), ``never seen`` (declared, in no event), ``mixed slots``
    (declared, filled in more than one slot) or ``ok``. ``slots`` lists the filled slots by name.
    """
    spark = census.sparkSession
    known = [(event, key) for event, keys in game.events.items() for key in keys]
    declared = spark.createDataFrame(known, "event_name string, key string")  # as long as the configuration
    events = spark.createDataFrame([(e,) for e in game.events], "event_name string")
    seen = census.join(F.broadcast(events), "event_name", "left_semi").groupBy("event_name", "key")
    filled = F.array_sort(F.collect_set(F.when(~F.col("slot").isin("none"), F.col("slot"))))
    seen = seen.agg(filled.alias("slots"), F.sum("n_rows").alias("n_rows"))
    both = seen.join(F.broadcast(declared.withColumn("declared", F.lit(True))), ["event_name", "key"], "full")
    status = (
        F.when(F.col("declared").isNull(), "undeclared")
        .when(F.col("n_rows").isNull(), "never seen")
        .when((F.size("slots") > 1) | F.array_contains("slots", "several"), "mixed slots")
        .otherwise("ok")
    )
    slots = F.coalesce(F.array_join("slots", ","), F.lit(""))
    return both.select("event_name", "key", status.alias("status"), slots.alias("slots"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def extended(game: Game, census: DataFrame, exclude: tuple[str, ...] = ()) -> Game:
    """The game with the undeclared parameters declared too.

    The split of the next day has a column for each; days stored before read NULL there. A parameter
    filled as a number only becomes a number. ``exclude`` names keys that are no parameters of the game.
    """
    found = compare_census(census, game).where("status = 'undeclared'").select("event_name", "key", "slots")
    new: dict[str, list[str]] = {}
    numeric, text = set(game.numeric_params), set(game.params)
    for event, key, slots in sorted(tuple(r) for r in found.collect()):  # as many as parameters the app sends
        if key is None or key in exclude:
            continue
        new.setdefault(event, []).append(key)
        if "string" in slots or "several" in slots or not slots:
            text.add(key)
        else:
            numeric.add(key)
    events = {event: (*keys, *new.get(event, ())) for event, keys in game.events.items()}
    return replace(game, events=events, numeric_params=tuple(sorted(numeric - (text - set(game.numeric_params)))))
