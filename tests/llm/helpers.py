"""Small tables with everything that can be odd about a row."""

from __future__ import annotations

import random

LETTERS = "the of and to in is that it for was on are with as his they be at one have this from".split()


def sentence(rng: random.Random, size: int) -> str:
    words = [rng.choice(LETTERS) + rng.choice(["", "", "ing", "ed", "er"]) for _ in range(size)]
    return " ".join(words).capitalize() + "."


def texts(seed: int, count: int, size: int = 40) -> list[str]:
    rng = random.Random(seed)
    return ["\n".join(sentence(rng, rng.randint(3, size)) for _ in range(rng.randint(1, 6))) for _ in range(count)]


def odd_documents(seed: int = 1, count: int = 40) -> list[tuple]:
    """(doc_id, text, score): nulls, empty and long texts, copies, repeated rows and a clashing column."""
    plain = texts(seed, count)
    rows = [(i, t, "x") for i, t in enumerate(plain)]
    rows += [(1000, None, "x"), (1001, "", None), (1002, " \n\t ", "x"), (1003, "\n\n", "x")]
    rows += [(1004, plain[0], "x"), (1005, plain[0], "x"), (1006, plain[3].upper(), "x")]
    rows += [(7, plain[7], "x"), (None, plain[5], "x"), (None, None, None)]
    rows += [(1007, " ".join(plain) * 3, "x"), (1008, "é\U0001f600 " * 60, "x"), (1009, "a" * 700, "x")]
    return rows


SCHEMA = "doc_id long, text string, {} string"


def frame(spark, rows, clash: str = "score"):
    return spark.createDataFrame(rows, SCHEMA.format(clash))
