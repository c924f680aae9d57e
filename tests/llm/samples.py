"""Small frames with every odd row the operators must take."""

from __future__ import annotations

import random

# Names the operators use inside; as extra columns they must not get in the way.
CLASHES = ["id", "key", "anchor", "at", "spans", "copy", "digest", "row", "hits", "score", "size",
           "shard", "slot", "band", "grouped", "window", "turns", "words", "grams", "family"]


def documents(spark, rows):
    """doc_id and text, with a column for every clashing name."""
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.selectExpr("*", *[f"'x' AS {name}" for name in CLASHES])


def empty(spark):
    return documents(spark, [])


def prose(seed: int, count: int, vocabulary: int = 400, words: int = 60) -> list[str]:
    draw = random.Random(seed)
    known = ["".join(draw.choice("abcdefghiéü") for _ in range(draw.randint(2, 8)))
             for _ in range(vocabulary)]
    return [" ".join(draw.choice(known) for _ in range(draw.randint(1, 2 * words)))
            for _ in range(count)]


def edited(text: str, changes: int, seed: int) -> str:
    draw = random.Random(seed)
    words = text.split(" ")
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"changed{draw.randrange(1000)}"
    return " ".join(words)
