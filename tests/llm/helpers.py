"""Small document tables with awkward rows."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, ids string, spans string, size string, h string, fp string, label string"


def prose(seed: int, words: int) -> str:
    rnd = random.Random(seed)
    stems = ["an", "ber", "cor", "del", "er", "fin", "gra", "hol", "in", "jun", "ka", "lo", "mar", "ne", "or"]
    return " ".join("".join(rnd.choice(stems) for _ in range(rnd.randint(1, 4))) for _ in range(words))


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """``rows`` of (doc_id, text, source); columns that clash with working names are filled with text."""
    full = [(i, t, "en", s, len(t) if t is not None else None, *["x"] * 7) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


LONG = prose(7, 40_000) + " " + "x" * 5000

ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, LONG, "b"), (5, "one two three", "b"), (5, "one two three", "b"), (None, "no id here", "a"), (6, prose(1, 60), "c"),
    (7, prose(1, 60), "c"), (8, "ß é ü 漢字 😀 " + prose(2, 9), None), (9, "x", "a"), (10, "line\n" * 300, "c"),
]


def odd(spark: SparkSession) -> DataFrame:
    return documents(spark, ODD)


def nothing(spark: SparkSession) -> DataFrame:
    return documents(spark, [])
