"""Awkward rows that every operator has to stand."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "kept string, score string, uid string, row string, m string, digest string, bin string, sid string, shard string"
)
LONG = "word " * 30_000 + "x" * 90_000

TEXTS = [
    (1, "one two three four five six"),
    (2, "one two three four five six"),
    (3, None),
    (4, ""),
    (5, " \t\n "),
    (6, LONG),
    (6, LONG),
    (None, "one two three four five six"),
    (None, None),
    (7, "short"),
    (7, "another text of the same id"),
    (8, "zwölf Boxkämpfer   jagen Viktor \U0001f600"),
]


def documents(spark, rows=TEXTS):
    """Rows of (doc_id, text) as documents with extra columns whose names clash with the operators' own."""
    full = [(i, t, "en", None if n % 4 == 3 else f"src{n % 3}", None, *["extra"] * 9) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{int(rng.random() ** 2 * vocabulary)}" for _ in range(words))
