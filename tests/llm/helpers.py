"""Small document tables for the tests of the training-data operators."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, block string"


def docs_df(spark, rows, parts: int = 3):
    """(id, text) pairs as a documents table with an extra column named like an internal one."""
    full = [(k, t, "en", "s", None if t is None else len(t), "x") for k, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def near_copy(rng: random.Random, text: list[str], changes: int) -> list[str]:
    out = list(text)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out
