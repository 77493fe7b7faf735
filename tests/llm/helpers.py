"""Small inputs and plain versions shared by the tests of the operators."""

from __future__ import annotations

import random
import re

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(ASCII)) if w]


def shingles(text, size):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def sentence(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


LONG = " ".join(f"wörd{i % 977}" for i in range(40_000))

#: Nulls, empty and blank texts, repeated rows and keys, a very long text.
EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "One short text."),
    (4, "One short text."),
    (4, "Another text under the same key."),
    (None, "A text without a key."),
    (5, LONG),
    (6, "ünïcödé … 人 \U0001f600 text"),
]

#: Names of outputs, as columns of the input.
CLASHES = ["n_words", "n_hit", "items", "spans", "score", "ids", "n_tokens", "n_bytes", "kept", "fingerprint", "licenses", "N_Blocks"]


def edge_docs(spark, rows=None):
    rows = EDGES if rows is None else rows
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame([(k, t, None, None, None, *[None] * len(CLASHES)) for k, t in rows], schema)
