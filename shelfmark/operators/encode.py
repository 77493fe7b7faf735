"""Batch text encoding with a caller-supplied encoder."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.vectors import to_lists, unit_rows
from shelfmark.operators.once import evaluate_once, once_per_worker

# Fixed value: texts a neural model takes at a time.
BATCH_SIZE = 64

Encoder = Callable[[list[str]], np.ndarray]


def encode(
    df: DataFrame,
    make_encoder: Callable[[], Encoder],
    text: str = "text",
    vector: str = "embedding",
    normalize: bool = True,
) -> DataFrame:
    """Add a vector column. ``make_encoder`` runs once per Python worker and call of this
    function, so a model is loaded once for all tasks of a worker. The encoder is given
    whole Arrow batches and cuts them as it likes. Only the text column is sent to
    Python; filter before encoding, nothing is pushed below this stage."""
    key = uuid.uuid4().hex

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = once_per_worker("encoder", key, make_encoder)
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            matrix = np.asarray(encoder(texts), dtype=np.float64) if texts else np.zeros((0, 0))
            yield to_lists(unit_rows(matrix) if normalize else matrix)

    return evaluate_once(df, **{vector: embed(F.col(text))})


def hashed_words(dim: int = 64, cache_size: int = 200_000) -> Callable[[], Encoder]:
    """A deterministic stand-in encoder: counts of hashed words.

    A word (text between spaces, tabs and line feeds) falls into bucket
    ``first 32 bits of md5(word) mod dim``. It is a placeholder for a neural
    model and does not reproduce one's similarities.
    """

    def make() -> Encoder:
        @lru_cache(maxsize=cache_size)
        def bucket(word: str) -> int:
            if not word:
                return dim  # a column past the end, cut off below
            return int.from_bytes(hashlib.md5(word.encode()).digest()[:4], "big") % dim

        def encoder(texts: list[str]) -> np.ndarray:
            words = pc.split_pattern(pa.array([t.replace("\n", " ").replace("\t", " ") for t in texts]), " ")
            coded = words.flatten().dictionary_encode()
            buckets = np.fromiter(map(bucket, coded.dictionary.to_pylist()), np.int64)
            rows = np.repeat(np.arange(len(texts)), words.value_lengths().to_numpy())
            cells = rows * (dim + 1) + buckets[coded.indices.to_numpy()]
            counts = np.bincount(cells, minlength=len(texts) * (dim + 1))
            return counts.reshape(len(texts), dim + 1)[:, :dim]

        return encoder

    return make


def sentence_transformer(model: str, batch_size: int = BATCH_SIZE, **options) -> Callable[[], Encoder]:
    """An encoder backed by the ``sentence_transformers`` package, if installed. It is
    given many texts, sorts them by length and runs ``batch_size`` at a time."""

    def make() -> Encoder:
        from sentence_transformers import SentenceTransformer

        loaded = SentenceTransformer(model, **options)
        return lambda texts: loaded.encode(texts, batch_size=batch_size, convert_to_numpy=True)

    return make
