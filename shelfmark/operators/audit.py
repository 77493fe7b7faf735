"""Checks across the splits of a collection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unseen_subjects(links: DataFrame, split: str, base: str) -> DataFrame:
    """Subjects linked in ``split`` but never in ``base``, with their link count.

    One aggregation by subject; counts are partial before the shuffle, so a hot
    subject costs a row per task.
    """

    def in_split(name: str):
        return F.count(F.when(F.col("split") == name, 1))

    return (
        links.groupBy("subject_id")
        .agg(in_split(split).alias("n_links"), in_split(base).alias("__base"))
        .where((F.col("n_links") > 0) & (F.col("__base") == 0))
        .drop("__base")
    )


def shared_texts(docs: DataFrame, *text: str) -> DataFrame:
    """Texts that occur in more than one split: ``(text_key, n_docs, n_splits)``.

    Texts are compared by SHA-256 of their whole, length-prefixed columns, so the
    shuffle carries 64 characters per distinct text and task, not the texts.
    """
    parts = [F.concat_ws(":", F.length(c).cast("string"), F.col(c)) for c in text]
    keyed = docs.select("split", F.sha2(F.concat_ws("|", *parts), 256).alias("text_key"))
    per_split = keyed.groupBy("text_key", "split").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_split.groupBy("text_key")
        .agg(F.sum("n").alias("n_docs"), F.count(F.lit(1)).alias("n_splits"))
        .where(F.col("n_splits") > 1)
    )
