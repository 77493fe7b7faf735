"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes ratios.

A text is the set of its hashed character n-grams. Every n-gram has the log-count ratio
of toxic to other training texts; logistic regression is fitted on the n-grams a text
has, each scaled by its ratio. Scoring is one pass without a shuffle.

Training takes a bounded sample of the labelled rows: ``sample_rows``, drawn by a hash
of the key. That bound makes it safe to send the drawn labels to every task and to fit
in one task; the texts themselves are never shuffled. Scoring covers every row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import binary, in_tasks, map_texts, mix, parts, random_words, remainder

# Bytes of text at a time: a letter takes some 60 bytes of arrays here.
PORTION = 1 << 18

#: Hashed n-grams are numbers of so many bits.
BITS = 20
LENGTHS = (3, 4, 5)


def grams(texts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, n-gram) of all n-grams, repeats included, in no set order.

    Letters are lower-cased, white space counts as a blank, and a blank stands before
    and after each text, so that n-grams know where words begin and end.
    """
    if not len(texts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    plain = [t.as_py().decode("utf-8", "replace").lower() for t in texts]
    line = "\n" + "\n".join(plain) + "\n"
    code = np.frombuffer(line.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    ends = np.cumsum([len(p) + 1 for p in plain])  # of each text's closing blank
    owner = np.repeat(np.arange(len(plain)), np.diff(ends, prepend=0))
    code[(code >= 9) & (code <= 13)] = 32
    scale = random_words(7, 8)
    who, what = [], []
    h = code * scale[0]
    for n in range(2, max(LENGTHS) + 1):
        h = h[:-1] + code[n - 1 :] * scale[n - 1] if len(h) > 1 else h[:0]
        if n not in LENGTHS or not len(h):
            continue
        # The n-gram at i is inside the text that owns place i, up to its closing blank.
        inside = np.arange(len(h)) + n - 1 <= ends[owner[: len(h)]]
        who.append(owner[: len(h)][inside])
        what.append((mix(h[inside] + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int64))
    if not who:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(who), np.concatenate(what)


def distinct(who: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((who << BITS) | what)
    return both >> BITS, both & ((1 << BITS) - 1)


@dataclass(frozen=True)
class Model:
    """Weight of each n-gram that has one, and the intercept."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << BITS, np.float32)
        table[self.features] = self.weights
        return table


def score(texts: pa.LargeBinaryArray, table: np.ndarray, intercept: float) -> np.ndarray:
    who, what = grams(texts)
    told = table[what] != 0
    who, what = distinct(who[told], what[told])
    total = intercept + np.bincount(who, table[what].astype(float), len(texts))
    return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def logistic(sets: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, penalty: float, rounds: int = 300):
    """Weights and intercept by accelerated gradient descent on the mean log loss."""
    size = np.array([len(s) for s in sets])
    columns = np.concatenate([*sets, np.zeros(0, np.int64)]).astype(np.int64)
    rows = np.repeat(np.arange(len(sets)), size)
    values = ratio[columns]
    n = max(len(sets), 1)
    # The largest curvature, by a few power steps.
    v = np.ones(len(ratio) + 1)
    lam = 1.0
    for _ in range(15):
        z = np.bincount(rows, values * v[columns], n) + v[-1]
        v = np.append(np.bincount(columns, values * z[rows], len(ratio)), z.sum()) / n
        lam = float(np.linalg.norm(v)) or 1.0
        v /= lam
    rate = 1 / (0.25 * lam * 1.1 + penalty)
    w = look = np.zeros(len(ratio) + 1)
    w[-1] = look[-1] = 0.0
    for k in range(rounds):
        z = np.bincount(rows, values * look[columns], n) + look[-1]
        miss = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels
        slope = np.append(np.bincount(columns, values * miss[rows], len(ratio)), miss.sum()) / n
        slope[:-1] += penalty * look[:-1]
        new = look - rate * slope
        look = new + (k / (k + 3)) * (new - w)
        w = new
    return w[:-1] * ratio, float(w[-1])


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = 32_768,
    min_docs: int = 10,
    min_ratio: float = 2.0,
    penalty: float = 5e-3,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model:
    """Fit on at most ``sample_rows`` labelled rows.

    n-grams of fewer than ``min_docs`` training texts, or whose ratio is within
    ``min_ratio`` of 0 (a natural logarithm), say too little and get no weight. Rows
    with a null label or key are left out; a key that is labelled twice counts as
    toxic if any of its labels does; repeated documents count each. Without
    labelled rows, or with one class only, all texts score the share of toxic labels
    (0.5 without any).
    """
    drawn = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max((F.col(label) > 0).cast("int")).alias("__label"))
        .orderBy(F.xxhash64(key), key)
        .limit(sample_rows)
    )
    texts = docs.select(key, text).join(F.broadcast(drawn), key)  # sample_rows rows at most
    counts = {r[0]: r[1] for r in texts.groupBy("__label").count().collect()}
    share = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    if len([c for c in counts.values() if c]) < 2:
        edge = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(edge / (1 - edge))))
    held = _ratios(texts, text, counts[0], counts[1], min_docs, min_ratio)
    chosen = held.features
    ratio = held.weights
    spot = texts.sparkSession.sparkContext.broadcast(chosen)

    def small():
        where = np.full(1 << BITS, -1, np.int32)
        where[spot.value] = np.arange(len(spot.value))

        def step(t):
            who, what = grams(t)
            told = where[what] >= 0
            who, what = distinct(who[told], what[told])
            cut = np.searchsorted(who, np.arange(len(t) + 1))
            return [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(where[what], pa.int32()))]

        return step

    reduced = map_texts(texts, small, [("f", "array<int>", pa.list_(pa.int32()))], text, keep=["__label"], limit=PORTION)
    # At most sample_rows short lists; repeated keys among the documents may exceed the
    # bound, hence the limit.
    rows = reduced.limit(2 * sample_rows).toPandas()
    weights, intercept = logistic(
        [np.asarray(f, np.int64) for f in rows["f"]], rows["__label"].to_numpy(float), ratio, penalty
    )
    return Model(chosen, weights, intercept)


def _ratios(texts: DataFrame, text: str, n_other: int, n_toxic: int, min_docs: int, min_ratio: float) -> Model:
    """n-grams that tell the classes apart, and their log-count ratios. Finding and counting
    them is one step: two would keep two Python workers a task."""

    def count(batches):
        totals = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for part in parts(batch, text, PORTION):
                who, what = distinct(*grams(binary(part.column(text))))
                toxic = part.column("__label").to_numpy(zero_copy_only=False)[who] == 1
                totals[0] += np.bincount(what[~toxic], minlength=1 << BITS)
                totals[1] += np.bincount(what[toxic], minlength=1 << BITS)
        seen = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(totals[0][seen]), pa.array(totals[1][seen])],
            names=["gram", "other", "toxic"],
        )

    table = in_tasks(texts.select(text, "__label"), count, "gram int, other long, toxic long").groupBy("gram").agg(
        F.sum("other").alias("other"), F.sum("toxic").alias("toxic")
    )
    told = (
        table.select(
            "gram",
            (F.col("other") + F.col("toxic")).alias("n"),
            F.log(((F.col("toxic") + 1) / (n_toxic + 1)) / ((F.col("other") + 1) / (n_other + 1))).alias("ratio"),
        )
        .where((F.col("n") >= min_docs) & (F.abs("ratio") >= min_ratio))
        .toPandas()  # at most 2**BITS rows
        .sort_values("gram")
    )
    return Model(told["gram"].to_numpy(np.int64), told["ratio"].to_numpy(float), 0.0)


def add_scores(docs: DataFrame, model: Model, text: str = "text", out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """Add the probability that a text is toxic. A null text is scored as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.intercept))

    def start():
        found = Model(*shared.value)
        weights = found.dense()
        return lambda texts: [score(texts, weights, found.intercept)]

    return map_texts(docs, start, [(out, "double", pa.float64())], text, keep, PORTION)


def with_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    held_out: tuple[int, int] = (3, 1),
    keep: list[str] | None = None,
    **options,
) -> DataFrame:
    """Train on the labelled rows that are not held out and score every row.

    Held out are the rows whose crc32(doc_id as text) modulo the first of ``held_out``
    is the second. Labels, lang, source and doc_id are no inputs of a score.
    """
    by, rest = held_out
    fit = labels.where(remainder("doc_id", by) != rest)
    return add_scores(docs, train(docs.select("doc_id", "text"), fit, **options), keep=keep)


def digest(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    scored = with_toxicity(docs, labels, keep=["doc_id"])
    return scored.select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
