"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1; a letter at the n-th place of an n-gram has it
rotated by n. The product of the three rotated vectors is the vector of the n-gram (binding),
the sum over a text's n-grams that of the text (bundling), the sum of unit text vectors by
language that of the language. A document gets the language whose vector has the largest
cosine with its own; both are seen from the mean of all languages, which holds what letters
have in common.

Letters are lower-cased; all else between them is one boundary. Vectors of letters follow from
their code points, so that all tasks agree without a table. Only sums of vectors by language
are shuffled and sent to the driver: a row per task, language and block of dimensions.

A text that is null or has no letter is ``und`` with score 0, and so is every text where no
row has a language to learn from. A null language teaches nothing. Ties go to the first
language in code-point order. Long texts are read in
stretches that pass their last letters on, each a part of the sum.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import binary, in_tasks, map_texts, parts, remainder
from shelfmark.operators.once import once_per_worker

DIMENSIONS = 1024
UNKNOWN = "und"

# Letters looked at together: of several short texts or of a part of a long one.
STRETCH = 1 << 17
# Vectors of n-grams that a worker remembers.
KEPT_GRAMS = 30_000


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its lower-case form and whether it is a letter."""
    lower = np.arange(0x110000, dtype=np.uint32)
    letter = np.zeros(0x110000, bool)
    for point in range(0x110000):
        c = chr(point)
        if unicodedata.category(c)[0] == "L":
            letter[point] = True
            small = c.lower()
            if len(small) == 1:
                lower[point] = ord(small)
    return lower, letter


class Space:
    """Vectors of letters and n-grams."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}
        self.known = np.zeros(0, np.uint64)  # n-grams, in order
        self.vectors = np.zeros((0, dimensions), np.int8)
        self.lower, self.letter = _kinds()

    def of_letter(self, point: int) -> np.ndarray:
        """Its random vector; 0 is the boundary."""
        if point not in self.letters:
            if len(self.letters) >= KEPT_GRAMS:
                self.letters.clear()
            bits = np.random.Generator(np.random.Philox(key=point + 1)).integers(0, 2, self.dimensions, np.int8)
            self.letters[point] = 2 * bits - 1
        return self.letters[point]

    def of_grams(self, grams: np.ndarray) -> np.ndarray:
        """Vectors of different n-grams in ascending order."""
        new = np.setdiff1d(grams, self.known, assume_unique=True)
        if len(self.known) + len(new) > max(KEPT_GRAMS, len(grams)):
            self.known, self.vectors, new = self.known[:0], self.vectors[:0], grams
        if len(new):
            made = np.ones((len(new), self.dimensions), np.int8)
            for place in range(3):
                points = (new >> np.uint64(21 * (2 - place)) & np.uint64(0x1FFFFF)).astype(np.int64)
                own, which = np.unique(points, return_inverse=True)
                table = np.stack([np.roll(self.of_letter(int(p)), 2 - place) for p in own])
                made *= table[which]
            known = np.concatenate([self.known, new])
            order = np.argsort(known)
            self.known, self.vectors = known[order], np.concatenate([self.vectors, made])[order]
        return self.vectors if len(grams) == len(self.known) else self.vectors[np.searchsorted(self.known, grams)]

    def grams(self, points: np.ndarray) -> Iterator[np.ndarray]:
        """The n-grams of a text from its code points, a stretch at a time: letters, and one
        boundary for all that is between them, at its start and at its end."""
        before = np.zeros(1, np.uint64)
        for start in range(0, len(points), STRETCH):
            here = points[start : start + STRETCH]
            own = np.where(self.letter[here], self.lower[here], 0).astype(np.uint64)
            end = np.zeros(int(start + STRETCH >= len(points)), np.uint64)
            kept = np.concatenate([before, own, end])
            kept = kept[np.concatenate([[True], (kept[1:] != 0) | (kept[:-1] != 0)])]
            yield kept[:-2] << np.uint64(42) | kept[1:-1] << np.uint64(21) | kept[2:]
            before = kept[-2:]

    def bundle(self, texts: list[np.ndarray]) -> np.ndarray:
        """Sums of the vectors of each list of n-grams, a row each."""
        out = np.zeros((len(texts), self.dimensions), np.float32)
        sizes = [len(t) for t in texts]
        if not sum(sizes):
            return out
        grams, which = np.unique(np.concatenate(texts), return_inverse=True)
        vectors = self.of_grams(grams)
        at = np.cumsum([0, *sizes])
        for row, (start, stop) in enumerate(zip(at[:-1], at[1:], strict=True)):
            if stop > start:
                counts = np.bincount(which[start:stop], minlength=len(grams))
                own = np.flatnonzero(counts)
                out[row] = counts[own].astype(np.float32) @ vectors[own].astype(np.float32)
        return out

    def of_texts(self, texts: list[bytes]) -> np.ndarray:
        """The vector of each text, as float64; zero without a letter."""
        out = np.zeros((len(texts), self.dimensions))
        rows, waiting, held = [], [], 0
        for row, text in enumerate(texts):
            for grams in self.grams(np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)):
                rows.append(row)
                waiting.append(grams)
                held += len(grams)
                if held >= STRETCH:
                    np.add.at(out, rows, self.bundle(waiting))
                    rows, waiting, held = [], [], 0
        if waiting:
            np.add.at(out, rows, self.bundle(waiting))
        return out


def space(dimensions: int) -> Space:
    return once_per_worker("hyperspace", dimensions, lambda: Space(dimensions))


def _units(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


class Profiles:
    """Languages, their vectors as seen from the mean of all, and that mean."""

    def __init__(self, languages: list[str], sums: np.ndarray):
        units = _units(sums)
        self.languages = languages
        self.mean = units.mean(axis=0) if len(units) else np.zeros(sums.shape[1])
        # A language alone is the mean.
        self.vectors = _units(units - self.mean) if len(units) > 1 else units

    def closest(self, vectors: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The language of each text vector, and its cosine, or 0 if that is less."""
        if not self.languages:
            return [UNKNOWN] * len(vectors), np.zeros(len(vectors))
        units = _units(vectors)
        seen = _units(units - self.mean) if len(self.languages) > 1 else units
        cosines = np.round(seen @ self.vectors.T, 9)
        best = cosines.argmax(axis=1)
        empty = ~vectors.any(axis=1)
        score = np.clip(cosines[np.arange(len(best)), best], 0, 1)
        return [UNKNOWN if e else self.languages[b] for e, b in zip(empty, best, strict=True)], np.where(empty, 0.0, score)


def train(docs: DataFrame, learn: Column | None = None, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS) -> Profiles:
    """Profiles of the languages of all rows where ``learn`` holds and ``lang`` is not null.
    What comes back is ``dimensions`` numbers for each language."""
    rows = docs.where(F.col(lang).isNotNull() & (F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums = space(dimensions), {}
        for batch in batches:
            for part in parts(batch, "text"):
                units = _units(own.of_texts(binary(part.column("text")).to_pylist()))
                languages = np.array(part.column("lang").to_pylist(), object)
                for name in set(languages):
                    sums[name] = sums.get(name, 0) + units[languages == name].sum(axis=0)
        for name, vector in sums.items():
            # In whole numbers, whose sum is the same in any order.
            whole = np.round(vector * 2.0**32).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(whole), pa.string()), pa.array(range(len(whole)), pa.int32()), pa.array(whole)], ["lang", "place", "part"])

    sums = in_tasks(rows.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")), add_up, "lang string, place int, part long")
    vectors = sums.groupBy("lang", "place").agg(F.sum("part").alias("part")).groupBy("lang")
    told = sorted((r.lang, [p.part for p in sorted(r.parts)]) for r in vectors.agg(F.collect_list(F.struct("place", "part")).alias("parts")).collect())
    return Profiles([name for name, _ in told], np.array([v for _, v in told], np.float64).reshape(-1, dimensions))


def with_language(docs: DataFrame, profiles: Profiles, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``lang_pred`` and ``score``, the cosine with that language (0 to 1). Input
    columns of these names give way to them."""
    dimensions = profiles.mean.shape[0]

    def start():
        own = space(dimensions)

        def step(texts: pa.LargeBinaryArray) -> list:
            names, scores = profiles.closest(own.of_texts(texts.to_pylist()))
            return [names, scores]

        return step

    return map_texts(docs, start, [("lang_pred", "string", pa.string()), ("score", "double", pa.float64())], text, keep)


def digest(docs: DataFrame) -> DataFrame:
    held_out = remainder("doc_id", 4) == 2
    profiles = train(docs, ~held_out)
    scored = with_language(docs.select("doc_id", held_out.alias("held_out"), "text"), profiles, keep=["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "lang_pred", "score")
