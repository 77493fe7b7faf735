"""Language-model scores from Brown classes: a class bigram model fitted on the corpus.

Words are classed by exchange: a word moves to the class that gains most likelihood of
the class bigrams, until few move. This runs on the frequent words, those with a share of
``unit_share`` of all tokens at least, and on groups of the rarer ones that end alike; it
lays out the classes. Then every other word of the training texts moves on its own, in
rounds over the texts, to the class that its neighbours favour, and the class bigrams are
counted anew. Only words that training has not seen go by their ending.
A text's probability is the product of class transitions and of the words within their
classes; both are smoothed and sum to one over known words and one unknown an ending.

Texts are read twice: to count words, and to be stored as codes. Words with a share of
``lookup_share`` of all tokens, of which there are ``2 / lookup_share`` at most, are
looked up; they and the class bigrams are sent to tasks. Any other word, a seldom one, is
dealt out once by its hash and stored as a row with all its occurrences and what stands on
their sides, so that its class is found, counted and scored where it lies. Only two seldom
words side by side have to be told each other's classes by a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import Rolling, Store, binary, in_tasks, joined, lowered, parts, remainder, word_spans

#: Rare words begin, and unknown words stay, in groups by the hash of so many last bytes.
ENDING, ENDINGS = 3, 512
#: Distinct words or bigrams that a task holds before it passes its counts on, bytes of text
#: that it counts before it adds them up, and tokens or occurrences that it handles at once.
HELD, COUNTED, HANDLED = 1_000_000, 3 << 20, 1 << 19
#: Rows that are gathered before they are grouped by word; looked-up words to a row of sums.
GATHERED, BLOCK = 1 << 14, 64

_rolling = Rolling(31)


def hashed_words(texts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words, their endings' numbers, and each text's first word."""
    data, offsets = joined(texts)
    data = lowered(data)
    starts, stops, first = word_spans(data, offsets)
    sums = _rolling.prefix(data)
    ending = _rolling.of(sums, np.maximum(starts, stops - ENDING), stops)
    return _rolling.of(sums, starts, stops).view(np.int64), (ending % np.uint64(ENDINGS)).astype(np.int64), first


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of each row of values by key."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[first], np.add.reduceat(values[:, order], first, axis=1) if len(keys) else values


class Totals:
    """Sums by key, passed on whenever there are too many keys."""

    def __init__(self, columns: int = 1):
        self.columns, self.held, self.size = columns, [], 0

    def add(self, keys: np.ndarray, values: np.ndarray | None = None) -> None:
        if values is None:
            keys, n = np.unique(keys, return_counts=True)
            self.held.append((keys, n[None]))
        else:
            self.held.append(summed(keys, values))
        self.size += len(self.held[-1][0])
        if self.size > 2 * HELD:
            self._merge()

    def _merge(self) -> None:
        if len(self.held) > 1:
            keys, values = zip(*self.held, strict=True)
            self.held = [summed(np.concatenate(keys), np.concatenate(values, axis=1))]
            self.size = len(self.held[0][0])

    @property
    def full(self) -> bool:
        return self.size > HELD and len(self.held) == 1

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self._merge()
        out = self.held[0] if self.held else (np.zeros(0, np.int64), np.zeros((self.columns, 0), np.int64))
        self.__init__(self.columns)
        return out


def word_counts(docs: DataFrame) -> DataFrame:
    """hash, ending, n_train and n_all of every word; ``docs`` has text and train."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = Totals(3)

        def out():
            keys, (n, train, ending) = totals.take()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array((ending // np.maximum(n, 1)).astype(np.int32)), pa.array(train), pa.array(n)],
                names=["hash", "ending", "n_train", "n_all"],
            )

        for batch in batches:
            for part in parts(batch, "text", COUNTED):
                words, ending, first = hashed_words(binary(part.column("text")))
                train = np.repeat(part.column("train").to_numpy(zero_copy_only=False), np.diff(first))
                totals.add(words, np.array([np.ones(len(words), np.int64), train.astype(np.int64), ending]))
                if totals.full:
                    yield out()
        yield out()

    counted = in_tasks(docs.select("text", "train"), run, "hash long, ending int, n_train long, n_all long")
    return counted.groupBy("hash").agg(
        F.min("ending").alias("ending"), F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all")
    )


@dataclass
class Units:
    """Frequent words (sorted hashes) are units 0.., then endings, then the end of a text."""

    words: np.ndarray

    @property
    def end(self) -> int:
        return len(self.words) + ENDINGS

    @property
    def count(self) -> int:
        return self.end + 1

    def of(self, words: np.ndarray, ending: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return ending.copy()
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, len(self.words) + ending)


def by_code(of_words: np.ndarray, of_end, of_endings: np.ndarray) -> np.ndarray:
    """A table of what belongs to each code: the place of a looked-up word, then the end of
    a text; a seldom word is ``-1`` minus its ending, which counts from the table's end."""
    return np.concatenate([of_words, [of_end], of_endings[::-1]])


def coded(docs: DataFrame, keep: tuple[str, ...], lookup: np.ndarray) -> DataFrame:
    """``keep``, train, ids and rest of every text: the codes of its words, and the hashes
    of the seldom ones among them."""
    shared = docs.sparkSession.sparkContext.broadcast(lookup)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in parts(batch, "text", COUNTED):
                words, ending, first = hashed_words(binary(part.column("text")))
                ids = -1 - ending
                if len(known):
                    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
                    ids = np.where(known[at] == words, at, ids)
                seldom = ids < 0
                rest = np.concatenate([[0], np.cumsum(seldom)])[first]
                lists = [
                    pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(x))
                    for at, x in ((first, ids.astype(np.int32)), (rest, words[seldom]))
                ]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), part.column("train"), *lists], names=[*keep, "__train", "__ids", "__rest"])

    kept = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return in_tasks(docs.select(*keep, "train", "text"), run, f"{kept}__train boolean, __ids array<int>, __rest array<long>")


def portions(batch: pa.RecordBatch, column: str, most: int = HANDLED) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` items of a list column, a row at least."""
    ends = np.cumsum(pc.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def items(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The items of all lists one after another, and how many each has."""
    return lists.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(lists).to_numpy(zero_copy_only=False)


def line_of(ids: pa.ListArray, end: int) -> np.ndarray:
    """Codes of the texts one after another, each with its end. An end stands before
    them, since a text begins as if after one."""
    values, n = items(ids)
    out = np.full(len(values) + len(n) + 1, end, np.int64)
    out[1 + np.arange(len(values)) + np.repeat(np.arange(len(n)), n)] = values
    return out


def unit_bigrams(codes: DataFrame, units: np.ndarray, end: int, count: int) -> DataFrame:
    """first, second, n over the training texts; ``units`` by code."""
    shared = codes.sparkSession.sparkContext.broadcast(units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, totals = shared.value, Totals()

        def out():
            keys, (n,) = totals.take()
            return pa.RecordBatch.from_arrays(
                [pa.array((keys // count).astype(np.int32)), pa.array((keys % count).astype(np.int32)), pa.array(n)],
                names=["first", "second", "n"],
            )

        for batch in batches:
            for part in portions(batch, "__ids"):
                line = of[line_of(part.column("__ids"), end)]
                totals.add(line[:-1] * count + line[1:])
                if totals.full:
                    yield out()
        yield out()

    counted = in_tasks(codes.where("__train").select("__ids"), run, "first int, second int, n long")
    return counted.groupBy("first", "second").agg(F.sum("n").alias("n"))


@dataclass
class Classes:
    """What tasks know of classes, by code; -1 of seldom words once these have their own.
    Looked-up words that are not ``moving`` keep theirs."""

    cls: np.ndarray
    moving: np.ndarray
    end: int


def split(sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes before and behind, which an occurrence keeps in one number."""
    return sides >> 32, sides.astype(np.int32).astype(np.int64)


def packed(keys: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending keys and their counts, small."""
    planes = np.stack([np.diff(keys, prepend=0), n]).astype("<i8").view(np.uint8).reshape(2, len(keys), 8).transpose(0, 2, 1)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(size: int, sums: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(pa.decompress(sums, 16 * size, codec="zstd", asbytes=True), np.uint8).reshape(2, 8, size)
    steps, n = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8")[:, :, 0]
    return np.cumsum(steps), n


SUMS = "block int, size int, sums binary"


class Sightings:
    """What a task has seen, as rows of ``SUMS``: bigrams of classes (block -1; the first
    class times ``k`` plus the second), and what looked-up words see beside them, by class (plus
    ``k`` if it stands behind), in blocks of words."""

    def __init__(self, k: int):
        self.k, self.cells, self.told = k, np.zeros(k * k, np.int64), Totals()

    def bigrams(self, first: np.ndarray, second: np.ndarray) -> None:
        self.cells += np.bincount(first * self.k + second, minlength=self.k**2)

    def sees(self, *seen: tuple[np.ndarray, np.ndarray]) -> None:
        """Words and what each sees."""
        self.told.add(np.concatenate([word * (2 * self.k) + code for word, code in seen]))

    def rows(self, end: bool = False) -> Iterator[pa.RecordBatch]:
        keys, (n,) = self.told.take()
        width = 2 * self.k * BLOCK
        block = keys // width
        cut = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])[: len(keys)])
        cut = np.append(cut, len(keys))
        out = [(int(block[a]), b - a, packed(keys[a:b] - block[a] * width, n[a:b])) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        if end and self.cells.any():
            keys = np.flatnonzero(self.cells)
            out.append((-1, len(keys), packed(keys, self.cells[keys])))
        for at in range(0, len(out), 1000):
            columns = zip(*out[at : at + 1000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["block", "size", "sums"])


def sightings(codes: DataFrame, classes: Classes, k: int, cells: bool, moving: bool) -> DataFrame:
    """``SUMS`` of the training texts, as far as neighbours' classes are known by code: bigrams
    of ``cells``, and what ``moving`` words see."""
    shared = codes.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = shared.value, Sightings(k)
        for batch in batches:
            for part in portions(batch, "__ids"):
                line = line_of(part.column("__ids"), known.end)
                cls = known.cls[line]
                told = cls >= 0
                if cells:
                    both = told[:-1] & told[1:]
                    seen.bigrams(cls[:-1][both], cls[1:][both])
                if moving:
                    mine = np.flatnonzero(known.moving[line])  # never the first or the last, which are ends
                    left, right = mine[told[mine - 1]], mine[told[mine + 1]]
                    seen.sees((line[left], cls[left - 1]), (line[right], k + cls[right + 1]))
                    if seen.told.full:
                        yield from seen.rows()
        yield from seen.rows(end=True)

    return in_tasks(codes.where("__train").select("__ids"), run, SUMS)


def seldom_sightings(words: DataFrame, classes: Classes, k: int, moving: bool) -> DataFrame:
    """The same beside seldom words, whose rows know their own class."""
    shared = words.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = shared.value, Sightings(k)
        for batch in batches:
            for part in portions(batch, "spots"):
                spots, n = items(part.column("spots"))
                train = (spots & 1).astype(bool)
                own = np.repeat(part.column("cls").to_numpy(), n)[train].astype(np.int64)
                left, right = split(items(part.column("sides"))[0][train])
                before, behind = left >= 0, right >= 0
                seen.bigrams(known.cls[left[before]], own[before])
                seen.bigrams(own[behind], known.cls[right[behind]])
                if moving:
                    before, behind = before & known.moving[left], behind & known.moving[right]
                    seen.sees((left[before], k + own[before]), (right[behind], own[behind]))
                    if seen.told.full:
                        yield from seen.rows()
        yield from seen.rows(end=True)

    return in_tasks(words.where("n > 0").select("cls", "spots", "sides"), run, SUMS)


def added(rows: DataFrame, k: int) -> DataFrame:
    """``SUMS`` added up by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, size, sums in zip(*(batch.column(c).to_pylist() for c in ("block", "size", "sums")), strict=True):
                keys, n = unpacked(size, sums)
                held.setdefault(block, np.zeros(k * k if block < 0 else 2 * k * BLOCK, np.int64))[keys] += n
        for block, n in held.items():
            keys = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([len(keys)], pa.int32()), pa.array([packed(keys, n[keys])], pa.binary())], names=["block", "size", "sums"]
            )

    return in_tasks(rows.repartition("block"), run, SUMS)


def favoured_words(sums: DataFrame, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of looked-up words and the class that each one's neighbours favour."""
    shared, k = sums.sparkSession.sparkContext.broadcast(matrix), len(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, size, packed_sums in zip(*(batch.column(c).to_pylist() for c in ("block", "size", "sums")), strict=True):
                keys, n = unpacked(size, packed_sums)
                seen = np.bincount(keys, n, 2 * k * BLOCK).reshape(BLOCK, 2 * k)
                some = np.flatnonzero(seen.any(axis=1))
                cls = favoured(seen[some], shared.value)
                yield pa.RecordBatch.from_arrays([pa.array((block * BLOCK + some).astype(np.int32)), pa.array(cls.astype(np.int32))], names=["word", "cls"])

    moved = in_tasks(sums.where("block >= 0"), run, "word int, cls int").toPandas()  # 2 / lookup_share rows at most
    return moved["word"].to_numpy(np.int64), moved["cls"].to_numpy(np.int64)


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def best_class(matrix: np.ndarray, own: int, left: np.ndarray, right: np.ndarray, self_n: float) -> tuple[int, float]:
    """The class that a unit fits best, and what moving there gains in log likelihood.

    ``matrix``: class bigrams with the unit in class ``own``; ``left`` and ``right``: how
    often each class stands before and after it; ``self_n``: it beside itself.
    """
    m = matrix.astype(float)
    m[own] -= right
    m[:, own] -= left
    m[own, own] += self_n
    left, right = left.astype(float), right.astype(float)
    n_in, n_out = left.sum(), right.sum()
    left[own] -= self_n
    right[own] -= self_n
    base = xlogx(m)
    rows = xlogx(m + right) - base
    columns = xlogx(m + left[:, None]) - base
    d = np.arange(len(m))
    gain = rows.sum(axis=1) - rows[d, d] + columns.sum(axis=0) - columns[d, d]
    gain += xlogx(m[d, d] + left + right + self_n) - base[d, d]
    # Wherever the unit goes, what stands beside it counts in the sums of the others.
    out, into = m.sum(axis=1) + left, m.sum(axis=0) + right
    gain -= xlogx(out + n_out) - xlogx(out) + xlogx(into + n_in) - xlogx(into)
    to = int(np.argmax(gain))
    return (to, float(gain[to] - gain[own])) if gain[to] > gain[own] + 1e-6 else (own, 0.0)


def exchange(first: np.ndarray, second: np.ndarray, n: np.ndarray, n_units: int, n_classes: int, sweeps: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the units and the bigrams of classes.

    Units begin in classes dealt out by frequency. In order of frequency, each moves to
    its best class at once, for at most ``sweeps`` sweeps or until none moves. Units
    that never occur stay where they began.
    """
    totals = np.bincount(second, n, n_units)
    order = np.argsort(-totals, kind="stable")
    classes = np.zeros(n_units, np.int64)
    classes[order] = np.arange(n_units) % n_classes
    matrix = np.bincount(classes[first] * n_classes + classes[second], n, n_classes**2).reshape(n_classes, n_classes)
    by_first, by_second = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    places = np.arange(n_units + 1)
    row, column = np.searchsorted(first[by_first], places), np.searchsorted(second[by_second], places)
    for _ in range(sweeps):
        moved = 0
        for unit in order[totals[order] > 0]:
            after = by_first[row[unit] : row[unit + 1]]
            before = by_second[column[unit] : column[unit + 1]]
            right = np.bincount(classes[second[after]], n[after], n_classes)
            left = np.bincount(classes[first[before]], n[before], n_classes)
            same = float(n[after[second[after] == unit]].sum())
            own = int(classes[unit])
            to, gain = best_class(matrix, own, left, right, same)
            if gain <= 0:
                continue
            left[own] -= same
            right[own] -= same
            matrix[own] -= right
            matrix[:, own] -= left
            matrix[to] += right
            matrix[:, to] += left
            matrix[own, own] -= same
            matrix[to, to] += same
            classes[unit] = to
            moved += 1
        if not moved:
            break
    return classes, matrix


def favoured(seen: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The class of each word that makes its neighbours' classes likeliest; ``seen`` has how
    often each class stands before it, then behind it."""
    k = len(matrix)
    into, share = matrix.sum(axis=0) + 1.0, np.log(transitions(matrix))
    # P(class | before) P(word | class) P(after | class)
    return np.argmax(seen[:, :k] @ (share - np.log(into)) + seen[:, k:] @ share.T, axis=1)


def transitions(matrix: np.ndarray) -> np.ndarray:
    into, k = matrix.sum(axis=0), len(matrix)
    prior = (into + 1) / (into.sum() + k)
    return (matrix + k * prior) / (matrix.sum(axis=1, keepdims=True) + k)


def likelihood(matrix: np.ndarray) -> float:
    return float(xlogx(matrix.astype(float)).sum() - xlogx(matrix.sum(axis=0).astype(float)).sum() - xlogx(matrix.sum(axis=1).astype(float)).sum())


def occurrences(codes: DataFrame, end: int) -> DataFrame:
    """Each occurrence of a seldom word: hash, ending, spot (twice the row, plus one in
    training), sides (codes), and the hashes before and behind it of seldom words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, "__ids"):
                line = line_of(part.column("__ids"), end)
                rest, n = items(part.column("__rest"))
                at = np.flatnonzero(line < 0)
                hashes = np.zeros(len(line), np.int64)
                hashes[at] = rest
                left, right = line[at - 1], line[at + 1]
                spots = part.column("__row").to_numpy() * 2 + part.column("__train").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rest),
                        pa.array((-1 - line[at]).astype(np.int32)),
                        pa.array(np.repeat(spots, n)),
                        pa.array(left << 32 | right & 0xFFFFFFFF),
                        pa.array(hashes[at - 1], mask=left >= 0),
                        pa.array(hashes[at + 1], mask=right >= 0),
                    ],
                    names=["hash", "ending", "spot", "sides", "before", "behind"],
                )

    codes = codes.where(F.size("__rest") > 0).select("__row", "__train", "__ids", "__rest")
    return in_tasks(codes, run, "hash long, ending int, spot long, sides long, before long, behind long")


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in order of their hashes, gathered so that no hash is cut."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < GATHERED:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        keys = rows["hash"].to_numpy()
        other = np.flatnonzero(keys != keys[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield rows.slice(0, cut)
        held, n = rows.slice(cut).to_batches(), n - cut
    if n:
        yield pa.Table.from_batches(held)


WORDS = "hash long, ending int, n long, cls int, spots array<long>, sides array<long>, before array<long>, behind array<long>"
_WORDS = [c.split()[0] for c in WORDS.split(", ")]


def sides_seen(sides: np.ndarray, train: np.ndarray, owner: np.ndarray, words: int, classes: Classes, k: int) -> np.ndarray:
    """How often classes known by code stand before, then behind, each word."""
    seen = np.zeros(words * 2 * k)
    for code, behind in zip(split(sides), (0, k), strict=True):
        cls = classes.cls[code]
        told = train & (cls >= 0)
        seen += np.bincount(owner[told] * 2 * k + behind + cls[told], minlength=words * 2 * k)
    return seen.reshape(words, 2 * k)


def seldom_words(codes: DataFrame, classes: Classes, matrix: np.ndarray, endings: np.ndarray, moving: bool) -> DataFrame:
    """A row of ``WORDS`` for each seldom word, with the class that its neighbours favour
    by the ``classes`` of endings. Words that training has not seen have their ending's."""
    shared, k = codes.sparkSession.sparkContext.broadcast((classes, matrix, endings)), len(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cells, by_ending = shared.value
        for rows in whole_groups(batches):
            rows = rows.combine_chunks()
            hashes, ending, spots, sides = (rows[c].to_numpy() for c in ("hash", "ending", "spot", "sides"))
            first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
            cut = np.append(first, len(hashes))
            owner, train = np.repeat(np.arange(len(first)), np.diff(cut)), (spots & 1).astype(bool)
            n, cls = np.add.reduceat(spots & 1, first), by_ending[ending[first]]
            if moving:
                cls = np.where(n > 0, favoured(sides_seen(sides, train, owner, len(first), known, k), cells), cls)
            lists = [pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(x)) for x in (spots, sides)]
            for c in ("before", "behind"):
                column = rows[c].combine_chunks()
                some = np.concatenate([[0], np.cumsum(column.is_valid().to_numpy(zero_copy_only=False))])[cut]
                lists.append(pa.ListArray.from_arrays(pa.array(some.astype(np.int32)), column.drop_null()))
            yield pa.RecordBatch.from_arrays([pa.array(hashes[first]), pa.array(ending[first]), pa.array(n), pa.array(cls.astype(np.int32)), *lists], names=_WORDS)

    return in_tasks(occurrences(codes, classes.end).repartition("hash").sortWithinPartitions("hash"), run, WORDS)


def messages(words: DataFrame, k: int, both: bool) -> DataFrame:
    """hash, code, spot: what seldom words tell the seldom word behind them, their class, and
    with ``both`` the one before them, ``k`` plus their class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, "spots"):
                spots, n = items(part.column("spots"))
                own = np.repeat(part.column("cls").to_numpy(), n)
                left, right = split(items(part.column("sides"))[0])
                for code, column, plus in ((right, "behind", 0), (left, "before", k))[: 1 + both]:
                    told = code < 0
                    yield pa.RecordBatch.from_arrays(
                        [part.column(column).flatten(), pa.array((plus + own[told]).astype(np.int32)), pa.array(spots[told])], names=["hash", "code", "spot"]
                    )

    some = (F.size("behind") > 0) | (F.size("before") > 0) & F.lit(both)
    return in_tasks(words.where(some).select("cls", "spots", "sides", "before", "behind"), run, "hash long, code int, spot long")


def pairs_of(words: DataFrame, k: int) -> DataFrame:
    """spot and cell (the first class times ``k`` plus the second) of two seldom words side by side."""
    return messages(words, k, False).join(words.select("hash", "cls"), "hash").select("spot", (F.col("code") * k + F.col("cls")).alias("cell"))


def told_words(words: DataFrame, classes: Classes, matrix: np.ndarray) -> DataFrame:
    """The seldom words with the class that all their neighbours favour: the looked-up ones
    by ``classes``, the seldom ones by what a join tells."""
    shared, k = words.sparkSession.sparkContext.broadcast((classes, matrix)), len(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cells = shared.value
        for batch in batches:
            for whole in portions(batch, "spots"):
                for start in range(0, whole.num_rows, GATHERED):
                    part = whole.slice(start, GATHERED)
                    spots, n = items(part.column("spots"))
                    owner = np.repeat(np.arange(part.num_rows), n)
                    seen = sides_seen(items(part.column("sides"))[0], (spots & 1).astype(bool), owner, part.num_rows, known, k)
                    told, n = items(part.column("told"))
                    seen += np.bincount(np.repeat(np.arange(part.num_rows), n) * 2 * k + told, minlength=seen.size).reshape(seen.shape)
                    own, n = (part.column(c).to_numpy() for c in ("cls", "n"))
                    cls = np.where(n > 0, favoured(seen, cells), own)
                    columns = [pa.array(cls.astype(np.int32)) if c == "cls" else part.column(c) for c in _WORDS]
                    yield pa.RecordBatch.from_arrays(columns, names=_WORDS)

    told = messages(words, k, True).where("spot % 2 = 1").groupBy("hash").agg(F.collect_list("code").alias("told"))
    words = words.join(told, "hash", "left").withColumn("told", F.coalesce("told", F.array().cast("array<int>")))
    return in_tasks(words.select(*_WORDS, "told"), run, WORDS)


@dataclass
class Kept:
    """The best classes so far: of looked-up words and the end by code, of seldom words in
    their rows or by their ending, and the bigrams of classes."""

    classes: Classes
    matrix: np.ndarray
    words: DataFrame
    pairs: DataFrame | None = None  # of seldom words; None while classes go by endings

    @property
    def by_ending(self) -> bool:
        return self.pairs is None


def class_rare(codes: DataFrame, store: Store, classes: Classes, matrix: np.ndarray, endings: np.ndarray, rounds: int) -> Kept:
    """Classes of all words. Those that are not frequent begin in their endings' classes; a
    round in which the likelihood does not grow is the last and is not kept.

    Each round reads the codes. Neighbours whose classes a task knows are summed by class
    there; the rows of seldom words tell the looked-up ones beside them.
    """
    k = len(matrix)
    words = store.put(seldom_words(codes, classes, matrix, endings, rounds > 0), "seldom")
    kept = Kept(classes, matrix, words)
    sums = store.put(added(sightings(codes, classes, k, False, True), k), "sums") if rounds else None
    for left in range(rounds - 1, -1, -1):
        place, cls = favoured_words(sums, matrix)
        store.drop(sums)
        of = classes.cls.copy()
        of[place] = cls
        of[classes.end + 1 :] = -1
        if not kept.by_ending:  # in the first round they have moved as they were stored
            words = store.put(told_words(words, classes, matrix), "seldom")
        classes = Classes(of, classes.moving, classes.end)
        seen = sightings(codes, classes, k, True, left > 0).unionByName(seldom_sightings(words, classes, k, left > 0))
        sums = store.put(added(seen, k), "sums")
        pairs = store.put(pairs_of(words, k), "pairs")
        matrix = class_bigrams(sums, pairs, k)
        if likelihood(matrix) <= likelihood(kept.matrix):
            store.drop(pairs, *([] if kept.by_ending else [words]))
            break
        if not kept.by_ending:
            store.drop(kept.words, kept.pairs)
        kept = Kept(classes, matrix, words, pairs)
    if rounds:
        store.drop(sums)
    return kept


def class_bigrams(sums: DataFrame, pairs: DataFrame, k: int) -> np.ndarray:
    """All bigrams of classes in training, each counted once."""
    out = np.zeros(k * k, np.int64)
    for r in sums.where("block < 0").collect():  # one row
        keys, n = unpacked(r["size"], bytes(r["sums"]))
        out[keys] += n
    for r in pairs.where("spot % 2 = 1").groupBy("cell").count().collect():  # a row for each pair of classes
        out[r["cell"]] += r["count"]
    return out.reshape(k, k)


@dataclass
class Model:
    """Everything that a task needs to score: bounded by the numbers of classes and lookups."""

    units: np.ndarray  # hashes of frequent words, sorted
    lookup: np.ndarray  # hashes of words with known counts, sorted
    lookup_n: np.ndarray
    by_code: np.ndarray  # classes of looked-up words and the end; -1 of others, or their ending's
    classes: np.ndarray  # of units, then of endings for unknown words, then of the end
    transition: np.ndarray  # log10, by class and next class
    emission: np.ndarray  # log10 of a unit, or of an unknown word, within its class
    within: np.ndarray  # log10 of what a class's words share, by class
    ends: int
    train_tokens: int
    vocabulary: int

    @property
    def endings(self) -> np.ndarray:
        return self.classes[len(self.units) : -1]


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within this block a job's shuffle files go when it ends: what later jobs read is stored."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def fit(docs: DataFrame, **options) -> tuple[Model, DataFrame]:
    """The model of the rows with ``train`` set, and the table of word counts, with the class
    ``cls`` of words that are not units. ``options`` as of ``learned``."""
    store = Store(docs.sparkSession)
    model, words, codes, kept = learned(docs, (), store, **options)
    store.drop(codes)
    rare = (model.lookup_n > 0) & ~np.isin(model.lookup, model.units)
    table = pa.table({"hash": model.lookup[rare], "cls": model.by_code[: len(rare)][rare].astype(np.int32)})
    own = docs.sparkSession.createDataFrame(table.to_pandas(), "hash long, cls int")
    seldom = with_class(kept.words, kept, model.endings).where("n > 0").select("hash", "cls")
    return model, words.join(own.unionByName(seldom), "hash", "left")


def with_class(words: DataFrame, kept: Kept, endings: np.ndarray) -> DataFrame:
    """The seldom words' rows with the class that they keep."""
    if not kept.by_ending:
        return words
    return words.withColumn("cls", F.element_at(F.array(*[F.lit(int(c)) for c in endings]), F.col("ending") + 1))


def learned(
    docs: DataFrame,
    keep: tuple[str, ...],
    store: Store,
    unit_share: float = 2e-4,
    lookup_share: float = 1e-6,
    n_classes: int = 64,
    sweeps: int = 10,
    rounds: int = 2,
) -> tuple[Model, DataFrame, DataFrame, Kept]:
    """The model, and as stored tables the counts of words, the codes of texts, and what is
    known of seldom words."""
    with tidy_shuffles(docs.sparkSession):
        words = store.put(word_counts(docs), "words")
        total = words.agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.sum((F.col("n_train") > 0).cast("long")), F.coalesce(F.sum("n_all"), F.lit(0))).first()
        ends = docs.where("train").count()
        in_train, n_train, v = int(total[0]), int(total[0]) + ends, int(total[1] or 0) + (ends > 0)
        # At most 2 / lookup_share rows. What is frequent in all texts alone is looked up so that
        # it need not be dealt out; all that is chosen goes by counts of training.
        often = (F.col("n_train") >= max(1.0, lookup_share * in_train)) | (F.col("n_all") >= max(1.0, lookup_share * int(total[2])))
        often = words.where(often).select("hash", "ending", "n_train").toPandas().sort_values("hash")
        lookup, lookup_n, ending = (often[c].to_numpy(np.int64) for c in ("hash", "n_train", "ending"))
        frequent = lookup_n >= max(1.0, unit_share * in_train)
        units = Units(lookup[frequent])
        head, end = len(units.words), len(lookup)
        numbered = coded(docs, keep, lookup).withColumn("__row", F.monotonically_increasing_id())
        codes = store.put(numbered, "codes")
        # A row for each pair of units that occurs: (1 / unit_share + ENDINGS + 1) ** 2 at most,
        # whatever the size of the corpus; they lay out the classes.
        bigrams = unit_bigrams(codes, by_code(units.of(lookup, ending), units.end, head + np.arange(ENDINGS)), end, units.count)
        bigrams = bigrams.toPandas().sort_values(["first", "second"])
        first, second, n = (bigrams[c].to_numpy(np.int64) for c in ("first", "second", "n"))
        classes, matrix = exchange(first, second, n, units.count, n_classes, sweeps)
        n_unit = np.bincount(second, n, units.count)
        endings = classes[head : units.end]
        begin = endings[ending]
        begin[frequent] = classes[:head]  # both in order of hashes
        rare = (lookup_n > 0) & ~frequent
        known = Classes(by_code(begin, classes[units.end], endings), by_code(rare, False, np.zeros(ENDINGS, bool)), end)
        kept = class_rare(codes, store, known, matrix, endings, rounds)
        matrix, own = kept.matrix, kept.classes.cls[:end]
        # A word counts one more than it occurs, and so does one unknown word of each ending.
        weight = np.bincount(classes, minlength=n_classes) + matrix.sum(axis=0) + np.bincount(own[rare], minlength=n_classes)
        for r in with_class(kept.words, kept, endings).where("n > 0").groupBy("cls").count().collect():  # a row a class
            weight[r["cls"]] += r["count"]
    within = np.log10(weight)
    n_unit[head : units.end] = 0
    model = Model(
        units.words, lookup, lookup_n, kept.classes.cls, classes, np.log10(transitions(matrix)),
        np.log10(n_unit + 1) - within[classes], within, ends, n_train, v,
    )
    return model, words, codes, kept


def text_scores(codes: DataFrame, keep: tuple[str, ...], model: Model) -> DataFrame:
    """``__row``, ``keep`` and per text: tokens, known tokens, sum of log10(c + 1) and model
    score, without the seldom words and the transitions on their sides."""
    shared = codes.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        end, none = len(model.lookup), np.zeros(ENDINGS)
        cls = model.by_code.copy()
        cls[end + 1 :] = -1
        n = by_code(model.lookup_n, model.ends, none)
        log_n = np.log10(n + 1.0)
        word = np.where(cls >= 0, log_n - model.within[cls], 0.0)
        for batch in batches:
            for part in portions(batch, "__ids"):
                length = pc.list_value_length(part.column("__ids")).to_numpy(zero_copy_only=False) + 1
                owner = np.repeat(np.arange(part.num_rows), length)
                line = line_of(part.column("__ids"), end)
                c = cls[line]
                told = (c[:-1] >= 0) & (c[1:] >= 0)
                line = line[1:]
                score = np.where(told, model.transition[c[:-1], c[1:]], 0.0) + word[line]
                columns = [
                    pa.array(length.astype(np.int64)),
                    pa.array(np.bincount(owner, n[line] > 0, part.num_rows).astype(np.int64)),
                    pa.array(np.bincount(owner, log_n[line], part.num_rows)),
                    pa.array(np.bincount(owner, score, part.num_rows)),
                ]
                names = ["n_tokens", "__known", "__base", "__class"]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("__row", *keep)), *columns], names=["__row", *keep, *names])

    kept = "".join(f"`{c}` {codes.schema[c].dataType.simpleString()}, " for c in keep)
    return in_tasks(codes.select("__row", *keep, "__ids"), run, f"__row long, {kept}n_tokens long, __known long, __base double, __class double")


def seldom_scores(kept: Kept, model: Model) -> DataFrame:
    """What seldom words add to the texts, by ``__row``."""
    words = with_class(kept.words, kept, model.endings)
    shared = words.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        cls = model.by_code
        for batch in batches:
            for part in portions(batch, "spots"):
                spots, times = items(part.column("spots"))
                left, right = split(items(part.column("sides"))[0])
                n, own = (np.repeat(part.column(c).to_numpy(), times) for c in ("n", "cls"))
                log_n, before = np.log10(n + 1.0), cls[left]
                score = log_n - model.within[own] + np.where(before >= 0, model.transition[before, own], 0.0)
                # Of two seldom words the second counts what is between them.
                score += np.where(right >= 0, model.transition[own, cls[right]], 0.0)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (spots >> 1, log_n, (n > 0).astype(np.int32), score)], names=["__row", "more", "known", "class"])

    out = in_tasks(words.select("n", "cls", "spots", "sides"), run, "__row long, more double, known int, class double")
    if not kept.by_ending:

        def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                spots, cells = (batch.column(c).to_numpy() for c in ("spot", "cell"))
                zero = pa.array(np.zeros(len(spots)))
                score = pa.array(shared.value.transition.ravel()[cells])
                yield pa.RecordBatch.from_arrays([pa.array(spots >> 1), zero, zero.cast(pa.int32()), score], names=["__row", "more", "known", "class"])

        out = out.unionByName(in_tasks(kept.pairs, between, "__row long, more double, known int, class double"))
    return out.groupBy("__row").agg(F.sum("more").alias("__more"), F.sum("known").alias("__more_known"), F.sum("class").alias("__more_class"))


def with_scores(docs: DataFrame, train: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), **options) -> DataFrame:
    """Learn from the rows where the boolean column ``train`` holds; score every row.

    Returns the columns ``keep`` and n_tokens, n_known, train_tokens, base_score and
    score. Tokens are words (runs without ASCII white space, A-Z lowered) and one end.
    A null or empty text has its end only. Without training texts every token is
    unknown. Repeated rows are scored, and counted in training, each. ``options`` as
    of ``learned``.
    """
    docs = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(train), F.lit(False)).alias("train"))
    store = Store(docs.sparkSession)
    model, words, codes, kept = learned(docs, keep, store, **options)
    store.drop(words)
    scored, rest = text_scores(codes, keep, model), seldom_scores(kept, model)
    size = math.log10(model.train_tokens + model.vocabulary + 1)
    more, known = F.coalesce("__more", F.lit(0.0)), F.coalesce("__more_known", F.lit(0))
    return scored.join(rest, "__row", "left").select(
        *keep,
        "n_tokens",
        (F.col("__known") + known).alias("n_known"),
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("__base") + more - F.col("n_tokens") * size).alias("base_score"),
        (F.col("__class") + F.coalesce("__more_class", F.lit(0.0))).alias("score"),
    )


def digest(docs: DataFrame) -> DataFrame:
    held = docs.select("doc_id", "text", (remainder("doc_id", 7) == 2).alias("held_out")).withColumn("train", ~F.col("held_out"))
    return with_scores(held, "train", keep=("doc_id", "held_out"))
