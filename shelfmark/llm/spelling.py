"""Spelling variants: words of one edit's distance, found in a trie that is a table.

Words are counted over whole texts. All of them make a trie, forwards and backwards, whose
edges (node, letter, child) are a stored table in ranges of depth and node; a node is named by
the hash of the letters that lead to it. A frontier of states (word, position, node, edits)
goes down level by level, each level one join with the edges of its depth: a state without an
edit takes an edge of another letter or skips a letter of its word, a state with one follows
its own letters only. A state that has used up its word where a word ends is a neighbour.

The edit lies in one half of the word, so the forward trie is entered at half of the word's
length, the backward one at the rest, where few words share a node. An edit is made from one
side only (the smaller letter is replaced, the longer word skips) and the pair is turned
around afterwards. Words of over ``DEEPEST`` letters go down in one step: the hashes of what
is before and behind a letter are joined as they are. Pairs are confirmed on the words.

Nulls: a text that is null has no words, a key that is null counts as the empty text.
Repeated rows count as often as they stand. No word is left out for its length or for the
number of its neighbours.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Rolling, Store, in_tasks, parts
from shelfmark.session import fresh_path

# Fixed values of the contract: what a run is, which runs lose a letter, what a word is.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOSES = 97
MIN_LETTERS = 5
MIN_COUNT = 3

# Levels that the frontier goes through one by one.
DEEPEST = 64

# Words that a task counts before it hands them on, and letters of a text looked at at once.
HELD_WORDS = 200_000
STRETCH = 1 << 20

_BREAK = re.compile("[^A-Za-zÀ-ÿ]")


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """A text in pieces of about ``size`` letters that no run crosses."""
    start = 0
    while start < len(text):
        found = _BREAK.search(text, start + size)
        stop = found.start() if found else len(text)
        yield text[start:stop]
        start = stop


def runs(key: str, text: str) -> Iterator[tuple[str, int]]:
    """Runs of a text with A-Z lower-cased, some a letter short, and how often they stand."""
    head = zlib.crc32(f"{key}:".encode())
    for piece in stretches(text):
        for run, n in Counter(RUN.findall(piece.encode().lower().decode())).items():
            h = zlib.crc32(run.encode(), head)
            if h % LOSES == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            yield run, n


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", letters: int = MIN_LETTERS, least: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of the words of at least ``letters`` letters that stand ``least`` times.

    A task adds up its words and hands them on when it holds many, so that a frequent word
    is a row per task, not one per text.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def handed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for part in parts(batch, "__text"):
                for k, t in zip(part.column("__key").to_pylist(), part.column("__text").to_pylist(), strict=True):
                    for word, n in runs(k, t or ""):
                        if len(word) >= letters:
                            held[word] += n
                    if len(held) >= HELD_WORDS:
                        yield handed()
        yield handed()

    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("__key"), F.col(text).alias("__text"))
    counts = in_tasks(rows, count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _steps(words: DataFrame) -> DataFrame:
    """A row for each word, way and depth from its half on: the node, the letter that leaves
    it, the child, the word if it ends there, and whether skipping the letter is the one
    way to write that skip (the last of a run of equal letters)."""
    m = F.char_length("word")
    ways = words.select("word", "n", m.alias("m"), F.posexplode(F.array("word", F.reverse("word"))).alias("way", "letters"))
    half = F.floor((F.col("m") + F.col("way")) / 2).cast("int")
    steps = ways.where(half < F.col("m")).select("*", F.explode(F.sequence(half, F.col("m") - 1)).alias("depth"))

    def node(depth: Column) -> Column:
        return F.xxhash64("way", F.substring("letters", 1, depth))

    depth, letter = F.col("depth"), _letter(F.col("depth"))
    beside = F.when(F.col("way") == 0, _letter(depth + 1)).otherwise(_letter(depth - 1))
    ends = depth == F.col("m") - 1
    return steps.select(
        "letters", "way", "n", "m", "depth", node(depth).alias("node"), letter.alias("letter"), node(depth + 1).alias("child"),
        (beside != letter).alias("skips"), F.when(ends, F.col("word")).alias("other"), F.when(ends, F.col("n")).alias("other_n"),
    )


def _letter(at: Column) -> Column:
    """The letter at a position from 0; empty past the end."""
    return F.substring("letters", at + 1, F.lit(1))


class _Levels:
    """A table in the shared folder, cut by depth."""

    def __init__(self, df: DataFrame, name: str):
        self.spark, self.path, self.schema = df.sparkSession, fresh_path(df.sparkSession, name), df.schema
        # In ranges, so that a depth is few files, and a crowded node is spread like any rows.
        df.repartitionByRange("depth", "node", "child").write.partitionBy("depth").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def at(self, depth: int) -> DataFrame:
        return self.read().where(F.col("depth") == depth).drop("depth")


def _walked(words: DataFrame, store: Store) -> DataFrame:
    """Pairs of words of up to ``DEEPEST`` letters whose edit leaves a letter behind it to
    walk, or replaces the last: ``(word, n, other, other_n)``, each once."""
    steps = _Levels(_steps(words), "steps")
    edges = _Levels(
        steps.read().groupBy("depth", "node", "letter", "child").agg(F.max("other").alias("other"), F.max("other_n").alias("other_n")), "edges"
    )
    span = steps.read().agg(F.min("depth"), F.max("depth")).first()
    state = ["letters", "way", "n", "m"]
    moved = [*state, "at", "node", "edits", "letter"]
    found, frontier = [], None
    for depth in range(span[0], span[1] + 1) if span[0] is not None else ():
        here = steps.at(depth)
        at = F.lit(depth)
        fresh = here.select(*state, at.alias("at"), "node", F.lit(0).alias("edits"), "letter")
        skips = here.where(F.col("skips") & (F.col("m") > depth + 1)).select(
            *state, (at + 1).alias("at"), "node", F.lit(1).alias("edits"), _letter(at + 1).alias("letter")
        )
        states = fresh.unionByName(skips)
        if frontier is not None:
            walking = frontier.where(F.col("at") < F.col("m"))
            states = states.unionByName(walking.select(*state, "at", "node", F.lit(1).alias("edits"), _letter(F.col("at")).alias("letter")))
        edge = edges.at(depth).withColumnRenamed("letter", "taken")
        takes = F.when(F.col("edits") == 0, F.col("taken") > F.col("letter")).otherwise(F.col("taken") == F.col("letter"))
        went = states.select(*moved).join(edge, "node").where(takes)
        went = went.select(*state, (F.col("at") + 1).cast("int").alias("at"), F.col("child").alias("node"), "other", "other_n")
        done = F.col("at") == F.col("m")
        # A state at its word's end is a neighbour or nothing; others are not there yet.
        frontier = store.put(went.where(~done | F.col("other").isNotNull()), "frontier")
        found.append(frontier.where(done))
    if not found:
        return words.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).limit(0)
    every = found[0]
    for level in found[1:]:
        every = every.unionByName(level)
    word = F.when(F.col("way") == 0, F.col("letters")).otherwise(F.reverse("letters"))
    return every.select(word.alias("word"), "n", "other", "other_n")


def _shortened(words: DataFrame) -> DataFrame:
    """Pairs whose longer word only loses its first or last letter: the state is at its
    word's end where it is, without an edge to take."""
    m = F.char_length("word")
    last = F.substring("word", F.lit(1), m - 1)
    first = F.when(F.substring("word", 1, 1) != F.substring("word", 2, 1), F.substring("word", F.lit(2), m))
    cut = words.where(m <= DEEPEST).select("word", "n", F.explode(F.array(last, first)).alias("other"))
    return cut.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other").select("word", "n", "other", "other_n")


def _deep(words: DataFrame) -> DataFrame:
    """Pairs with a word of over ``DEEPEST`` letters as the longer or an equally long one.
    A word is a row for each of its letters: hashes of all before it and all behind it."""
    long_ones = words.where(F.char_length("word") > DEEPEST)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(211)
        for batch in batches:
            for number, word in zip(batch.column("number").to_pylist(), batch.column("word").to_pylist(), strict=True):
                data = np.frombuffer(word.encode("latin-1"), np.uint8)
                sums, at = rolling.prefix(data), np.arange(len(data))
                zero, end = np.zeros_like(at), np.full_like(at, len(data))
                columns = [np.full_like(at, number), at, rolling.of(sums, zero, at).view(np.int64), rolling.of(sums, at + 1, end).view(np.int64), data.astype(np.int16)]
                yield from pa.table(columns, names=["number", "at", "before", "behind", "letter"]).to_batches(max_chunksize=65_536)

    numbered = long_ones.select(F.xxhash64("word").alias("number"), "word", "n")
    rows = in_tasks(numbered.select("number", "word"), spell, "number long, at long, before long, behind long, letter short")
    other = rows.select("at", "before", "behind", *[F.col(c).alias(f"{c}_2") for c in ("number", "letter")])
    replaced = rows.join(other, ["at", "before", "behind"]).where(F.col("letter") < F.col("letter_2")).select("number", "number_2")
    named = numbered.select(F.col("number").alias("number_2"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    replaced = replaced.join(numbered, "number").join(named, "number_2").select("word", "n", "other", "other_n")
    # A letter more: the shorter word is cut at each place, the longer one loses the letter there.
    whole = words.where(F.char_length("word") >= DEEPEST).select(F.xxhash64("word").alias("number"), "word", "n")

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(211)
        for batch in batches:
            for number, word in zip(batch.column("number").to_pylist(), batch.column("word").to_pylist(), strict=True):
                data = np.frombuffer(word.encode("latin-1"), np.uint8)
                sums, at = rolling.prefix(data), np.arange(len(data) + 1)
                columns = [np.full_like(at, number), at, rolling.of(sums, np.zeros_like(at), at).view(np.int64), rolling.of(sums, at, np.full_like(at, len(data))).view(np.int64)]
                yield from pa.table(columns, names=["number_2", "at", "before", "behind"]).to_batches(max_chunksize=65_536)

    cut = in_tasks(whole.select("number", "word"), cuts, "number_2 long, at long, before long, behind long")
    named = whole.select(F.col("number").alias("number_2"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    # Of a run of equal letters any may go; the pair is one.
    skipped = rows.join(cut, ["at", "before", "behind"]).select("number", "number_2").distinct()
    return replaced.unionByName(skipped.join(numbered, "number").join(named, "number_2").select("word", "n", "other", "other_n"))


def near_words(words: DataFrame) -> DataFrame:
    """All ordered pairs of different words that one inserted, deleted or replaced letter
    turns into each other: ``(word, n, other, other_n)``. ``words`` holds each word once
    and is read several times."""
    store = Store(words.sparkSession)
    short = words.where(F.char_length("word").between(1, DEEPEST))
    pairs = _walked(short, store).unionByName(_shortened(words)).unionByName(_deep(words))
    pairs = pairs.where(F.levenshtein("word", "other") == 1)
    both = F.array(
        F.struct("word", "n", "other", "other_n"),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")),
    )
    return pairs.select(F.inline(both))


def variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` for each word: its near word of largest n
    (ties: the first in code-point order) if that is ``ratio`` times its own at least, and
    the word where following the forms ends. A form is more frequent each time, so no
    path is a circle and its length is bounded by the logarithm of the largest n."""
    store = Store(words.sparkSession)
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    )
    told = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.form").alias("near"), (-F.col("best.less")).alias("near_n"))
    strong = F.col("near_n") >= ratio * F.col("n")
    told = store.put(
        told.select("word", "n", "n_near", F.when(strong, F.col("near")).alias("form"), F.when(strong, F.col("near_n")).alias("form_n")), "told"
    )
    roots = told.where("form is not null").select("word", F.col("form").alias("root"))
    while True:  # each round doubles the steps taken
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        roots = store.put(roots.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("went")), "roots")
        if not roots.where("went").head(1):
            break
        roots = roots.drop("went")
    return told.join(roots.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def digest(docs: DataFrame) -> DataFrame:
    words = Store(docs.sparkSession).put(word_counts(docs), "words")
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")


#: crc32 from its polynomial, one table of 256 values; pairs by the strings that words leave
#: when a letter goes; roots by recursion.
SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)),
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i)) x),
run AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents) x),
counted AS (SELECT doc_id, run, count(*) AS n FROM run GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(1, length(code) + 1, 2), lambda i: CAST('0x' || substr(code, i::INT, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS h
  FROM (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS code FROM counted) x, crc_table),
cut AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
  FROM hashed),
word AS (
  SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gap AS (
  SELECT DISTINCT word, n, i, substr(word, 1, i::INT - 1) AS a, substr(word, i::INT + 1) AS b
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word) x),
near AS (
  SELECT g.word, g.n, k.word AS other, k.n AS other_n FROM gap g JOIN gap k ON g.a = k.a AND g.b = k.b AND g.word <> k.word
  UNION SELECT g.word, g.n, w.word, w.n FROM gap g JOIN word w ON g.a || g.b = w.word
  UNION SELECT w.word, w.n, g.word, g.n FROM gap g JOIN word w ON g.a || g.b = w.word),
best AS (
  SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM near),
told AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
         CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
  FROM word w LEFT JOIN (SELECT * FROM best WHERE place = 1) b ON w.word = b.word),
path AS (
  SELECT word, word AS place FROM told
  UNION ALL SELECT p.word, t.form FROM path p JOIN told t ON p.place = t.word WHERE t.form IS NOT NULL)
SELECT t.word, t.form, p.place AS root, t.n, t.n_near, t.form_n
FROM told t JOIN path p ON t.word = p.word JOIN told e ON p.place = e.word WHERE e.form IS NULL
"""
