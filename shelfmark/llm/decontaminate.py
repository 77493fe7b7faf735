"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's windows.

Every benchmark text is cut into windows of ``window`` words. The automaton holds all
windows of all items and reads each document once; what it finds is mapped back to
words and to character offsets of the document as it was given.

The benchmark is a stated query set: its windows go to every task. They are dealt into
blocks of at most ``block_bytes``, an automaton each, so a larger set takes more
passes over a batch in a task's memory, not a larger automaton.
"""

from __future__ import annotations

import re
from collections import defaultdict

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import map_texts
from shelfmark.operators.once import once_per_worker

#: Letters a-z after lower-casing, digits, and every byte beyond ASCII make words.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def windows(text: bytes, size: int) -> list[bytes]:
    """Runs of ``size`` words; all words of a shorter text; nothing without words."""
    found = words(text)
    return [b" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))] if found else []


def blocks(items, size: int, block_bytes: int) -> list[list[tuple[bytes, int, list[str]]]]:
    """(window, its words, ids of the items that have it), dealt into blocks."""
    owners: dict[bytes, set[str]] = defaultdict(set)
    for item, text in items:
        for window in windows((text or "").encode("utf-8", "replace"), size):
            owners[window].add("" if item is None else str(item))
    out, room = [], 0
    for window, ids in sorted(owners.items()):
        if not out or room < len(window):
            out.append([])
            room = block_bytes
        room -= len(window)
        out[-1].append((window, window.count(b" ") + 1, sorted(ids)))
    return out


def _automaton(windows: list[tuple[bytes, int, list[str]]]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for window, n, ids in windows:
        machine.add_word(f" {window.decode('latin-1')} ", (n, ids))
    machine.make_automaton()
    return machine


def haystack(text: bytes) -> str:
    return f" {b' '.join(words(text)).decode('latin-1')} "


def placed(text: bytes, hits: list[tuple[int, tuple]]) -> tuple[int, int, list[str], list[tuple[int, int]]]:
    """Words, hit words, items found, and hit stretches as code points of the text.

    ``hits`` are what the automata say of the haystack: where a window ends, its number
    of words and its items.
    """
    found = words(text)
    if not hits:
        return len(found), 0, [], []
    items = {item for _, (_, ids) in hits for item in ids}
    ends = np.flatnonzero(np.frombuffer(haystack(text).encode("latin-1"), np.uint8) == 32)
    steps = np.zeros(len(found) + 1, np.int64)
    at, n = np.array([(end, n) for end, (n, _) in hits]).T
    last = np.searchsorted(ends, at)
    np.add.at(steps, last - n, 1)
    np.add.at(steps, last, -1)
    hit = np.concatenate([[False], np.cumsum(steps[:-1]) > 0, [False]])
    edges = np.flatnonzero(hit[1:] != hit[:-1]).reshape(-1, 2)
    place = np.array([m.span() for m in WORD.finditer(text.translate(FOLD))])
    points = np.cumsum(np.concatenate([[0], (np.frombuffer(text, np.uint8) & 0xC0) != 0x80]))
    spans = [(int(points[place[a, 0]]), int(points[place[b - 1, 1]])) for a, b in edges]
    return len(found), int(hit.sum()), sorted(items), spans


FIELDS = [
    ("n_words", "bigint", pa.int64()),
    ("n_hit", "bigint", pa.int64()),
    ("items", "array<string>", pa.list_(pa.string())),
    ("spans", "array<struct<start:bigint,end:bigint>>", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
]


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    block_bytes: int = 64 << 20,
) -> DataFrame:
    """Mark the words of ``docs`` that lie inside a benchmark window.

    Adds n_words, n_hit, items (ids as text, sorted as text) and spans (character
    offsets of the hit stretches in the given text). A null or wordless document has
    no words and no hits; a null or wordless item has no window; an item with fewer
    words than ``window`` is one window; repeated items and windows count once. An
    empty benchmark hits nothing. Input columns named like an output are replaced.
    """
    spark = docs.sparkSession
    # A stated query set, read row by row on the driver to build the windows.
    rows = ((r[0], r[1]) for r in benchmark.select(item_id, item_text).toLocalIterator())
    dealt = blocks(rows, window, block_bytes)
    shared = spark.sparkContext.broadcast(dealt)
    count, name = len(dealt), f"{spark.sparkContext.applicationId}-{shared._jbroadcast.id()}"

    def start():
        def step(texts):
            values = [t.as_py() for t in texts]
            hits: list[list] = [[] for _ in values]
            for i in range(count):
                machine = once_per_worker("automaton", (name, i), lambda i=i: _automaton(shared.value[i]), most=1)
                for found, value in zip(hits, values, strict=True):
                    found += machine.iter(haystack(value))
            rows = [placed(v, found) for v, found in zip(values, hits, strict=True)]
            return [list(c) for c in zip(*rows, strict=True)]

        return step

    return map_texts(docs, start, FIELDS, text, keep)


def contaminated(percent: int = 5) -> F.Column:
    """A hit, and hit words make up ``percent`` of all words at least."""
    return (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: counts, a digest of the items, and the verdict."""
    found = find_overlaps(docs, benchmark, keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


#: DuckDB's word pattern must see ASCII only as words of a-z and 0-9.
SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT dw.r, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.s = bw.s AND dw.n = bw.n),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM m) GROUP BY r),
it AS (
  SELECT r, count(DISTINCT CAST(item_id AS VARCHAR)) AS n_items,
    sha256(array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',')) AS items_sha256
  FROM m GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN it USING (r)
"""
