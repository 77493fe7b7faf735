"""Spelling variants against comparisons of all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from helpers import CLASHES, LONG, edge_docs

from shelfmark.llm import spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    p = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p:] == b[p + 1 :]


def counted(rows):
    out = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def told(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    best = {w: min(near[w], key=lambda v: (-words[v], v)) for w in words if near[w]}
    form = {w: v for w, v in best.items() if words[v] >= 2 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (n, len(near[w]), form.get(w), words.get(form.get(w)), root(w)) for w, n in words.items()}


def rows_of(df):
    rows = df.collect()
    out = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(out) == len(rows)
    return out


def test_words_of_all_lengths(spark, monkeypatch):
    monkeypatch.setattr(spelling, "DEEPEST", 12)
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))): rng.randrange(1, 50) for _ in range(700)}
    # Runs of equal letters, and lengths around the last level.
    words |= {"a" * n: rng.randrange(1, 9) for n in range(1, 40)}
    for n in (10, 11, 12, 13, 14, 60):
        base = "".join(rng.choice("xyzÿ") for _ in range(n))
        for at in (0, 1, n // 2, n - 1):
            words |= {base[:at] + "q" + base[at + 1 :]: 5, base[:at] + base[at + 1 :]: 7, base[:at] + "q" + base[at:]: 90}
        words |= {base: 20, base + "q": 3}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert rows_of(spelling.variants(df)) == told(words)


def test_texts(spark):
    rng = random.Random(6)
    stems = ["spelling", "speling", "grouping", "groupings", "Économie", "économie", "letter", "better", "latter"]
    rows = [(rng.choice([None, 1, 2, 33, -4]), " ".join(rng.choice(stems) + rng.choice(["", "s", "S", "x"]) for _ in range(rng.randrange(40)))) for _ in range(150)]
    rows += [rows[0]] * 5 + [(9, None), (9, ""), (9, "a-b_c×d÷e 1letter2 人letter人")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(spelling.digest(df)) == told(counted(rows))


def test_a_text_in_stretches_has_the_same_runs():
    text = LONG + "a" * 500 + " " + "é" * 300
    whole = Counter(dict(spelling.runs("7", text)))
    parts = Counter()
    for piece in spelling.stretches(text, 100):
        assert len(piece) < 700
        for run, n in spelling.runs("7", piece):
            parts[run] += n
    assert parts == whole


@pytest.mark.parametrize("rows", [None, []], ids=["rows", "empty"])
def test_edges(spark, rows):
    docs = edge_docs(spark, rows)
    assert set(CLASHES) <= set(docs.columns)
    got = rows_of(spelling.digest(docs))
    assert got == (told(counted([(r.doc_id, r.text) for r in docs.collect()])) if rows is None else {})


def test_a_word_with_thousands_of_neighbours(spark):
    letters = [chr(c) for c in [*range(97, 123), *range(0xE0, 0x100)]]
    hub = "abcdefghij"
    words = {hub[:i] + c + hub[i + k :]: 1 + i for i in range(10) for c in letters for k in (0, 1)} | {hub: 1000}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = rows_of(spelling.variants(df))
    assert got[hub][1] == len([w for w in words if one_edit(w, hub)]) > 1000
    assert all(v[2] == hub for w, v in got.items() if w != hub)
