"""Language profiles against a plain version, and on held-out rows."""

from __future__ import annotations

import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from helpers import edge_docs
from pyspark.sql import functions as F

from shelfmark.llm import language
from shelfmark.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def plain_vector(text, dimensions, cache={}):  # noqa: B006
    def of(c):
        if (c, dimensions) not in cache:
            bits = np.random.Generator(np.random.Philox(key=(ord(c) if c else 0) + 1)).integers(0, 2, dimensions, np.int8)
            cache[c, dimensions] = 2.0 * bits - 1
        return cache[c, dimensions]

    letters = [""]
    for c in text or "":
        small = c.lower() if len(c.lower()) == 1 else c
        if c.isalpha() or letters[-1]:
            letters.append(small if c.isalpha() else "")
    letters += [""] if letters[-1] else []
    out = np.zeros(dimensions)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        out += np.roll(of(a), 2) * np.roll(of(b), 1) * of(c)
    return out


def samples(n=160):
    rng = random.Random(2)
    kinds = {"xx": "abcde ", "yy": "abçéè ", "zz": "人口年大 ", None: "qrst "}
    return [(i, "".join(rng.choice(kinds[lang]) for _ in range(rng.randrange(1, 60))), lang) for i in range(n) for lang in [rng.choice([*kinds])]]


def test_vectors_of_texts(monkeypatch):
    texts = ["", "12 3", "Ab", "ÀÉ.İß 人\U0001f600x", *[t for _, t, _ in samples(40)], "a" * 300]
    want = np.array([plain_vector(t, 64) for t in texts])
    own = language.Space(64)
    assert (own.of_texts([t.encode() for t in texts]) == want).all()
    monkeypatch.setattr(language, "STRETCH", 5)
    monkeypatch.setattr(language, "KEPT_GRAMS", 20)
    assert (language.Space(64).of_texts([t.encode() for t in texts]) == want).all()


def test_predictions(spark):
    rows = samples()
    learn = [zlib.crc32(str(i).encode()) % 4 != 2 for i, _, _ in rows]
    names = sorted({lang for (_, _, lang), ok in zip(rows, learn) if ok and lang})
    units = [v / max(np.linalg.norm(v), 1e-300) for v in (plain_vector(t, language.DIMENSIONS) for _, t, _ in rows)]
    sums = [sum(u for u, (_, _, lang), ok in zip(units, rows, learn) if ok and lang == name) for name in names]
    profiles = np.array([s / np.linalg.norm(s) for s in sums])
    mean = profiles.mean(axis=0)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: r for r in language.digest(df).collect()}
    for (i, text, _), u, ok in zip(rows, units, learn):
        assert got[i].held_out is not ok
        if not any(c.isalpha() for c in text):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        cosines = [(u - mean) @ (p - mean) / np.linalg.norm(u - mean) / np.linalg.norm(p - mean) for p in profiles]
        assert got[i].lang_pred == names[int(np.argmax(np.round(cosines, 9)))]
        assert got[i].score == pytest.approx(np.clip(max(cosines), 0, 1), abs=1e-6)


def test_labels_of_held_out_rows_teach_nothing(spark):
    rows = samples()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    turned = df.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(language.digest(df).collect()) == sorted(language.digest(turned).collect())


@pytest.mark.parametrize("rows", [None, []], ids=["rows", "empty"])
def test_edges(spark, rows):
    docs = edge_docs(spark, rows)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in language.digest(docs).collect())  # no language given
    one = language.train(docs.withColumn("lang", F.lit("de")))
    out = language.with_language(docs, one)
    assert [c for c in out.columns if c != "lang_pred"] == [*[c for c in docs.columns if c != "score"], "score"] or set(out.columns) == {*docs.columns, "lang_pred"}
    for r in out.collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert r.lang_pred == ("de" if letters else "und") and 0 <= r.score <= 1


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
def test_held_out_rows(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in QUERIES["op13_language_id"](spark, DATA).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.99 * len(rows) and len(rows) > 200
