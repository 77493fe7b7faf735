"""Nulls, empty and long texts, repeats, clashing names and empty tables."""

from __future__ import annotations

import pytest
from helpers import CLASHES, EDGES, LONG, edge_docs
from pyspark.sql import functions as F

from shelfmark.llm import classlm, decontaminate, extract, fingerprint, licenses, neardup, pieces, suffixdedup, tokencount, toxicity

ITEMS = [(1, None), (2, ""), (3, "short text"), (3, "short text"), (None, "one short text"), (4, "a b c d e f g h i j k l m n")]


def bench(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string, extra string" if rows and len(rows[0]) > 2 else "item_id long, text string")


@pytest.fixture(scope="module", params=["rows", "empty"])
def docs(request, spark):
    return edge_docs(spark, None if request.param == "rows" else [])


def names(df):
    return sorted(c.lower() for c in df.columns)


def test_overlaps(spark, docs):
    out = decontaminate.find_overlaps(docs, bench(spark))
    assert names(out) == names(docs)  # all four outputs take the place of columns
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        if not (r.text or "").strip():
            assert (r.n_words, r.n_hit, r["items"], r.spans) == (0, 0, [], [])
        if r.text == "One short text.":
            assert (r.n_words, r.n_hit, r["items"]) == (3, 3, ["", "3"])
            assert [r.text[s.start : s.end] for s in r.spans] == ["One short text"]
    nothing = decontaminate.find_overlaps(docs, bench(spark, []))
    assert all(r.n_hit == 0 for r in nothing.collect())


def test_scores_without_and_with_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int, extra string")
    out = toxicity.with_toxicity(docs, none)
    assert names(out) == names(docs)
    assert all(r.score == pytest.approx(0.5) for r in out.collect())
    one = spark.createDataFrame([(4, 1), (4, 0), (2, None), (None, 1), (6, 1)], "doc_id long, toxic int")
    assert all(0 <= r.score <= 1 for r in toxicity.with_toxicity(docs, one, held_out=(3, 99)).collect())


def test_ids(docs):
    out = pieces.with_ids(docs, check=True)
    assert set(names(out)) == {*names(docs), "decoded_sha256", "round_trip"}
    for r in out.collect():
        assert r.round_trip and (len(r.ids) > 0) == bool(r.text)
    back = pieces.with_text(out)
    assert all((r.decoded or "") == (r.text or "") for r in back.collect())


def test_token_counts(docs):
    out = tokencount.with_token_counts(docs)
    assert names(out) == names(docs)
    assert all((r.n_tokens > 0) == bool(r.text) for r in out.collect())


def test_licenses(docs):
    assert all(r.licenses == [] for r in licenses.with_licenses(docs).collect())


def test_fingerprints(docs):
    out = fingerprint.with_fingerprint(docs)
    assert names(out) == names(docs)
    seen = {}
    for r in out.collect():
        assert (len(r.fingerprint) == 256) == bool((r.text or "").strip())
        assert seen.setdefault(r.text, r.fingerprint) == r.fingerprint
    assert fingerprint.digest(docs).count() == docs.count()


def test_removal(docs):
    out = suffixdedup.without_repeats(docs)
    assert set(names(out)) == {*names(docs), "n_removed", "n_spans", "kept_sha256", "kept_text"}
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.text == LONG:  # it repeats itself
            assert r.n_removed == r.n_bytes == len(LONG.encode())
        else:
            assert r.n_removed == 0 and bytes(r.kept).decode() == r.kept_text == (r.text or "")


def test_groups(docs):
    rows = neardup.near_groups(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.component_id == r.doc or r.doc == 4
        assert (r.n_shingles == 0) == (r.doc in (1, 2, 3))
    stay = neardup.one_of_each(docs)
    assert stay.columns == docs.columns
    if rows:
        # Of the two equal rows one stays; the other text under that key stays too.
        assert sorted((r.doc_id or 0, r.text) for r in stay.where("text is not null").collect()) == sorted(
            {(k or 0, t) for k, t in EDGES if t is not None}
        )


def test_rows_without_words_all_stay(spark):
    rows = [(1, ""), (1, ""), (1, None), (None, " \t"), (None, " \t"), (None, None), (None, None), (2, "a text here"), (2, "a text here")]
    out = neardup.one_of_each(edge_docs(spark, rows)).select("doc_id", "text").collect()
    assert sorted(map(str, out)) == sorted(str(r) for r in edge_docs(spark, rows[:-1]).select("doc_id", "text").collect())


def test_class_scores(docs):
    held = docs.withColumn("train", F.col("doc_id").isNotNull())
    rows = classlm.with_scores(held, "train", keep=("doc_id", "lang")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.n_tokens >= 1 and r.n_known <= r.n_tokens and r.score < 0 and r.base_score < 0
    untrained = classlm.with_scores(docs.withColumn("train", F.lit(None).cast("boolean")), "train").collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in untrained)


def test_main_text(spark):
    rows = [(1, None), (2, ""), (3, "<"), (4, "<p>" * 2000 + "Deep text here."), (4, "<article><p>A &amp; B</article>"), (4, "<article><p>A &amp; B</article>")]
    schema = "page_id long, html string, n_blocks string, text string, url string"
    pages = spark.createDataFrame([(k, h, None, None, None) for k, h in rows], schema)
    out = extract.with_main_text(pages)
    assert names(out) == names(pages)
    got = [(r.page_id, r.text) for r in out.collect()]
    assert got[0] == (1, "") and got[1] == (2, "") and got[4] == got[5] == (4, "A & B")
    assert extract.with_main_text(pages.limit(0)).count() == 0


def test_clashes_are_part_of_the_input(spark):
    assert set(CLASHES) <= set(edge_docs(spark).columns)
