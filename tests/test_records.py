from __future__ import annotations

import pytest

from shelfmark.operators import records as R


def frame(spark, lines):
    return spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n int, line string")


SUBJECTS = [
    '{"Code":"c0","Classification Name":"L","Definition":"D"}',
    '{"Code":"c1","Classification Name":"L"}',
    '{"Code":"c2","Classification Name":"L","Definition":null}',
    '{"Code":"c3","Classification Name":"L","Definition":""}',
    '{"Classification Name":"L"}',
    '{"Code":"c5","Classification Name":""}',
    '{"Code":"c6","Classification Name":" "}',
    '{"Code":0,"Classification Name":"L"}',
    '{"Code":false,"Classification Name":"L"}',
    '{"Code":[],"Classification Name":"L"}',
    '{"Code":"c0","Classification Name":"L","Definition":"D"}',
    '{"Code":7,"Classification Name":"L","Definition":"é"}',
]


def test_subject_texts(spark):
    got = R.subject_texts(R.parse_subjects(frame(spark, SUBJECTS))).orderBy("n").collect()
    assert [(r.n, r.id, r.text) for r in got] == [
        (0, "c0", "L. D"), (1, "c1", "L"), (2, "c2", "L"), (3, "c3", "L"), (6, "c6", " "),
        (10, "c0", "L. D"), (11, "7", "L. é"),
    ]


def test_malformed_subject_fails_or_is_skipped(spark):
    parsed = R.parse_subjects(frame(spark, SUBJECTS + ['{"Code":"x" ', "[1]", '{"Code":["x"],"Classification Name":"L"}']))
    with pytest.raises(Exception, match="rejected line"):
        R.subject_texts(parsed).collect()
    assert R.subject_texts(parsed, mode=R.SKIP).count() == 7
    assert [(r.n, r.reason) for r in R.rejected(parsed).orderBy("n").collect()] == [
        (12, "bad_json"), (13, "not_object"), (14, "bad_field")
    ]
    with pytest.raises(ValueError):
        R.usable(parsed, "other")


PAPERS = [
    ('{"paper_id":"p","content":{"text":"t","title_en":"e"}}', "t"),
    ('{"paper_id":"p","content":{"title_en":"e"}}', "e"),
    ('{"paper_id":"p","content":{"text":"","title_en":"e"}}', "e"),
    ('{"paper_id":"p","content":{"text":null,"title_en":"e"}}', "e"),
    ('{"paper_id":"p","content":{"text":0,"title_en":"e"}}', "e"),
    ('{"paper_id":"p","content":{"text":" ","title_en":"e"}}', " "),
    ('{"paper_id":"p","content":{"text":"a","text":"b"}}', "b"),
    ('{"paper_id":"p","content":{"text":"q"},"content":{"title_en":"w"}}', "w"),
    ('{"paper_id":"p","content":{}}', None),
    ('{"paper_id":"p"}', None),
    ('{"content":{"text":"t"}}', None),
    ('{"paper_id":"","content":{"text":"t"}}', None),
    ('{"paper_id":"p","content":null}', "bad_content"),
    ('{"paper_id":"p","content":"s"}', "bad_content"),
    ('{"paper_id":"p","content":[]}', "bad_content"),
    ('{"paper_id":"p","content":{"text":["t"]}}', "bad_field"),
    ('{"paper_id":"p","content":{"text":"t","title_en":["e"]}}', "t"),
    ('{"paper_id":"p","content":{"text":"t"}} x', "bad_json"),
    ("5", "not_object"),
    ("null", "not_object"),
]


def test_papers(spark):
    parsed = R.parse_papers(frame(spark, [line for line, _ in PAPERS]))
    texts = {r.n: r.text for r in R.paper_texts(parsed).collect()}
    reasons = {r.n: r.reason for r in R.rejected(parsed).collect()}
    short = {r.n for r in R.incomplete(parsed).collect()}
    for n, (line, want) in enumerate(PAPERS):
        if want is None:
            assert n in short, line
        elif want.startswith(("bad_", "not_")):
            assert reasons[n] == want, line
        else:
            assert texts[n] == want, line
    assert len(texts) + len(reasons) + len(short) == len(PAPERS)


def test_failfast_papers(spark):
    parsed = R.parse_papers(frame(spark, [PAPERS[0][0], "oops"]))
    with pytest.raises(Exception, match="bad_json"):
        R.paper_texts(parsed, R.FAILFAST).collect()


def test_no_python_in_record_plans(spark):
    from conftest import plan_of

    parsed = R.parse_papers(frame(spark, [PAPERS[0][0]]))
    assert "Python" not in plan_of(R.paper_texts(parsed))
    assert plan_of(R.paper_texts(parsed)).count("from_json(ArrayType(StructType") == 1
