from __future__ import annotations

import json
from pathlib import Path

import pytest

from shelfmark.operators import merge as M
from shelfmark.operators.numbering import number_lines
from shelfmark.plans.jobs import merge_collection
from shelfmark.sources import jsonl, tables


@pytest.fixture
def root(tmp_path):
    files = {
        "train/Book_en.jsonl": '{"n": 3}\n{"n": 4}\n',
        "train/Book_de.jsonl": '\n \t\u00a0\n{"n": 1}\r\n{"n": 2, "s": "a\u2028b"}\n{"n": 1}\n',
        "train/Article_en.jsonl": '{"n": 0} x\n{\'n\': 0}\n{"n":0,"é":"\\u00e9","n":0}\n',
        "train/Thesis_de.jsonl": '[1]\n5\nnull\n"x"\n{"n":NaN}\n  {"n": 9}  ',
        "train/Report_de.jsonl": "",
        "train/Novel_de.jsonl": '{"n": "not a known type"}\n',
        "test/Thesis_en.jsonl": '{"n": 1}\n',
        "train_all.jsonl": '{"n": "an old output"}\n',
        # Not of the form split/type_lang.jsonl, although their names are.
        "Book_en.jsonl": '{"n": "at the root"}\n',
        "old/train/Book_de.jsonl": '{"n": "nested"}\n',
    }
    for name, text in files.items():
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode())
    return str(tmp_path / "in")


TRAIN = [
    '{"n": 0, "é": "é"}', '{"n": 1}', '{"n": 2, "s": "a\u2028b"}', '{"n": 1}', '{"n": 3}', '{"n": 4}',
    "[1]", "5", "null", '"x"', '{"n": NaN}', '{"n": 9}',
]


def ordered_text(path: str, split: str) -> list[str]:
    parts = sorted(Path(path, f"split={split}").glob("part-*"))
    return [x for p in parts for x in p.read_text(encoding="utf-8").split("\n") if x]


def test_merge_order_and_counts(spark, root, tmp_path):
    out, text = str(tmp_path / "out"), str(tmp_path / "text")
    counts = {r.split: r.n_records for r in merge_collection(spark, root, out, lines_out=text).collect()}
    assert counts == {"train": len(TRAIN), "test": 1}
    assert ordered_text(text, "train") == TRAIN
    stored = spark.read.parquet(out).where("split = 'train'").orderBy(*tables.MERGE_KEY)
    # The table keeps lines as they were written; text is re-serialised.
    assert [json.dumps(json.loads(r.json), ensure_ascii=False) for r in stored.collect()] == TRAIN
    # A second run replaces the first.
    merge_collection(spark, root, out, splits=["test"], lines_out=text)
    assert not Path(text, "split=train").exists() and ordered_text(text, "test") == ['{"n": 1}']
    kept = spark.read.parquet(out).collect()
    assert [(r.split, r.doc_type, r.lang) for r in kept] == [("test", "Thesis", "en")]


def test_numbering_of_a_merged_table_needs_no_shuffle(spark, tmp_path):
    folder = tmp_path / "big" / "train"
    folder.mkdir(parents=True)
    names = ["Thesis_de", "Book_en", "Article_en", "Book_de"]
    for name in names:
        lines = [json.dumps({"f": name, "n": i, "pad": "x" * 40}) for i in range(2000)]
        (folder / f"{name}.jsonl").write_text("\n".join(lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "15000")
    try:
        merge_collection(spark, str(tmp_path / "big"), str(tmp_path / "t"))
        lines = tables.read_merged_table(spark, str(tmp_path / "t"))
        order = [c for c in tables.MERGE_KEY if c not in ("split", "line_no")]
        got = number_lines(lines.where("line not like '%7,%'"), order, by="split").orderBy("row_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = [(f, i) for f in ("Article_en", "Book_de", "Book_en", "Thesis_de") for i in range(2000) if i % 10 != 7]
    assert [(r.line.split('"')[3], int(r.line.split('"n": ')[1].split(",")[0])) for r in got] == want
    assert [r.row_id for r in got] == list(range(len(want)))


def test_many_ranges_keep_the_order(spark, root, tmp_path):
    merged = M.merge(jsonl.read_collection(spark, root)).repartition(7)
    tables.write_merged_lines(merged, str(tmp_path / "o"), partitions=5)
    assert ordered_text(str(tmp_path / "o"), "train") == TRAIN


def test_line_order_over_split_files(spark, tmp_path):
    folder = tmp_path / "big" / "train"
    folder.mkdir(parents=True)
    lines = [json.dumps({"n": i, "pad": "x" * 50}) for i in range(5000)]
    (folder / "Book_de.jsonl").write_text("\n".join(lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = jsonl.read_collection(spark, str(tmp_path / "big"))
        assert df.rdd.getNumPartitions() > 4
        got = [json.loads(r.line)["n"] for r in df.orderBy(*tables.MERGE_KEY).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(range(5000))


def test_malformed_and_totals(spark, root):
    lines = jsonl.read_collection(spark, root)
    bad = M.malformed(lines)
    assert sorted(r.line for r in bad.collect()) == sorted(['{"n": 0} x', "{'n': 0}"])
    assert M.count_by(bad, "file").first().n_records == 2
    assert M.merge(lines).count() + bad.count() == lines.count() == len(TRAIN) + 3


def test_long_numbers_and_deep_nesting(spark):
    """Kept and skipped lines make up all lines; the readers agree with both."""
    from shelfmark.operators.records import parse_papers

    lines = [
        '{"paper_id":"a","content":{"text":"t"},"n":%s}' % ("9" * 1500),
        '{"paper_id":"b","content":{"text":"t"},"n":%s}' % ("9" * 5000),
        '{"paper_id":"c","n":%s}' % ("[" * 1500 + "]" * 1500),
        '{"paper_id":"d","n":%s}' % ("[" * 200_000 + "]" * 200_000),
        '{"paper_id":"e"', "[1] 2",
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    kept = {r.i for r in M.merge(df).collect()}
    skipped = {r.i: r.reason for r in M.malformed(df).collect()}
    assert kept == {0, 1, 2} and skipped == {3: "too_deep", 4: "bad_json", 5: "bad_json"}
    reasons = {r.i: r.reason for r in parse_papers(df).collect()}
    assert reasons == {0: None, 1: None, 2: "too_deep", 3: "too_deep", 4: "bad_json", 5: "bad_json"}


def test_splits_are_names_and_prune_the_listing(spark, tmp_path):
    for split in ("01", "1", "2"):
        path = tmp_path / "in" / split / "Book_de.jsonl"
        path.parent.mkdir(parents=True)
        path.write_text('{"n": "%s"}' % split)
    some = jsonl.read_collection(spark, str(tmp_path / "in"), splits=["01", "3"])
    assert [r.split for r in some.collect()] == ["01"] and len(some.inputFiles()) == 1
    counts = merge_collection(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert {r.split: r.n_records for r in counts.collect()} == {"01": 1, "1": 1, "2": 1}
    assert {r.split for r in tables.read_merged_table(spark, str(tmp_path / "out")).collect()} == {"01", "1", "2"}


def test_missing_inputs(spark, root):
    missing = {tuple(r) for r in jsonl.missing_inputs(spark, root, ["train", "test"]).collect()}
    present = {("train", "Book", "en"), ("train", "Book", "de"), ("train", "Article", "en"),
               ("train", "Thesis", "de"), ("train", "Report", "de"), ("test", "Thesis", "en")}
    assert len(missing) == 20 - len(present) and not missing & present


def test_nothing_found_is_not_an_error(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert jsonl.read_collection(spark, str(tmp_path / "empty")).count() == 0
    assert jsonl.missing_inputs(spark, str(tmp_path / "empty"), ["train"]).count() == 10


def test_one_evaluation_and_no_shuffle(spark, root):
    from conftest import plan_of

    plan = plan_of(M.merge(jsonl.read_collection(spark, root)))
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
