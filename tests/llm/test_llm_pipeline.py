"""The pipeline, stage by stage, against plain versions, and the registered queries."""

from __future__ import annotations

import importlib.util
from pathlib import Path

import duckdb
import pytest
import sentencepiece
from test_llm_exact import groups, removed

import corpus_pipeline
from shelfmark.llm import decontaminate, extract, licenses, pieces, toxicity
from shelfmark.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = texts_of(docs)
        stage(spark, docs, DATA).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if n < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        after = texts_of(docs)
        order = sorted(before)
        if name == "toxicity":
            labels = spark.read.parquet(f"{DATA}/labels.parquet")
            told = toxicity.digest(spark.read.parquet(f"{DATA}/documents.parquet"), labels)
            want = {r.doc_id: before[r.doc_id] for r in told.collect() if not r.predicted}
        elif name == "near_duplicates":
            root, _ = groups([before[i] for i in order], 5, 80)
            want = {order[k]: before[order[k]] for k in range(len(order)) if root[k] == k}
        elif name == "suffix_dedup":
            digests = removed([before[i] for i in order], 200)
            assert set(after) == set(before)
            assert [len(before[i].encode()) - d[1] - len(after[i].encode()) for i, d in zip(order, digests, strict=True)] == pytest.approx(
                [0] * len(order), abs=3
            )  # whole characters stay
            assert all(r.n_chars == len(r.text) for r in docs.collect())
            continue
        elif name == "decontamination":
            windows = {w for _, text in bench for w in decontaminate.windows(text.encode(), 13)}
            want = {}
            for i in order:
                own = decontaminate.words(before[i].encode())
                hit = {p for k in range(len(own)) if b" ".join(own[k : k + 13]) in windows for p in range(k, min(k + 13, len(own)))}
                if not hit or 20 * len(hit) < len(own):
                    want[i] = before[i]
        else:
            library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
            for r in docs.collect():
                assert r.ids == library.encode(r.text) and r.round_trip
            want = before
        assert after == want


def test_pipeline_on_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_with_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    result = con.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    want = sorted(result.fetchall(), key=str)
    assert sorted((tuple(r[c] for c in columns) for r in QUERIES[name](spark, DATA).collect()), key=str) == want


def test_page_and_license_queries(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    for r in QUERIES["op2_html_extraction"](spark, DATA).collect():
        assert (r.url, r.text) == (pages[r.page_id].url, " ".join(extract.content(pages[r.page_id].html))) and r.n_chars == len(r.text)
    docs = texts_of(spark.read.parquet(f"{DATA}/documents.parquet"))
    notices = {w.rstrip("."): name for name, w in licenses.WORDINGS}
    for r in QUERIES["op5_license_scan"](spark, DATA).collect():
        lines = [notices[line.rstrip(".")] for line in docs[r.doc_id].split("\n") if line.rstrip(".") in notices]
        assert [f.license for f in r.findings] == lines and r.n_exact == len(lines)


def test_entry_registers_them(spark):
    spec = importlib.util.spec_from_file_location("spark_entry_llm", Path(__file__).resolve().parents[2] / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert {*QUERIES, "pipeline"} <= set(module.queries()) and set(ORACLE) <= set(module.oracle_sql())
    assert len([k for k in module.queries() if k.startswith("op")]) == 13
