"""Counts taken by the writing job, tables that are replaced as a whole, documents in files."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from shelfmark.operators import merge as M
from shelfmark.plans import jobs
from shelfmark.session import swap_in
from shelfmark.sources import jsonld, tables


@pytest.fixture
def root(tmp_path):
    for split, name, good, bad in (("train", "Book_de", 5, 2), ("train", "Article_en", 3, 0), ("dev", "Book_en", 4, 1), ("dev", "Thesis_de", 0, 0)):
        path = tmp_path / "in" / split / f"{name}.jsonl"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join([json.dumps({"n": i}) for i in range(good)] + ["{"] * bad + ["", "[" * 200_000 if name == "Book_de" else ""]))
    return str(tmp_path / "in")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_report_of_the_merging_job(spark, root, tmp_path):
    told = jobs.merge_with_report(spark, root, str(tmp_path / "out"))
    assert rows(told.records) == [("dev", 4), ("train", 8)]
    assert rows(told.skipped) == [("dev", "Book", "en", "bad_json", 1), ("train", "Book", "de", "bad_json", 2), ("train", "Book", "de", "too_deep", 1)]
    assert ("dev", "Thesis", "de") not in rows(told.missing) and ("dev", "Article", "de") in rows(told.missing)
    again, missing = jobs.merge_report(spark, root)
    assert sum(r.n_skipped for r in again.collect()) == 4
    assert {r for r in rows(told.missing)} == {r for r in rows(missing)}


def test_the_lines_are_read_once(spark, root, tmp_path):
    """The counts need no job beyond the one that writes."""
    tracker, group = spark.sparkContext.statusTracker(), "merge-report"
    spark.sparkContext.setJobGroup(group, group)
    try:
        told = jobs.merge_with_report(spark, root, str(tmp_path / "out"))
        with_tally = len(tracker.getJobIdsForGroup(group))
        told.records.collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    spark.sparkContext.setJobGroup("plain", "plain")
    try:
        tables.write_merged_table(M.merge(jobs.read_collection(spark, root, splits=["dev", "train"])), str(tmp_path / "plain"))
        jobs.missing_inputs(spark, root, ["dev", "train"])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert with_tally == len(tracker.getJobIdsForGroup("plain")) >= 1
    assert "jsonl" not in plan_of(told.records) and "Scan text" not in plan_of(told.skipped)


def test_tally_of_many_cells_and_partitions(spark):
    values = [(["a", "b", "c", "x"][i % 4], ["t", "u"][i % 2], ["de", "en", None][i % 3], '{"a": 1}' if i % 5 else "{") for i in range(4000)]
    df = spark.createDataFrame(values, "split string, doc_type string, lang string, line string").repartition(37)
    tally = M.Tally(["a", "b", "c"], ["t"], ["de", "en"])
    M.merge_watched(df, tally).write.format("noop").mode("overwrite").save()
    want = {}
    for s, t, g, line in values:
        key = (s if s != "x" else None, t if t == "t" else None, g, "ok" if line != "{" else "bad_json")
        want[key] = want.get(key, 0) + 1
    assert {tuple(r)[:4]: r.n for r in tally.counts(spark).collect()} == want


def test_a_failed_job_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    swap_in(spark, path, spark.range(10).write.parquet)
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        swap_in(spark, path, broken.write.parquet)
    assert spark.read.parquet(path).count() == 10
    assert [p.name for p in tmp_path.iterdir()] == ["table"]
    swap_in(spark, path, spark.range(3).write.parquet)
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["table"]


def test_a_driver_lost_between_the_renames(spark, tmp_path):
    path = tmp_path / "table"
    swap_in(spark, str(path), spark.range(10).write.parquet)
    path.rename(tmp_path / "table.replaced")

    def fails(to):
        raise OSError("lost again")

    with pytest.raises(OSError, match="lost again"):
        swap_in(spark, str(path), fails)
    assert spark.read.parquet(str(path)).count() == 10


def test_embeddings_are_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "emb")
    good = spark.createDataFrame([(0, "a", [1.0])], "row_id long, id string, embedding array<float>")
    tables.write_embeddings(good, path)
    bad = good.withColumn("id", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        tables.write_embeddings(bad, path)
    assert tables.read_embeddings(spark, path).count() == 1


def test_document_tree(spark, tmp_path):
    docs = [(s, t, g, f"{s} {t} {g} {i}") for s in ("train", "dev", "a=b") for t in ("Book", "Thesis") for g in ("de", "en") for i in range(3)]
    path = str(tmp_path / "tree")
    jsonld.write_documents(spark.createDataFrame(docs, "split string, doc_type string, dir_lang string, value string").repartition(2), path)
    assert len(list(Path(path).rglob("*.txt"))) == len(docs)
    read = jsonld.read_documents(spark, path, "*.txt")
    assert sorted(r.value.strip() for r in read.collect()) == sorted(d[3] for d in docs)
    some = jsonld.read_documents(spark, path, "*.txt", splits=["dev"], langs=["de"])
    assert sorted((r.split, r.doc_type, r.dir_lang) for r in some.collect()) == sorted(("dev", t, "de") for t in ("Book", "Thesis") for _ in range(3))
    # Other folders are not even listed.
    assert all("split=dev" in f and "dir_lang=de" in f for f in some.inputFiles()) and len(some.inputFiles()) == 6


def test_files_of_one_partition_are_written_by_many_tasks(spark, tmp_path):
    docs = spark.createDataFrame([("train", "Book", "de", f"d{i}") for i in range(60)], "split string, doc_type string, dir_lang string, value string")
    for files, least in (({}, 4), ({"files_a_task": 6}, 10)):  # a task a core at least
        path = str(tmp_path / f"tree{least}")
        jsonld.write_documents(docs.coalesce(1), path, **files)
        names = [p.name for p in Path(path).rglob("part-*.txt")]
        assert len(names) == 60 and len({n.split("-")[1] for n in names}) == least
        assert sorted(r.value.strip() for r in jsonld.read_documents(spark, path, "*.txt").collect()) == sorted(f"d{i}" for i in range(60))
