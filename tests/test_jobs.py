"""From raw files to similar rows, through the jobs and the command line."""

from __future__ import annotations

import json
from pathlib import Path

import pytest

from shelfmark.__main__ import encoder, main
from shelfmark.operators.encode import hashed_words
from shelfmark.plans import jobs
from shelfmark.session import shared_dir
from shelfmark.sources.tables import read_embeddings


@pytest.fixture
def collection(tmp_path):
    for split, name, start in (("train", "Book_de", 0), ("train", "Article_en", 10), ("test", "Book_en", 20)):
        path = tmp_path / "in" / split / f"{name}.jsonl"
        path.parent.mkdir(parents=True, exist_ok=True)
        lines = [
            json.dumps({"paper_id": f"p{i}", "content": {"text": f"alpha w{i % 4}" if i % 5 else ""}})
            for i in range(start, start + 8)
        ]
        path.write_text("\n".join([*lines, "broken", ""]))
    return tmp_path


def test_papers_end_to_end(spark, collection):
    merged, out = str(collection / "merged"), str(collection / "emb")
    counts = jobs.merge_collection(spark, str(collection / "in"), merged)
    assert {r.split: r.n_records for r in counts.collect()} == {"train": 16, "test": 8}
    table = jobs.embed_papers(spark, merged, out, hashed_words(32))
    got = {}
    for r in table.collect():
        got.setdefault(r.split, []).append((r.row_id, r.id))
    kept = [f"p{i}" for i in [*range(10, 18), *range(8)] if i % 5]  # articles come first
    assert [i for _, i in sorted(got["train"])] == kept
    assert [n for n, _ in sorted(got["train"])] == list(range(len(kept)))
    hits = jobs.similar_to(table.where("split = 'train'"), 0, 4).collect()
    assert [r["rank"] for r in hits] == [1, 2, 3, 4] and hits[0].id == kept[0]
    assert {r.text for r in hits[:3]} == {hits[0].text} and hits[0].sim == pytest.approx(1.0)


def test_scratch_tables_are_gone_after_a_job(spark, collection):
    before = set(Path(shared_dir(spark)).iterdir())
    jobs.merge_collection(spark, str(collection / "in"), str(collection / "m"))
    jobs.embed_papers(spark, str(collection / "m"), str(collection / "e"), hashed_words(8))
    assert set(Path(shared_dir(spark)).iterdir()) == before


def test_subjects_by_command_line(spark, collection, capsys):
    lines = [json.dumps({"Code": f"c{i}", "Classification Name": f"alpha w{i % 4}", "Definition": None}) for i in range(9)]
    path, out = collection / "subjects.jsonl", str(collection / "subjects")
    path.write_text("\n".join(lines))
    main(["embed-subjects", str(path), out, "--encoder", "hashed:32"])
    assert "|     9| 32|" in capsys.readouterr().out
    table = read_embeddings(spark, out)
    assert [r.id for r in table.orderBy("row_id").collect()] == [f"c{i}" for i in range(9)]
    main(["similar", out, "--row", "1", "-k", "3"])
    shown = capsys.readouterr().out
    assert "c1" in shown and "c5" in shown and "c2" not in shown
    path.write_text("\n".join([*lines, "{"]))
    with pytest.raises(Exception, match="rejected line"):
        main(["embed-subjects", str(path), out])


def test_suggestions_and_other_commands(spark, collection, capsys):
    merged, emb = str(collection / "m"), str(collection / "e")
    main(["merge", str(collection / "in"), merged, "--splits", "train", "--lines-out", str(collection / "t")])
    assert "train" in capsys.readouterr().out
    main(["embed-papers", merged, emb, "--encoder", "hashed:16"])
    papers = read_embeddings(spark, emb, by="split")
    got = jobs.suggest_subjects(papers, papers, 1).collect()
    assert len(got) == papers.count() and all(r.sim == pytest.approx(1.0) for r in got)
    assert encoder("shelfmark.operators.encode:hashed_words") is hashed_words
