"""Miniature documents, one for each shape a field can take."""

from __future__ import annotations

import json

import pytest

from shelfmark.operators import audit, graph
from shelfmark.plans.jobs import flatten_documents
from shelfmark.sources.jsonld import read_documents

CONTEXT = {"creator": "http://purl.org/dc/elements/1.1/creator", "s": "http://subjects/", "title": "http://t"}
REF_CONTEXT = {**CONTEXT, "creator": {"@id": "http://purl.org/dc/terms/creator", "@type": "@id"}}


def document(number, nodes, context=CONTEXT, **record):
    base = {"@id": f"https://example.org/id/LIB%3A{number}", "@type": "bibo:Book"}
    return {"@graph": [*nodes, {**base, **record}], "@id": "urn:x", "@context": context}


def entity(i, *labels):
    return {"@id": f"s:{i}", "sameAs": labels[0] if len(labels) == 1 else list(labels)}


DOCS = {
    "train/Book/de/1": document(
        1, [entity(1, "Eins"), entity(2, "Zwei", "Deux")], title="T", abstract="A", issued="1999",
        language="http://lang/de", creator="Müller, A", identifier=["(ppn)1", "(isbn)x"],
        subject="(classificationName=rvk)LH 1", **{"dcterms:subject": [{"@id": "s:1"}, {"@id": "s:2"}]},
    ),
    "train/Book/en/2": document(
        2, [entity(1, "Eins"), entity(9, "Person")], REF_CONTEXT, title=["T", "U"], abstract=["A", "B"],
        language="http://lang/en", creator=["s:9", "s:8"], contributor=["Lib", {"@id": "s:9"}],
        subject=["free", "(classificationName=bk, id=7)20.1"], issued="n.d.",
        **{"dcterms:subject": [{"@id": "s:1"}], "dcterms:creator": {"@id": "s:9"},
           "http://purl.org/dc/elements/1.1/creator": "Full, F"},
    ),
    "dev/Book/en/3": document(
        3, [entity(1, "Uno"), entity(3, "Drei")], title="T", abstract="A",
        **{"dcterms:subject": [{"@id": "s:3"}, {"@id": "s:1"}], "dcterms:creator": [{"@id": "s:4"}]},
    ),
}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("ld")
    for name, doc in DOCS.items():
        path = base / f"{name}.jsonld"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(doc, indent=2))
    (base / "dev/Book/en/bad.jsonld").write_text('{"@graph": [')
    (base / "dev/Book/en/none.jsonld").write_text("{}")
    return str(base)


@pytest.fixture(scope="module")
def parsed(spark, root):
    return graph.parse_documents(read_documents(spark, root))


@pytest.fixture(scope="module")
def recs(parsed):
    return graph.records(graph.nodes(parsed))


def test_nodes(parsed, recs):
    assert graph.nodes(parsed).count() == 9 and recs.count() == 3
    assert sorted(r.file.rsplit("/", 1)[1] for r in graph.unreadable(parsed).collect()) == ["bad.jsonld", "none.jsonld"]
    got = {(r.paper_id, r.split, r.doc_type, r.dir_lang, r.position) for r in recs.collect()}
    assert got == {("1", "train", "Book", "de", 2), ("2", "train", "Book", "en", 2), ("3", "dev", "Book", "en", 2)}


def test_papers(recs):
    got = {r.paper_id: r for r in graph.papers(recs).collect()}
    assert (got["1"].text, got["1"].title_en, got["1"].issued_year, got["1"].lang_tag) == ("T. A", None, 1999, "de")
    assert (got["2"].text, got["2"].title_en, got["2"].issued_year, got["2"].issued) == ("T U. A B", "T U", None, "n.d.")
    assert (got["3"].lang_tag, got["3"].issued, got["3"].record_type) == (None, None, "Book")


def test_agents(recs):
    got = {tuple(r) for r in graph.agents(recs).collect()}
    assert got == {
        ("1", "creator", "literal", "Müller, A", None),
        ("2", "creator", "reference", "s:9", "http://subjects/9"),
        ("2", "creator", "reference", "s:8", "http://subjects/8"),
        ("2", "creator", "literal", "Full, F", None),
        ("2", "contributor", "literal", "Lib", None),
        ("2", "contributor", "reference", "s:9", "http://subjects/9"),
        ("3", "creator", "reference", "s:4", "http://subjects/4"),
    }
    # The dcterms spelling of document 2 names s:9 again; duplicates are kept.
    assert graph.agents(recs).count() == 8


def test_identifiers_and_classifications(recs):
    assert {tuple(r) for r in graph.identifiers(recs).collect()} == {("1", "ppn", "1"), ("1", "isbn", "x")}
    assert {tuple(r) for r in graph.classifications(recs).collect()} == {
        ("1", "rvk", None, "LH 1"), ("2", None, None, "free"), ("2", "bk", "7", "20.1")
    }


def test_links_and_labels(parsed, recs):
    counts = graph.label_counts(graph.entities(graph.nodes(parsed)))
    assert {tuple(r) for r in counts.collect()} == {
        ("s:1", "Eins", 2), ("s:1", "Uno", 1), ("s:2", "Zwei", 1), ("s:2", "Deux", 1), ("s:3", "Drei", 1), ("s:9", "Person", 1)
    }
    labels = graph.canonical_labels(counts)
    assert dict(map(tuple, labels.collect())) == {"s:1": "Eins", "s:2": "Deux", "s:3": "Drei", "s:9": "Person"}
    links = graph.edges(recs)
    assert links.count() == 5
    assert graph.with_labels(links, labels).count() == graph.with_labels(links, labels, "inner").count() == 5
    assert {r.code for r in graph.subjects(labels, links).collect()} == {"s:1", "s:2", "s:3"}


def test_audits(recs):
    assert [tuple(r) for r in audit.unseen_subjects(graph.edges(recs), "dev", "train").collect()] == [("s:3", 1)]
    shared = audit.shared_texts(graph.papers(recs), "title", "abstract").collect()
    assert [(r.n_docs, r.n_splits) for r in shared] == [(2, 2)]


def test_flatten_writes_every_table(spark, root, tmp_path):
    out = str(tmp_path / "tables")
    flatten_documents(spark, root, out)
    sizes = {
        "nodes": 9, "papers": 3, "identifiers": 2, "classifications": 3, "agents": 8, "links": 5,
        "label_counts": 6, "labels": 4, "subjects": 3, "unreadable": 2,
    }
    assert {n: spark.read.parquet(f"{out}/{n}").count() for n in sizes} == sizes


def test_a_repeated_key_keeps_its_document(spark):
    text = '{"@graph":[{"@id":"s:1","sameAs":"A","sameAs":"B"},{"@id":"x%3A1","@type":"bibo:Book","title":"T"}],"@context":{}}'
    spark.conf.unset("spark.sql.variant.allowDuplicateKeys")
    docs = spark.createDataFrame([("f", text)], "file string, value string")
    nodes = graph.nodes(graph.parse_documents(docs))
    assert nodes.count() == 2 and [r.label for r in graph.entities(nodes).collect()] == ["B"]


def test_from_documents_to_suggestions(spark, root, tmp_path):
    from shelfmark.operators.encode import hashed_words
    from shelfmark.plans import jobs

    flat, embedded = str(tmp_path / "flat"), str(tmp_path / "embedded")
    flatten_documents(spark, root, flat)
    translations = spark.createDataFrame([("1", "unused"), ("7", "unknown")], "paper_id string, title_en string")
    papers, subjects = jobs.embed_flattened(spark, flat, embedded, hashed_words(16), translations)
    assert {(r.split, r.row_id, r.id) for r in papers.collect()} == {("train", 0, "1"), ("train", 1, "2"), ("dev", 0, "3")}
    assert sorted(r.text for r in subjects.collect()) == ["Drei", "Eins", "Zwei"] or subjects.count() == 3
    got = jobs.write_suggestions(spark, embedded, str(tmp_path / "s"), 2).collect()
    assert {(r.split, r.query_id, r["rank"]) for r in got} == {(s, q, k) for s, q in (("train", 0), ("train", 1), ("dev", 0)) for k in (1, 2)}
