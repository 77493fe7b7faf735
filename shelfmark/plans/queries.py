"""The registered queries: every operator over whole tables of one folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.functions import json as J
from shelfmark.functions import vectors as V
from shelfmark.functions.names import expand_iri
from shelfmark.functions.text import fixed4
from shelfmark.operators import audit, graph
from shelfmark.operators import merge as M
from shelfmark.operators import neighbours, pruned
from shelfmark.operators import records as R
from shelfmark.operators import similarity as S
from shelfmark.operators.encode import encode, hashed_words
from shelfmark.operators.numbering import number_rows
from shelfmark.operators.once import evaluate_once
from shelfmark.plans import inputs as I
from shelfmark.plans.jobs import suggest_subjects
from shelfmark.session import fresh_path, materialize, short_batches, spread
from shelfmark.sources import jsonl, jsonld, tables

DIM = 64


def _six(column: Column | str) -> Column:
    return F.round(column, 6)


# --- vectors ----------------------------------------------------------------


def topk_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = S.top_k(I.embeddings(spark, sf_dir), 0)
    return hits.select("query_id", "row_id", "rank", _six("sim").alias("sim"), fixed4(F.col("sim")).alias("sim_text"))


def similarity_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = I.embeddings(spark, sf_dir)
    sims = S.similarities(vectors, S.pick_vector(vectors, 0))
    return S.ranked(sims).select("row_id", _six("sim").alias("sim"))


def vector_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = V.as_float(F.col("embedding"))
    return I.embeddings(spark, sf_dir).select("row_id", _six(V.norm(e)).alias("norm"))


def normalized_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = I.embeddings(spark, sf_dir).select("row_id", V.normalize(F.col("embedding")).alias("e"))
    return unit.select("row_id", F.posexplode("e").alias("pos", "v")).select(
        "row_id", "pos", _six(F.col("v").cast("double")).alias("v")
    )


def embedding_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.matrix_shape(I.embeddings(spark, sf_dir))


def batch_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = I.embeddings(spark, sf_dir)
    return S.knn(vectors, vectors).withColumn("sim", _six("sim"))


def batch_knn_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries whose positions restart in each of four splits, against all vectors."""
    vectors = I.embeddings(spark, sf_dir)
    queries = vectors.select(
        (F.col("row_id") % 4).alias("split"), F.floor(F.col("row_id") / 4).alias("row_id"), "embedding"
    )
    return S.knn(queries, vectors, by="split").withColumn("sim", _six("sim"))


def knn_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = F.broadcast(S.top_k(I.embeddings(spark, sf_dir), 0))  # five rows
    docs = I.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "lang", "text")
    return S.with_records(hits, docs, "lang", "text").withColumn("sim", _six("sim"))


def approximate_knn_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = I.embeddings(spark, sf_dir)
    found = S.approximate_knn(vectors, vectors)
    share = S.scored_share(vectors, vectors).first()["share"]  # one row
    return S.recall(found, S.knn(vectors, vectors)).withColumn("scored_share", F.lit(share))


def batch_knn_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact search by cells, however many of them remain."""
    vectors = I.embeddings(spark, sf_dir)
    return pruned.pruned_knn(vectors, vectors, worthwhile=1.0).withColumn("sim", _six("sim"))


def graph_knn_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the neighbour graph finds of the exact neighbours, how many pairs it scores, and
    whether each similarity is the exact one."""
    vectors = I.embeddings(spark, sf_dir)
    found = materialize(neighbours.graph_knn(vectors), "found")
    # The graph's similarities are rounded, so one is exact that is within half a step.
    off = F.abs(F.col("sim") - F.col("exact")) > 0.5001 * 10.0**-V.TIE_DECIMALS
    wrong = off & ~(F.isnan("sim") & F.isnan("exact"))
    n_inexact = S.pair_cosines(found, vectors, vectors).agg(F.count_if(wrong)).first()[0]
    checked = S.knn(vectors, vectors).select("query_id", "row_id").join(found, ["query_id", "row_id"], "left")
    nearest = checked.agg(
        F.count(F.lit(1)).alias("n_exact"),
        F.count("sim").alias("n_found"),
        F.countDistinct("query_id").alias("n_rows"),
    )
    recall, share = F.try_divide("n_found", "n_exact"), F.try_divide(F.lit(neighbours.DEGREE), "n_rows")
    return nearest.select(
        "n_exact", F.lit(n_inexact).cast("long").alias("n_inexact"), (recall >= 0.9).alias("finds_most"), (share < 0.3).alias("scores_few")
    )


# --- records ----------------------------------------------------------------


def subject_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = R.parse_subjects(I.subject_lines(spark, sf_dir))
    return R.subject_texts(parsed, mode=R.FAILFAST).select("id", "text")


def paper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = R.parse_papers(I.paper_lines(spark, sf_dir))
    return R.paper_texts(parsed).select("split", "id", "text")


def paper_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddable, incomplete and rejected papers per split, in one pass."""
    parsed = R.parse_papers(I.paper_lines(spark, sf_dir))
    complete = F.col("paper_id").isNotNull() & F.col("text").isNotNull()
    outcome = F.coalesce("reason", F.when(complete, F.lit("embeddable")).otherwise(F.lit("incomplete")))
    return M.count_by(parsed.select("split", outcome.alias("outcome")), "split", "outcome")


def strict_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = jsonl.non_blank(I.event_lines(spark, sf_dir))
    parsed = R.with_object(lines, "k variant", "rec")
    verdict = F.coalesce(J.reject_reason("line", "rec"), F.lit("ok"))
    return parsed.select("event_id", verdict.alias("verdict"), J.is_json("line").alias("is_json"))


def _tallied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by what became of them, counted by the job that writes the merged table."""
    tally = M.Tally(["dev", "train"], I.SOURCES, I.SOURCE_LANGS)
    lines = jsonl.with_merge_order(jsonl.non_blank(I.document_lines(spark, sf_dir)), I.SOURCES, I.SOURCE_LANGS)
    materialize(M.merge_watched(lines, tally), "merged")
    return tally.counts(spark)


def skipped_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    skipped = _tallied(spark, sf_dir).where("verdict <> 'ok'")
    return skipped.groupBy("split", "doc_type", "lang").agg(F.sum("n").alias("n_skipped"))


def truthy_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = R.with_object(I.truth_lines(spark, sf_dir), "v variant", "rec")
    kept = evaluate_once(parsed, v=J.described("rec.v")).where(J.truthy("v"))
    return kept.select("o_orderkey", F.expr(J.filled_text("v")).alias("v_text"))


# --- merge ------------------------------------------------------------------


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = jsonl.with_merge_order(
        jsonl.non_blank(I.document_lines(spark, sf_dir)), I.SOURCES, I.SOURCE_LANGS
    )
    return M.merge(lines)


def merge_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [c for c in tables.MERGE_KEY if c != "split"]
    numbered = short_batches(number_rows(materialize(_merged(spark, sf_dir), "merged"), order, by="split"))
    return numbered.select("split", "doc_type", "lang", "row_id", J.canonical_json(F.col("json")).alias("json"))


def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tallied(spark, sf_dir).where("verdict = 'ok'").groupBy("split").agg(F.sum("n").alias("n_records"))


def merge_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = jsonl.expected_inputs(spark, ["train", "dev"], I.SOURCES, I.SOURCE_LANGS)
    return jsonl.absent_from(expected, I.document_lines(spark, sf_dir))


def collection_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written as ``{split}/{type}_{lang}.jsonl`` files, read as a collection."""
    keys = ["split", "doc_type", "lang"]
    parts, root = fresh_path(spark, "parts"), fresh_path(spark, "collection")
    lines = I.document_lines(spark, sf_dir).select(*keys, F.col("line").alias("value"))
    lines.repartition(*keys).write.partitionBy(*keys).text(parts)
    # Spark names its files itself: one rename for each combination, of which there are few.
    files = spark._jvm.org.apache.hadoop.fs.Path(f"{parts}/split=*/doc_type=*/lang=*/part-*")
    system = files.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.globStatus(files):
        split, doc_type, lang = (p.partition("=")[2] for p in status.getPath().toString().split("/")[-4:-1])
        to = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{split}/{doc_type}_{lang}.jsonl")
        system.mkdirs(to.getParent())
        system.rename(status.getPath(), to)
    read = jsonl.read_collection(spark, root, I.SOURCES, I.SOURCE_LANGS, splits=["dev", "train"])
    return M.count_by(read, "split", "doc_type", "lang", "doc_type_ord", "lang_ord", name="n_lines")


def merged_text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered text written per split and read back."""
    path = fresh_path(spark, "merged")
    tables.write_merged_lines(materialize(_merged(spark, sf_dir), "merged"), path)
    return jsonl.read_lines(spark, path).select("split", F.col("line").alias("json"))


# --- encoding ---------------------------------------------------------------


def hash_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(I.table(spark, sf_dir, "documents").select("doc_id", "text"))
    vectors = encode(docs, hashed_words(DIM)).select("doc_id", F.posexplode("embedding").alias("pos", "v"))
    return vectors.select("doc_id", "pos", _six(F.col("v").cast("double")).alias("v"))


def _subject_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = R.parse_subjects(I.subject_lines(spark, sf_dir))
    texts = number_rows(R.subject_texts(parsed), ["p_partkey"])
    path = fresh_path(spark, "subjects")
    tables.write_embeddings(encode(texts, hashed_words(DIM)), path)
    return tables.read_embeddings(spark, path)


def embedding_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, texts and vectors written with their positions and read back."""
    return _subject_table(spark, sf_dir).select(
        "row_id", "id", "text", F.size("embedding").alias("dim"), _six(V.norm(F.col("embedding"))).alias("norm")
    )


# --- graph ------------------------------------------------------------------


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON-LD document for each supplier, each in a file of its own, read as a tree."""
    path = fresh_path(spark, "tree")
    jsonld.write_documents(I.supplier_documents(spark, sf_dir), path)
    docs = jsonld.read_documents(spark, path, "*.txt", splits=["train", "dev"])
    nodes = graph.nodes(graph.parse_documents(docs))
    return nodes.select("split", "doc_type", "dir_lang", "position", "node_id", "node_type")


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.nodes(graph.parse_documents(I.order_documents(spark, sf_dir)))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.records(_nodes(spark, sf_dir))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.label_counts(graph.entities(_nodes(spark, sf_dir)))


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes(spark, sf_dir).select(
        F.col("file").cast("long").alias("o_orderkey"), "split", "position", "node_id", "node_type"
    )


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.edges(_records(spark, sf_dir)).select("split", "paper_id", "subject_id")


def graph_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labels(spark, sf_dir)


def canonical_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.canonical_labels(_labels(spark, sf_dir))


def edge_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The documents are parsed once; links and labels both read the stored nodes.
    nodes = materialize(_nodes(spark, sf_dir), "nodes")
    labels = materialize(graph.canonical_labels(graph.label_counts(graph.entities(nodes))), "labels")
    links = graph.edges(graph.records(nodes)).select("paper_id", "subject_id")
    return graph.with_labels(links, labels)


def identifier_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.identifiers(_records(spark, sf_dir))


def subject_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.classifications(_records(spark, sf_dir))


def term_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.agents(_records(spark, sf_dir))


def iri_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = graph.parse_documents(I.order_documents(spark, sf_dir))
    names = docs.select(
        F.col("file").cast("long").alias("o_orderkey"),
        graph.prefixes(graph.context_of(F.col("doc"))).alias("prefixes"),
        F.posexplode(graph.items_at(F.col("doc"), "@graph")).alias("position", "node"),
    ).withColumn("name", graph.string_at(F.col("node"), "@id"))
    return names.select("o_orderkey", "name", expand_iri(F.col("name"), F.col("prefixes")).alias("iri"))


def records_from_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.papers(_records(spark, sf_dir)).drop("issued")


def subjects_from_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = materialize(_nodes(spark, sf_dir), "nodes")
    labels = graph.canonical_labels(graph.label_counts(graph.entities(nodes)))
    return graph.subjects(labels, graph.edges(graph.records(nodes)))


def split_audit_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.unseen_subjects(graph.edges(_records(spark, sf_dir)), "dev", "train")


def split_audit_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = I.table(spark, sf_dir, "documents").select(I.split_of(F.col("source")).alias("split"), "lang", "text")
    return audit.shared_texts(docs, "lang", "text")


def suggested_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to suggestions: flatten, compose texts, embed, search."""
    nodes = materialize(_nodes(spark, sf_dir), "nodes")
    recs = graph.records(nodes)
    labels = graph.canonical_labels(graph.label_counts(graph.entities(nodes)))
    encoder = hashed_words(DIM)

    found = materialize(graph.subjects(labels, graph.edges(recs)), "found")
    subject_lines = graph.subject_lines(found)
    texts = materialize(R.subject_texts(R.parse_subjects(subject_lines)), "texts")
    subjects = number_rows(texts, ["id"])  # it reads its input twice
    subject_path = fresh_path(spark, "subjects")
    tables.write_embeddings(encode(subjects, encoder), subject_path)

    papers = R.paper_texts(R.parse_papers(graph.paper_lines(graph.papers(recs))))
    vectors = encode(papers.select(F.col("id").cast("long").alias("row_id"), "text"), encoder)
    paper_table = materialize(vectors.select("row_id", "embedding"), "papers")

    subject_table = tables.read_embeddings(spark, subject_path)
    hits = suggest_subjects(paper_table, subject_table)
    named = S.with_records(hits, subject_table, "id")
    return named.select("query_id", "rank", F.col("id").alias("subject_id"), _six("sim").alias("sim"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        topk_similar,
        similarity_vector,
        vector_norms,
        normalized_vectors,
        embedding_shape,
        batch_knn,
        batch_knn_pruned,
        graph_knn_recall,
        batch_knn_by_split,
        knn_with_text,
        approximate_knn_recall,
        subject_text,
        paper_text,
        paper_outcomes,
        strict_json,
        skipped_report,
        truthy_filter,
        merge_ordered,
        merge_counts,
        merge_coverage,
        collection_files,
        merged_text_files,
        hash_embed,
        embedding_table,
        document_files,
        graph_nodes,
        graph_edges,
        graph_labels,
        canonical_labels,
        edge_labels,
        identifier_split,
        subject_split,
        term_resolve,
        iri_expand,
        records_from_graph,
        subjects_from_graph,
        split_audit_subjects,
        split_audit_texts,
        suggested_subjects,
    )
}
