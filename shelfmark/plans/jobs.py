"""The jobs a user runs: merge a collection, embed it, search it, flatten documents."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.text import label_with_definition
from shelfmark.operators import graph
from shelfmark.operators.encode import Encoder, encode
from shelfmark.operators.merge import Tally, count_by, malformed, merge_watched
from shelfmark.operators.numbering import number_lines, number_rows
from shelfmark.operators.records import (
    FAILFAST,
    SKIP,
    paper_texts,
    parse_papers,
    parse_subjects,
    subject_texts,
)
from shelfmark.operators.similarity import TOP_K, knn, top_k, with_records
from shelfmark.session import materialize, scratch, swap_in
from shelfmark.sources.jsonl import (
    DOC_TYPES,
    LANGS,
    missing_inputs,
    read_collection,
    read_lines,
    splits_of,
)
from shelfmark.sources.jsonld import read_documents
from shelfmark.sources.tables import (
    MERGE_KEY,
    merged_table,
    read_embeddings,
    read_merged_table,
    write_embeddings,
    write_merged_lines,
    write_merged_table,
)


def merge_collection(
    spark: SparkSession,
    root: str,
    out: str,
    splits: Sequence[str] | None = None,
    doc_types: Sequence[str] = DOC_TYPES,
    langs: Sequence[str] = LANGS,
    lines_out: str | None = None,
) -> DataFrame:
    """Merge ``{root}/{split}/{type}_{lang}.jsonl`` into a table at ``out``; returns
    the records per split.

    All splits found are merged in one job, with no shuffle, unless some are
    named. ``lines_out`` also writes the records as ordered text, one folder per
    split, which takes a range shuffle.
    """
    return merge_with_report(spark, root, out, splits, doc_types, langs, lines_out).records


class MergeReport(NamedTuple):
    """Records per split, skipped lines per input and reason, and inputs without a file."""

    records: DataFrame
    skipped: DataFrame
    missing: DataFrame


def merge_with_report(
    spark: SparkSession,
    root: str,
    out: str,
    splits: Sequence[str] | None = None,
    doc_types: Sequence[str] = DOC_TYPES,
    langs: Sequence[str] = LANGS,
    lines_out: str | None = None,
) -> MergeReport:
    """:func:`merge_collection`, which also tells what it left out. All counts are taken by
    the job that writes the table; what is missing is known from the file listing."""
    splits = splits_of(spark, root, doc_types, langs) if splits is None else list(splits)
    tally = Tally(splits, doc_types, langs)
    lines = read_collection(spark, root, doc_types, langs, splits)
    write_merged_table(merge_watched(lines, tally), out)
    counts = tally.counts(spark)  # a row per input and verdict, on the driver already
    if lines_out:
        write_merged_lines(merged_table(spark, out), lines_out)
    kept, good = counts.groupBy("split"), F.col("verdict") == "ok"
    return MergeReport(
        kept.agg(F.sum(F.when(good, F.col("n")).otherwise(0)).alias("n_records")).where("n_records > 0"),
        counts.where(~good).select("split", "doc_type", "lang", F.col("verdict").alias("reason"), F.col("n").alias("n_skipped")),
        missing_inputs(spark, root, splits, doc_types, langs),
    )


def merge_report(
    spark: SparkSession,
    root: str,
    splits: Sequence[str] | None = None,
    doc_types: Sequence[str] = DOC_TYPES,
    langs: Sequence[str] = LANGS,
) -> tuple[DataFrame, DataFrame]:
    """What a merge of ``root`` leaves out: skipped lines per file and reason, and the
    combinations of split, type and language that have no file. Where no splits are
    named, those that have any line are expected to be complete."""
    lines = read_collection(spark, root, doc_types, langs, splits)
    skipped = count_by(malformed(lines), "file", "reason", name="n_skipped")
    if splits is None:
        splits = [r[0] for r in lines.select("split").distinct().collect()]  # folders of root
    return skipped, missing_inputs(spark, root, sorted(splits), doc_types, langs)


def paper_outcomes(spark: SparkSession, merged: str) -> DataFrame:
    """What becomes of the papers of a merged table when they are embedded: how many are
    embeddable, incomplete or rejected, per split and with the reason."""
    parsed = parse_papers(read_merged_table(spark, merged))
    complete = F.col("paper_id").isNotNull() & F.col("text").isNotNull()
    outcome = F.coalesce("reason", F.when(complete, F.lit("embeddable")).otherwise(F.lit("incomplete")))
    return count_by(parsed.select("split", outcome.alias("outcome")), "split", "outcome")


def embed_papers(
    spark: SparkSession,
    merged: str,
    out: str,
    make_encoder: Callable[[], Encoder],
    mode: str = SKIP,
) -> DataFrame:
    """Embed the papers of a merged table, numbered per split in merge order."""
    texts = paper_texts(parse_papers(read_merged_table(spark, merged)), mode)
    order = [c for c in MERGE_KEY if c not in ("split", "line_no")]
    with scratch(spark):
        numbered = number_lines(texts, order, by="split")
        write_embeddings(encode(numbered, make_encoder), out, by="split")
    return read_embeddings(spark, out, by="split")


def embed_subjects(
    spark: SparkSession,
    path: str,
    out: str,
    make_encoder: Callable[[], Encoder],
    mode: str = FAILFAST,
) -> DataFrame:
    """Embed files of subject lines, numbered in line order."""
    with scratch(spark):
        texts = number_lines(subject_texts(parse_subjects(read_lines(spark, path)), mode))
        write_embeddings(encode(texts, make_encoder), out)
    return read_embeddings(spark, out)


def embed_flattened(
    spark: SparkSession,
    flat: str,
    out: str,
    make_encoder: Callable[[], Encoder],
    translations: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Embed the papers and subjects that :func:`flatten_documents` wrote; returns both
    tables, ``out/papers`` and ``out/subjects``.

    ``translations`` holds ``paper_id`` and ``title_en``, for papers without a text.
    Texts are composed from the columns; papers without id or text and subjects without
    code or label are left out.
    """
    papers = spark.read.option("mergeSchema", "false").parquet(f"{flat}/papers").withColumn("split", F.col("split").cast("string"))
    title = F.nullif("title_en", F.lit(""))
    if translations is not None:
        told = translations.select("paper_id", F.col("title_en").alias("__told")).dropDuplicates(["paper_id"])
        papers = papers.join(told, "paper_id", "left")
        title = F.coalesce(F.nullif("__told", F.lit("")), title)
    texts = papers.select("split", F.col("paper_id").alias("id"), F.coalesce(F.nullif("text", F.lit("")), title).alias("text"))
    subjects = spark.read.parquet(f"{flat}/subjects").where("code <> '' AND label <> ''")
    named = subjects.select(F.col("code").alias("id"), label_with_definition(F.col("label"), F.col("definition")).alias("text"))
    with scratch(spark):
        numbered = number_rows(materialize(texts.where("id <> '' AND text IS NOT NULL"), "texts"), ["id"], by="split")
        write_embeddings(encode(numbered, make_encoder), f"{out}/papers", by="split")
        write_embeddings(encode(number_rows(materialize(named, "texts"), ["id"]), make_encoder), f"{out}/subjects")
    return read_embeddings(spark, f"{out}/papers", by="split"), read_embeddings(spark, f"{out}/subjects")


def write_suggestions(spark: SparkSession, embedded: str, out: str, k: int = TOP_K) -> DataFrame:
    """Write the ``k`` nearest subjects of every paper of :func:`embed_flattened`'s tables:
    split, query_id, rank, sim, subject id and text."""
    papers, subjects = read_embeddings(spark, f"{embedded}/papers", by="split"), read_embeddings(spark, f"{embedded}/subjects")
    named = with_records(suggest_subjects(papers, subjects, k), subjects, "id", "text")
    swap_in(spark, out, named.select("split", "query_id", "rank", "sim", "id", "text").write.parquet)
    return spark.read.parquet(out)


def similar_to(table: DataFrame, query_row: int = 0, k: int = TOP_K) -> DataFrame:
    """The rows most similar to one row, with their ids and texts, best first."""
    # k rows, so the lookup is a broadcast whatever the table's size.
    hits = F.broadcast(top_k(table, query_row, k))
    return with_records(hits, table, "id", "text").orderBy("rank")


def suggest_subjects(papers: DataFrame, subjects: DataFrame, k: int = TOP_K) -> DataFrame:
    """The subjects nearest to every paper; both are stored embedding tables. Papers of
    several splits, whose positions restart, are told apart by ``split``."""
    by = "split" if "split" in papers.columns else None
    keys = [by] if by else []
    return knn(papers.select(*keys, "row_id", "embedding"), subjects.select("row_id", "embedding"), k, by)


def flatten_documents(spark: SparkSession, root: str, out: str, pattern: str = "*.jsonld") -> None:
    """Write the tables of a JSON-LD tree under ``out``: nodes, papers, identifiers,
    classifications, agents, links, label_counts, labels, subjects, unreadable.

    Nodes are written first and every other table is read off them, so the
    documents are parsed once.
    """

    def store(df: DataFrame, name: str, *partition: str) -> DataFrame:
        df.write.mode("overwrite").partitionBy(*partition).parquet(f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}")

    with scratch(spark):
        parsed = materialize(graph.parse_documents(read_documents(spark, root, pattern)), "documents")
        store(graph.unreadable(parsed), "unreadable")
        nodes = store(graph.nodes(parsed), "nodes", "split")
    recs = graph.records(nodes)
    store(graph.papers(recs), "papers", "split")
    store(graph.identifiers(recs), "identifiers")
    store(graph.classifications(recs), "classifications")
    store(graph.agents(recs), "agents")
    links = store(graph.edges(recs), "links", "split")
    counts = store(graph.label_counts(graph.entities(nodes)), "label_counts")
    labels = store(graph.canonical_labels(counts), "labels")
    store(graph.subjects(labels, links), "subjects")
