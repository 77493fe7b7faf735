"""Flattening JSON-LD documents into relational tables.

A document is an object with ``@graph`` (entity nodes, which carry ``sameAs``
labels, and one typed record) and ``@context`` (what its terms mean). Fields may
be a string or an array of strings, so everything is read through VARIANT.
Which field feeds which column is this library's own mapping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.names import classification, expand_iri, scheme_of, value_of
from shelfmark.operators.once import evaluate_once

# Terms that name people and bodies, with the role each stands for. Compact and
# full spellings of one property mean the same.
AGENT_TERMS = {
    "creator": "creator",
    "dcterms:creator": "creator",
    "http://purl.org/dc/elements/1.1/creator": "creator",
    "contributor": "contributor",
    "dcterms:contributor": "contributor",
    "http://purl.org/dc/elements/1.1/contributor": "contributor",
}

LITERAL, REFERENCE = "literal", "reference"

# Columns every table keeps to say where a row came from.
ORIGIN = ("split", "doc_type", "dir_lang")


def _path(term: str) -> str:
    return f'$["{term}"]'


def string_at(node: Column, term: str) -> Column:
    return F.try_variant_get(node, _path(term), "string")


def strings_at(node: Column, term: str) -> Column:
    """A string or an array of strings as an array; null when absent.

    The array is tried first: reading an array as a string would succeed and
    give JSON text.
    """
    single = string_at(node, term)
    return F.coalesce(
        F.try_variant_get(node, _path(term), "array<string>"),
        F.when(single.isNotNull(), F.array(single)),
    )


def items_at(node: Column, term: str) -> Column:
    """One value or an array of any values as ``array<variant>``; null when absent."""
    single = F.try_variant_get(node, _path(term), "variant")
    return F.coalesce(
        F.try_variant_get(node, _path(term), "array<variant>"),
        F.when(single.isNotNull() & ~F.is_variant_null(single), F.array(single)),
    )


def parse_documents(docs: DataFrame) -> DataFrame:
    """Replace the ``value`` text by ``doc``, a VARIANT; null when it cannot be read.

    Of a repeated key the last value counts. Spark takes such a document for malformed
    unless the session says otherwise, so the session is told here.
    """
    docs.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    parsed = evaluate_once(docs, doc=F.try_parse_json(F.col("value")))
    return parsed.drop("value")


def _graph(doc: Column) -> Column:
    return F.try_variant_get(doc, _path("@graph"), "array<variant>")


def unreadable(parsed: DataFrame) -> DataFrame:
    """Documents without a readable graph."""
    return parsed.where(_graph(F.col("doc")).isNull()).drop("doc")


def nodes(parsed: DataFrame) -> DataFrame:
    """One row per graph node: ``(…, position, node_id, node_type, node, context)``.

    ``node_type`` is null for entities, and only records carry their document's
    ``context``. Every later table starts from here, so write it out once
    instead of exploding the documents for each of them.
    """
    keep = [c for c in parsed.columns if c != "doc"]
    exploded = parsed.select("*", F.posexplode(_graph(F.col("doc"))).alias("position", "node"))
    typed = string_at(F.col("node"), "@type")
    return exploded.select(
        *keep,
        "position",
        string_at(F.col("node"), "@id").alias("node_id"),
        typed.alias("node_type"),
        "node",
        F.when(typed.isNotNull(), context_of(F.col("doc"))).alias("context"),
    )


def context_of(doc: Column) -> Column:
    """What the document's terms mean, by term."""
    return F.try_variant_get(doc, _path("@context"), "map<string,variant>")


def records(graph_nodes: DataFrame) -> DataFrame:
    """The typed nodes, with ``paper_id``: the end of the node's IRI."""
    tail = F.substring_index("node_id", "%3A", -1)
    return graph_nodes.where(F.col("node_type").isNotNull()).withColumn("paper_id", tail)


def entities(graph_nodes: DataFrame) -> DataFrame:
    """``(entity_id, label)`` of every mention of an entity, one row per label."""
    mentions = graph_nodes.where(F.col("node_type").isNull())
    return mentions.select(
        F.col("node_id").alias("entity_id"),
        F.explode(strings_at(F.col("node"), "sameAs")).alias("label"),
    )


def label_counts(mentions: DataFrame) -> DataFrame:
    """Distinct ``(entity_id, label)`` with how often each occurs."""
    return mentions.groupBy("entity_id", "label").agg(F.count(F.lit(1)).alias("n_mentions"))


def canonical_labels(counts: DataFrame) -> DataFrame:
    """One label per entity: the most frequent, the alphabetically first of equals.

    An aggregate, not a window, so that a much-mentioned entity is reduced
    before the shuffle.
    """
    best = F.min(F.struct((-F.col("n_mentions")).alias("less"), F.col("label"))).alias("best")
    return counts.groupBy("entity_id").agg(best).select("entity_id", F.col("best.label").alias("label"))


def edges(recs: DataFrame) -> DataFrame:
    """``(…, paper_id, subject_id)`` links from records to subjects."""
    return recs.select(
        *[c for c in ORIGIN if c in recs.columns],
        "paper_id",
        F.explode(items_at(F.col("node"), "dcterms:subject")).alias("__ref"),
    ).select("*", string_at(F.col("__ref"), "@id").alias("subject_id")).drop("__ref")


def with_labels(links: DataFrame, labels: DataFrame, how: str = "left") -> DataFrame:
    """Links with the label of their subject.

    ``labels`` grows with the data, so the join strategy is left to Spark: it
    broadcasts a small table, and otherwise splits a hot subject's partition. It can
    split one only if both sides come straight from a shuffle: give it a stored table,
    not an aggregate.
    """
    named = labels.select(F.col("entity_id").alias("subject_id"), F.col("label").alias("subject_label"))
    return links.join(named, "subject_id", how)


def identifiers(recs: DataFrame) -> DataFrame:
    """``(paper_id, scheme, value)``; scheme is null where the text names none."""
    text = F.col("__text")
    return recs.select(
        "paper_id", F.explode(strings_at(F.col("node"), "identifier")).alias("__text")
    ).select("paper_id", scheme_of(text).alias("scheme"), value_of(text).alias("value"))


def classifications(recs: DataFrame) -> DataFrame:
    """``(paper_id, scheme, scheme_id, value)``; scheme is null for free keywords."""
    return (
        recs.select("paper_id", F.explode(strings_at(F.col("node"), "subject")).alias("__text"))
        .withColumn("__c", classification(F.col("__text")))
        .select("paper_id", "__c.*")
    )


def prefixes(context: Column) -> Column:
    """The string entries of a context as ``map<string,string>``; among them are
    the prefixes of compact names."""
    as_text = F.transform_values(
        context,
        lambda _, v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")),
    )
    return F.map_filter(as_text, lambda _, v: v.isNotNull())


def agents(recs: DataFrame) -> DataFrame:
    """``(paper_id, role, kind, value, iri)`` of everyone a record names.

    A string is a reference when its document's context types the term as
    ``@id``, a literal otherwise; an object with ``@id`` is always a reference.
    ``iri`` is a reference's expanded form.
    """

    def one(term: str, role: str) -> Column:
        term_type = string_at(F.try_element_at("context", F.lit(term)), "@type")
        return F.struct(
            F.lit(role).alias("role"),
            F.coalesce(term_type == "@id", F.lit(False)).alias("typed"),
            items_at(F.col("node"), term).alias("items"),
        )

    found = F.array(*[one(term, role) for term, role in AGENT_TERMS.items()])
    each = (
        recs.select("paper_id", prefixes(F.col("context")).alias("prefixes"), F.explode(found).alias("f"))
        .select("paper_id", "prefixes", "f.role", "f.typed", F.explode("f.items").alias("item"))
    )
    item_id = string_at(F.col("item"), "@id")
    is_ref = F.col("typed") | item_id.isNotNull()
    return each.select(
        "paper_id",
        "role",
        F.when(is_ref, F.lit(REFERENCE)).otherwise(F.lit(LITERAL)).alias("kind"),
        F.coalesce(item_id, F.try_variant_get(F.col("item"), "$", "string")).alias("value"),
        "prefixes",
    ).select(
        "paper_id",
        "role",
        "kind",
        "value",
        F.when(F.col("kind") == REFERENCE, expand_iri(F.col("value"), F.col("prefixes"))).alias("iri"),
    )


def papers(recs: DataFrame) -> DataFrame:
    """Bibliographic columns of each record and the text to embed.

    ``text`` is title and abstract; ``title_en`` is the title of a record tagged
    English, and null otherwise (translations are the caller's to join).
    """
    node = F.col("node")
    language = F.element_at(F.split(string_at(node, "language"), "/"), -1)
    return recs.select(
        *[c for c in ORIGIN if c in recs.columns],
        "paper_id",
        F.element_at(F.split("node_type", ":"), -1).alias("record_type"),
        F.array_join(strings_at(node, "title"), " ").alias("title"),
        F.array_join(strings_at(node, "abstract"), " ").alias("abstract"),
        language.alias("lang_tag"),
        string_at(node, "issued").alias("issued"),
    ).select(
        "*",
        F.expr("try_cast(issued AS INT)").alias("issued_year"),
        F.concat_ws(". ", "title", "abstract").alias("text"),
        F.when(F.col("lang_tag") == "en", F.col("title")).alias("title_en"),
    )


def paper_lines(paper_table: DataFrame) -> DataFrame:
    """Papers as the JSON lines the record readers take."""
    content = F.struct("text", "title_en")
    line = F.to_json(F.struct("paper_id", content.alias("content")))
    return paper_table.select(*[c for c in ORIGIN if c in paper_table.columns], line.alias("line"))


def subjects(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``(code, label, definition)`` of entities used as subjects.

    The links are cut to distinct subjects first, so a hot subject is one row by
    the time it reaches the join. No definitions are part of the documents.
    """
    used = links.select(F.col("subject_id").alias("entity_id")).distinct()
    return labels.join(used, "entity_id", "left_semi").select(
        F.col("entity_id").alias("code"), "label", F.lit(None).cast("string").alias("definition")
    )


def subject_lines(subject_table: DataFrame) -> DataFrame:
    """Subjects as the JSON lines the record readers take."""
    fields = F.struct(
        F.col("code").alias("Code"),
        F.col("label").alias("Classification Name"),
        F.col("definition").alias("Definition"),
    )
    return subject_table.select(F.to_json(fields).alias("line"))
