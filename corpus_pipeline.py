"""From raw documents to token ids, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import decontaminate, neardup, pieces, suffixdedup, toxicity
from shelfmark.llm.common import table
from shelfmark.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; the classifier is trained on ``labels``."""
    scored = toxicity.add_scores(docs, _classifier(docs, table(spark, sf_dir, "labels")), out="__score")
    return scored.where(F.col("__score") < 0.7).select(*docs.columns)


def _classifier(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    fit = labels.where(toxicity.remainder("doc_id", 3) != 1)
    return toxicity.train(docs.select("doc_id", "text"), fit)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that are 80 % alike in five-word shingles one stays."""
    return neardup.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur twice go from all texts; n_chars follows. A document
    stays, if with an empty text; a null text becomes an empty one."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    cut = suffixdedup.without_repeats(docs, keep=others, outputs=["kept_text"])
    named = cut.withColumnRenamed("kept_text", "text").withColumn("n_chars", F.char_length("text").cast("bigint"))
    return named.select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words one in twenty lies inside a benchmark window go."""
    found = decontaminate.find_overlaps(docs.select(F.struct(*docs.columns).alias("row"), "text"), table(spark, sf_dir, "benchmark"), keep=["row"])
    return found.where(~decontaminate.contaminated()).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the ids of each text and whether decoding them gives the text again."""
    return pieces.with_ids(docs, check=True).drop("decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_benchmark),
    ("sentencepiece", encode),
]

#: The toxicity stage trains a classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
