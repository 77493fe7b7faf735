"""JSON Lines collections: one file per split, document type and language."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.text import strip

# The collection's document types and languages, in merge order,
# and the name of the file that holds one combination.
DOC_TYPES = ("Article", "Book", "Conference", "Report", "Thesis")
LANGS = ("de", "en")
FILE_NAME = r"([^/]+)/([^/_]+)_([^/_]+)\.jsonl$"  # split / type _ language

# Columns that order lines as they stand in their files.
LINE_KEY = ("file", "block", "line_no")


def read_lines(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Lines of text files as ``(file, block, line_no, line)``, trimmed, blanks dropped.

    ``block`` is the offset of the file part a task read and ``line_no`` grows
    within it, so ``(file, block, line_no)`` restores line order with no shuffle
    spent before somebody sorts. ``line_no`` is not dense. Partition columns of
    a folder such as the merged sink's come first.
    """
    lines = spark.read.options(**options).text(path)
    numbered = lines.select(
        *[c for c in lines.columns if c != "value"],
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        strip(F.col("value")).alias("line"),
    )
    return numbered.where(F.col("line") != "")


def non_blank(lines: DataFrame, column: str = "line") -> DataFrame:
    """Trim a column of lines that did not come from :func:`read_lines`; drop blanks."""
    return lines.withColumn(column, strip(F.col(column))).where(F.col(column) != "")


def position_in(value: Column, order: Sequence[str]) -> Column:
    """Index of a value in a fixed list, the list's length when absent."""
    case = F.lit(len(order))
    for i, item in enumerate(order):
        case = F.when(value == item, F.lit(i)).otherwise(case)
    return case


def _collection_paths(
    root: str, splits: Sequence[str] | None, doc_types: Sequence[str], langs: Sequence[str]
) -> str:
    """``{root}/{split}/{type}_{lang}.jsonl`` as one pattern: no other file is listed, and
    no folder of a split that is not asked for."""
    folder = "*" if splits is None else "{%s}" % ",".join(splits)
    return f"{root.rstrip('/')}/{folder}/{{{','.join(doc_types)}}}_{{{','.join(langs)}}}.jsonl"


def _matching(spark: SparkSession, pattern: str) -> bool:
    """Whether any file fits; Spark takes a pattern that fits none for an error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def _path_parts(file: Column) -> list[Column]:
    return [
        F.regexp_extract(file, FILE_NAME, 1).alias("split"),
        F.regexp_extract(file, FILE_NAME, 2).alias("doc_type"),
        F.regexp_extract(file, FILE_NAME, 3).alias("lang"),
    ]


def with_merge_order(
    df: DataFrame, doc_types: Sequence[str] = DOC_TYPES, langs: Sequence[str] = LANGS
) -> DataFrame:
    """Add the two leading keys of the merge order."""
    return df.withColumns(
        {
            "doc_type_ord": position_in(F.col("doc_type"), doc_types),
            "lang_ord": position_in(F.col("lang"), langs),
        }
    )


def read_collection(
    spark: SparkSession,
    root: str,
    doc_types: Sequence[str] = DOC_TYPES,
    langs: Sequence[str] = LANGS,
    splits: Sequence[str] | None = None,
) -> DataFrame:
    """All ``{root}/{split}/{type}_{lang}.jsonl`` lines in one scan, of the named splits
    or of all. Files elsewhere under ``root`` are not part of the collection.

    Split, type and language come from the path; absent files are simply not
    there (see :func:`missing_inputs`).
    """
    pattern = _collection_paths(root, splits, doc_types, langs)
    if _matching(spark, pattern):
        lines = read_lines(spark, pattern)
    else:
        lines = spark.createDataFrame([], "file string, block long, line_no long, line string")
    tagged = lines.select(*_path_parts(F.col("file")), "*")
    return with_merge_order(tagged, doc_types, langs)


def splits_of(
    spark: SparkSession, root: str, doc_types: Sequence[str] = DOC_TYPES, langs: Sequence[str] = LANGS
) -> list[str]:
    """Folders under ``root`` that hold a file of the collection, by listing only."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_collection_paths(root, None, doc_types, langs))
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted({status.getPath().getParent().getName() for status in found})


def missing_inputs(
    spark: SparkSession,
    root: str,
    splits: Sequence[str],
    doc_types: Sequence[str] = DOC_TYPES,
    langs: Sequence[str] = LANGS,
) -> DataFrame:
    """Expected ``(split, doc_type, lang)`` combinations that have no file.

    Taken from the file listing Spark plans a scan with, of the expected files only; a
    scan itself would not show empty files, which count as present.
    """
    pattern = _collection_paths(root, splits, doc_types, langs)
    listed = spark.read.text(pattern).inputFiles() if _matching(spark, pattern) else []
    files = spark.createDataFrame([(f,) for f in listed], "path string")
    found = files.select(*_path_parts(F.col("path")))
    return absent_from(expected_inputs(spark, splits, doc_types, langs), found)


def expected_inputs(
    spark: SparkSession,
    splits: Sequence[str],
    doc_types: Sequence[str] = DOC_TYPES,
    langs: Sequence[str] = LANGS,
) -> DataFrame:
    """The grid of combinations a merge expects."""
    grid = [(s, t, g) for s in splits for t in doc_types for g in langs]
    return spark.createDataFrame(grid, "split string, doc_type string, lang string")


def absent_from(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of the grid that ``found`` lacks.

    ``found`` is cut to distinct combinations before the join, so what is
    shuffled is at most the grid's size per task, however many rows it has.
    """
    keys = ["split", "doc_type", "lang"]
    return expected.join(found.select(*keys).distinct(), keys, "left_anti")
