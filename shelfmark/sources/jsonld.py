"""JSON-LD documents, one per file."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import swap_in

# Files that a task writes: what costs is to make a file, not the bytes that go into it.
FILES_A_TASK = 2_000


def read_documents(
    spark: SparkSession,
    root: str,
    pattern: str = "*.jsonld",
    splits: Sequence[str] | None = None,
    doc_types: Sequence[str] | None = None,
    langs: Sequence[str] | None = None,
) -> DataFrame:
    """Files under ``{root}/{split}/{type}/{lang}/`` as
    ``(file, split, doc_type, dir_lang, value)``, the whole text in ``value``.

    Folders may also be named as Spark writes them, ``split=train``. Where splits, types
    or languages are named, no other folder is listed. Millions of small files are packed
    into few tasks only when the session counts them as small; ``build_session`` sets that.
    """
    folders = "/".join("*" if names is None else "{%s}" % ",".join(f"{n},*={n}" for n in names) for names in (splits, doc_types, langs))
    named = splits is not None or doc_types is not None or langs is not None
    docs = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .text(f"{root.rstrip('/')}/{folders}" if named else root, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file"), "value")
    )
    parts = F.transform(F.split("file", "/"), lambda part: F.regexp_replace(part, "^[^=]*=", ""))
    return docs.select(
        "file",
        F.element_at(parts, -4).alias("split"),
        F.element_at(parts, -3).alias("doc_type"),
        F.element_at(parts, -2).alias("dir_lang"),
        "value",
    )


def write_documents(docs: DataFrame, path: str, files_a_task: int = FILES_A_TASK) -> None:
    """Write ``(split, doc_type, dir_lang, value)`` as one file for each row, in the folders
    that :func:`read_documents` reads with ``pattern="*.txt"``.

    Rows are counted and dealt out by their number over all cores, at most about
    ``files_a_task`` to a task, so no folder is one task's. Tasks move their own files to
    their place (the second commit algorithm) and leave the driver none to move one by one;
    nobody reads the folder before it is whole, as it takes the old one's place only then.
    """
    rows = docs.select("split", "doc_type", "dir_lang", "value")
    tasks = max(math.ceil(rows.count() / files_a_task), docs.sparkSession.sparkContext.defaultParallelism)
    writer = rows.repartition(tasks).write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    swap_in(docs.sparkSession, path, writer.partitionBy("split", "doc_type", "dir_lang").text)
