"""The embedding table and the merged collection as written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.json import canonical_json
from shelfmark.session import range_partitions, short_batches, swap_in
from shelfmark.sources.jsonl import LINE_KEY

MERGE_KEY = ("split", "doc_type_ord", "lang_ord", *LINE_KEY)

EMBEDDINGS = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)

MERGED = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("line_no", T.LongType()),
        T.StructField("doc_type_ord", T.IntegerType()),
        T.StructField("lang_ord", T.IntegerType()),
        T.StructField("json", T.StringType()),
        # Folders; as partition columns they come last.
        T.StructField("split", T.StringType()),
        T.StructField("doc_type", T.StringType()),
        T.StructField("lang", T.StringType()),
    ]
)


def write_merged_lines(merged: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write merged lines as text, re-serialised, one folder per split, replacing what is
    there.

    A range shuffle on the merge order leaves each part file sorted and the part
    files in order by name, so reading them in turn gives the merged sequence.
    The key is unique per line, so no range can outgrow the others.
    """
    n = partitions or range_partitions(merged)
    ranged = short_batches(merged).repartitionByRange(n, *MERGE_KEY).sortWithinPartitions(*MERGE_KEY)
    lines = ranged.select("split", canonical_json(F.col("json")).alias("value"), F.spark_partition_id().alias("part"))
    # Part files are numbered with five digits at least: with more of them, those of one
    # length go to a folder of their own, so that names still sort as numbers do.
    folders = ["split"]
    if n > 99_999:
        lines = lines.withColumn("hundred_thousand", F.lpad(F.floor(F.col("part") / 100_000), 8, "0"))
        folders.append("hundred_thousand")
    swap_in(merged.sparkSession, path, lambda to: lines.drop("part").write.partitionBy(*folders).text(to))


def write_merged_table(merged: DataFrame, path: str) -> None:
    """Write merged records as Parquet with their provenance and order, no shuffle.

    Partitioned by split, type and language, so that a reader of one split lists
    only its folders. Each task sorts its own rows, which keeps every file in line
    order; merge order is the columns of ``MERGE_KEY``.
    """
    folders = ["split", "doc_type", "lang"]
    sorted_lines = merged.sortWithinPartitions(*folders, *LINE_KEY)
    swap_in(merged.sparkSession, path, lambda to: sorted_lines.write.partitionBy(*folders).parquet(to))


def merged_table(spark: SparkSession, path: str) -> DataFrame:
    """A merged table with its declared schema: a split named ``01`` stays ``01``."""
    return spark.read.schema(MERGED).parquet(path)


def read_merged_table(spark: SparkSession, path: str) -> DataFrame:
    """A merged table as lines: what the record readers take."""
    return merged_table(spark, path).withColumnRenamed("json", "line")


def write_embeddings(df: DataFrame, path: str, by: str | None = None) -> None:
    """Store ids, texts and vectors row by row with their position, replacing what
    is there. ``df`` holds ``row_id``, ``id``, ``embedding`` and, unless texts are
    not to be kept, ``text``."""
    if "text" not in df.columns:
        df = df.withColumn("text", F.lit(None).cast("string"))
    columns = [F.col(f.name).cast(f.dataType) for f in EMBEDDINGS]
    writer = df.select(*columns, *([by] if by else [])).write
    swap_in(df.sparkSession, path, (writer.partitionBy(by) if by else writer).parquet)


def read_embeddings(spark: SparkSession, path: str, by: str | None = None) -> DataFrame:
    """An embedding table with its declared schema."""
    schema = EMBEDDINGS if by is None else T.StructType([*EMBEDDINGS, T.StructField(by, T.StringType())])
    return spark.read.schema(schema).parquet(path)


def matrix_shape(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """``(n_rows, dim)``; fails when rows disagree in length."""
    sizes = F.size(vector)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(sizes).alias("dim"),
        F.max(sizes).alias("max_dim"),
    ).select(
        "n_rows",
        F.when(F.col("dim").eqNullSafe(F.col("max_dim")), F.col("dim"))
        .otherwise(F.raise_error(F.lit("vectors of unequal length")).cast("int"))
        .alias("dim"),
    )
