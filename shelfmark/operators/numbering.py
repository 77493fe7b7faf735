"""Dense row positions without a single-task window.

Both functions write the rows once, each with the run it belongs to and its
place there, then add up the run lengths and join the sums back. Only the runs pass
through a window, and that by ranges of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import broadcast_if_small, materialize, range_partitions


def number_lines(
    df: DataFrame,
    order: Sequence[str] = ("file", "block"),
    line: str = "line_no",
    by: str | None = None,
    name: str = "row_id",
) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... by ``order`` and then ``line``, restarting per ``by``.
    No row is shuffled.

    ``df`` comes from ``read_lines`` or a merged table through filters and
    projections only. There every task reads runs of rows that share ``order`` and
    ascend in ``line``; that this holds, and that no two runs overlap, is checked.
    Use :func:`number_rows` for frames in any other order.
    """
    place = F.monotonically_increasing_id()
    placed = materialize(
        df.withColumn("__place", place).withColumn("__task", F.shiftrightunsigned("__place", 33)),
        "lines",
    )
    return _numbered(placed, [by] if by else [], [*order], "__task", line, name).select(name, *df.columns)


def number_rows(
    df: DataFrame,
    order_by: list[str],
    by: str | None = None,
    name: str = "row_id",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... in the order of ``order_by``, restarting per ``by``.

    Rows are range-partitioned and sorted; a hot ``by`` value is spread over many
    ranges like any other rows. ``order_by`` should be unique per row; rows that
    tie get their order from the one written run. ``df`` is read twice, once to
    sample the ranges: number before an expensive step, not after it.
    """
    keys = [by, *order_by] if by else order_by
    ranged = df.repartitionByRange(partitions or range_partitions(df), *keys)
    placed = materialize(
        ranged.sortWithinPartitions(*keys)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__place", F.monotonically_increasing_id()),
        "ranges",
    )
    placed = placed.withColumn("__line", F.col("__place"))
    return _numbered(placed, [by] if by else [], [], "__part", "__line", name).select(name, *df.columns)


def _numbered(
    placed: DataFrame, by: list[str], order: list[str], task: str, line: str, name: str
) -> DataFrame:
    """Number rows that lie in runs of one ``by``, ``order`` and ``task``."""
    keys = [*by, *order, task]
    runs = placed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        F.min("__place").alias("__first"),
        F.max("__place").alias("__last"),
        F.min(line).alias("__low"),
        F.max(line).alias("__high"),
        F.min_by(line, "__place").alias("__low_placed"),
        F.max_by(line, "__place").alias("__high_placed"),
    )
    # Runs are stored in ranges of their order: sums within a range, then over the ranges.
    runs = materialize(
        runs.repartitionByRange(*by, *order, "__low").withColumn("__range", F.spark_partition_id()), "runs"
    )
    in_range = Window.partitionBy(*by, "__range").orderBy(*order, "__low")
    in_block = Window.partitionBy(*by, *order).orderBy("__low")
    over_ranges = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before_range = F.coalesce(F.sum("__total").over(over_ranges), F.lit(0))
    ranges = runs.groupBy(*by, "__range").agg(F.sum("__n").alias("__total")).select(
        *[F.col(k).alias(f"__of_{k}") for k in by], F.col("__range").alias("__of_range"), before_range.alias("__before")
    )
    sound = (
        (F.col("__last") - F.col("__first") + 1 == F.col("__n"))
        & (F.col("__low") == F.col("__low_placed"))
        & (F.col("__high") == F.col("__high_placed"))
        & (F.col("__low") > F.coalesce(F.lag("__high").over(in_block), F.col("__low") - 1))
    )
    within = F.coalesce(F.sum("__n").over(in_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed_runs = runs.select("*", sound.alias("__sound"), within.alias("__within"))
    of_range = F.col("__range") == F.col("__of_range")
    for k in by:
        of_range = of_range & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    starts = placed_runs.join(ranges, of_range).select(
        *[F.col(k).alias(f"__run_{k}") for k in keys],
        "__first",
        F.when(F.col("__sound"), F.col("__before") + F.col("__within"))
        .otherwise(F.raise_error(F.lit("rows of one block are not contiguous")).cast("long"))
        .alias("__start"),
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__run_{k}"))
    return placed.join(broadcast_if_small(starts, of=runs), same).withColumn(
        name, F.col("__start") + F.col("__place") - F.col("__first")
    )
