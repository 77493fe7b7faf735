"""Merging a collection across document types and languages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.json import BAD_JSON, TOO_DEEP, with_verdict
from shelfmark.sources.jsonl import position_in


def merge(lines: DataFrame) -> DataFrame:
    """Keep every well-formed line as ``json``, as it is written; duplicates stay.

    ``lines`` comes from ``read_collection`` (or carries a ``line`` column
    already trimmed). Any JSON value is kept, objects or not. Provenance and
    order columns pass through; nothing is shuffled, and good lines do not leave
    the JVM. The text sink re-serialises what it writes.
    """
    kept = with_verdict(lines).where(F.col("verdict") == "ok")
    return kept.withColumn("json", F.col("line")).drop("line", "verdict")


def malformed(lines: DataFrame) -> DataFrame:
    """The lines :func:`merge` leaves out, with all their columns and a ``reason``."""
    return with_verdict(lines, name="reason").where(F.col("reason") != "ok")


def count_by(df: DataFrame, *columns: str, name: str = "n_records") -> DataFrame:
    """Records per value of ``columns``; partial counts are taken before the shuffle."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))


class Tally:
    """Counts of lines by split, type, language and verdict, taken by the job that reads the
    lines anyway: no second scan, no shuffle.

    Each line gets the number of its cell, and a histogram with a bin for every cell is
    observed: with no more values than bins it merges equal values only, so it counts. A
    frame may be watched once; the counts are there when the first job on it has ended.
    """

    VERDICTS = ("ok", BAD_JSON, TOO_DEEP)

    def __init__(self, splits: Sequence[str], doc_types: Sequence[str], langs: Sequence[str]):
        self.axes = {"split": list(splits), "doc_type": list(doc_types), "lang": list(langs), "verdict": list(self.VERDICTS)}
        self.seen = Observation()

    def watch(self, judged: DataFrame) -> DataFrame:
        """The frame, which has a column for each axis, as one that is counted when read."""
        cell, cells = F.lit(0), 1
        for name, values in self.axes.items():
            # One more than the values: what is on none of them is counted too.
            cell = cell * (len(values) + 1) + position_in(F.col(name), values)
            cells *= len(values) + 1
        return judged.observe(self.seen, F.histogram_numeric(cell.cast("double"), F.lit(cells)).alias("cells"))

    def counts(self, spark: SparkSession) -> DataFrame:
        """``(split, doc_type, lang, verdict, n)`` of the cells that have lines; waits for the job."""
        found: dict[int, int] = {}
        for x, y in self.seen.get["cells"] or []:
            found[round(x)] = found.get(round(x), 0) + round(y)
        rows = []
        for cell, n in sorted(found.items()):
            values = []
            for axis in reversed(self.axes.values()):
                cell, at = divmod(cell, len(axis) + 1)
                values.append(axis[at] if at < len(axis) else None)
            rows.append((*reversed(values), n))
        return spark.createDataFrame(rows, "split string, doc_type string, lang string, verdict string, n long")


def merge_watched(lines: DataFrame, tally: Tally) -> DataFrame:
    """:func:`merge`, with all lines counted by what became of them as it is written."""
    judged = tally.watch(with_verdict(lines))
    return judged.where(F.col("verdict") == "ok").withColumn("json", F.col("line")).drop("line", "verdict")
