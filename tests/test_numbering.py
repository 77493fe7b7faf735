from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.numbering import number_lines, number_rows
from shelfmark.sources.jsonl import read_lines


@pytest.mark.parametrize("partitions", [None, 1, 7])
def test_positions_restart_per_group(spark, partitions):
    # One group holds most rows, and one is null.
    df = spark.range(1000).select(
        F.when(F.col("id") < 700, "hot").when(F.col("id") < 990, F.concat(F.lit("g"), F.col("id") % 3)).alias("g"),
        (F.hash("id")).alias("k"), "id",
    )
    got = number_rows(df, ["k", "id"], by="g", partitions=partitions).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.g, []).append((r.row_id, r.k, r.id))
    assert len(got) == 1000 and set(groups) == {"hot", "g0", "g1", "g2", None}
    for rows in groups.values():
        rows.sort()
        assert [r[0] for r in rows] == list(range(len(rows)))
        assert [r[1:] for r in rows] == sorted(r[1:] for r in rows)


def test_positions_over_everything(spark):
    df = spark.range(500).repartition(6).withColumn("k", -F.col("id"))
    got = sorted((r.row_id, r.id) for r in number_rows(df, ["k"], name="row_id").collect())
    assert got == [(i, 499 - i) for i in range(500)]


def test_lines_are_numbered_in_place(spark, tmp_path):
    for name, start, n in (("a", 0, 3000), ("b", 3000, 10), ("c", 3010, 2000)):
        (tmp_path / f"{name}.txt").write_text("\n".join(str(i) for i in range(start, start + n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = read_lines(spark, str(tmp_path)).where(F.col("line").cast("int") % 7 != 3)
        got = [int(r.line) for r in number_lines(lines).orderBy("row_id").collect()]
        ids = [r.row_id for r in number_lines(lines).orderBy("row_id").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [i for i in range(5010) if i % 7 != 3] and ids == list(range(len(got)))


def test_shuffled_lines_are_refused(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n".join(str(i) for i in range(1000)))
    lines = read_lines(spark, str(tmp_path)).repartition(5)
    with pytest.raises(Exception, match="not contiguous"):
        number_lines(lines).collect()
