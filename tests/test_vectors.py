from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.functions import vectors as V
from shelfmark.operators import similarity as S
from shelfmark.sources.tables import matrix_shape

NAN = float("nan")


def table(spark, rows):
    return spark.createDataFrame(rows, "row_id long, embedding array<float>")


def random_table(spark, n, dim=8, seed=0):
    rng = np.random.default_rng(seed)
    m = rng.standard_normal((n, dim)).astype("float32")
    m[: n // 3] = m[0]  # copies of one vector make up a third of all rows
    m[-1] = 0
    return m, table(spark, [(i, [float(x) for x in v]) for i, v in enumerate(m)]).repartition(3)


def brute_force(queries, corpus, k):
    """Dot products one by one; ties by position."""

    def unit(m):
        m = m.astype("float64")
        return m / (np.sqrt((m * m).sum(axis=1)) + 1e-12)[:, None]

    q, c = unit(queries), unit(corpus)
    out = set()
    for i, v in enumerate(q):
        sims = [round(float(sum(a * b for a, b in zip(v, w))), 9) for w in c]
        best = sorted(range(len(c)), key=lambda j: (-sims[j], j))[:k]
        out |= {(i, j, round(sims[j], 7) + 0.0, r + 1) for r, j in enumerate(best)}
    return out


def rows(hits):
    return {(r.query_id, r.row_id, round(r.sim, 7) + 0.0, r.rank) for r in hits.collect()}


def test_norm_and_normalize(spark):
    df = table(spark, [(0, [3.0, 4.0]), (1, [0.0, 0.0]), (2, None), (3, [NAN, 1.0])])
    got = df.select("row_id", V.norm(F.col("embedding")).alias("n"), V.normalize(F.col("embedding")).alias("u")).orderBy("row_id").collect()
    assert got[0].n == 5.0 and got[0].u == pytest.approx([0.6, 0.8])
    assert got[1].n == 0.0 and got[1].u == [0.0, 0.0]
    assert got[2].n is None and got[2].u is None
    assert np.isnan(got[3].n) and all(np.isnan(got[3].u))


def test_normalized_twice_is_normalized(spark):
    _, df = random_table(spark, 50)
    once = df.withColumn("embedding", V.normalize(F.col("embedding")))
    twice = once.select("row_id", V.norm(V.normalize(F.col("embedding"))).alias("n"))
    for r in twice.collect():
        assert r.n == (0.0 if r.row_id == 49 else pytest.approx(1.0, abs=1e-6))


def test_unequal_lengths_fail(spark):
    df = table(spark, [(0, [1.0, 2.0]), (1, [1.0])]).coalesce(1)
    with pytest.raises(Exception, match="unequal length"):
        matrix_shape(df).collect()
    with pytest.raises(Exception, match="unequal length"):
        df.select(V.norm(F.col("embedding"))).collect()


def test_shape(spark):
    _, df = random_table(spark, 20)
    assert tuple(matrix_shape(df).first()) == (20, 8)


def test_top_k_orders_ties_and_nan(spark):
    df = table(spark, [(0, [1.0, 0.0]), (1, [NAN, 0.0]), (2, [0.0, 0.0]), (3, [2.0, 0.0]), (4, [-1.0, 0.0]), (5, None)])
    got = S.top_k(df, 0, 10).orderBy("rank").collect()
    assert [r.row_id for r in got] == [0, 3, 2, 4, 1, 5]
    assert [r["rank"] for r in got] == [1, 2, 3, 4, 5, 6]
    assert got[0].sim == pytest.approx(1.0) and got[3].sim == pytest.approx(-1.0) and np.isnan(got[4].sim)
    assert S.top_k(df, 0, 2).count() == 2


def test_query_row_must_exist_once(spark):
    df = table(spark, [(0, [1.0]), (1, [1.0]), (1, [2.0])])
    for bad in (1, 9):
        with pytest.raises(ValueError, match="row_id"):
            S.top_k(df, bad)


WAYS = {
    "corpus": {},
    "queries": {"broadcast_bytes": 64 * 20},  # 20 queries fit, the corpus does not
    "blocks": {"broadcast_bytes": 0},
    "small blocks": {"broadcast_bytes": 0, "block_bytes": 64 * 7},
}


@pytest.mark.parametrize("way", WAYS)
def test_knn_is_exact_every_way(spark, way):
    m, df = random_table(spark, 90)
    queries = df.where("row_id < 20")
    assert rows(S.knn(queries, df, 5, **WAYS[way])) == brute_force(m[:20], m, 5)


@pytest.mark.parametrize("way", WAYS)
def test_positions_that_restart_per_split(spark, way):
    m, df = random_table(spark, 90)
    queries = df.where("row_id < 20").select(
        F.when(F.col("row_id") < 10, "train").otherwise("test").alias("split"), (F.col("row_id") % 10).alias("row_id"), "embedding"
    )
    hits = S.knn(queries, df, 5, by="split", **WAYS[way])
    got = {(r.query_id + 10 * (r.split == "test"), r.row_id, round(r.sim, 7) + 0.0, r.rank) for r in hits.collect()}
    assert got == brute_force(m[:20], m, 5)
    assert S.recall(hits, hits, by="split").first().recall == 1.0
    with pytest.raises(ValueError, match="several rows"):
        S.knn(df, df.unionAll(df), **WAYS[way])


def test_scored_share_falls_as_the_corpus_grows(spark):
    rng = np.random.default_rng(2)
    m = rng.standard_normal((3000, 16))
    df = table(spark, [(i, [float(x) for x in v]) for i, v in enumerate(m)]).repartition(3)
    queries = df.where("row_id < 50")
    shares = [S.scored_share(queries, df.where(f"row_id < {n}")).first()["share"] for n in (100, 600, 3000)]
    assert shares[0] > 2 * shares[1] > 4 * shares[2]


@pytest.mark.parametrize("way", WAYS)
def test_knn_with_more_neighbours_than_rows(spark, way):
    df = table(spark, [(0, [1.0, 0.0]), (1, [NAN, 1.0]), (2, [0.0, 1.0])])
    got = S.knn(df.where("row_id = 0"), df, 5, **WAYS[way]).orderBy("rank").collect()
    assert [r.row_id for r in got] == [0, 2, 1] and np.isnan(got[2].sim)


def test_knn_of_one_query_is_top_k(spark):
    _, df = random_table(spark, 60, seed=3)
    assert rows(S.knn(df.where("row_id = 0"), df)) == rows(S.top_k(df, 0))


def test_many_blocks_of_candidates(spark):
    # More corpus rows than one inner block, so later blocks meet a raised bar.
    rng = np.random.default_rng(5)
    m = rng.integers(-2, 3, (20_000, 4)).astype("float64")
    q = m[:3]
    best = S._Best(np.arange(3), V.unit_rows(q), 7)
    for start in range(0, len(m), 3000):
        best.add(np.arange(start, min(start + 3000, len(m))), V.unit_rows(m[start : start + 3000]))
    got = {(int(a), int(b)) for a, b in zip(best.query, best.row)}
    assert got == {(i, j) for i, j, _, _ in brute_force(q, m, 7)}


def test_empty_sides(spark):
    _, df = random_table(spark, 9)
    none = df.where("row_id < 0")
    for options in WAYS.values():
        assert S.knn(none, df, **options).count() == 0
        assert S.knn(df, none, **options).count() == 0


def test_approximate_hits_are_exact_and_recall_counts(spark):
    m, df = random_table(spark, 120, seed=1)
    exact = S.knn(df, df)
    sims = {(q, r): s for q, r, s, _ in brute_force(m, m, 120)}
    found = S.approximate_knn(df, df, tables=6, bits=2, block_bytes=64 * 10)
    hits = rows(found)
    assert all(sims[q, r] == pytest.approx(s, abs=2e-7) for q, r, s, _ in hits)
    share = S.recall(found, exact).first()
    assert share.n_exact == 600 and 0.6 < share.recall <= 1.0
    everything = S.approximate_knn(df, df, tables=1, bits=0, probes=0)
    assert S.recall(everything, exact).first().recall == 1.0


def test_plans(spark, tmp_path):
    from conftest import plan_of

    _, df = random_table(spark, 30)
    df.write.parquet(str(tmp_path / "e"))
    stored = spark.read.parquet(str(tmp_path / "e"))
    assert "TakeOrderedAndProject" in plan_of(S.top_k(stored, 0))
    assert "WindowGroupLimit" in plan_of(S.knn(stored, stored, broadcast_bytes=0))
    for options in WAYS.values():
        plan = plan_of(S.knn(stored, stored, **options))
        assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("way", WAYS)
def test_only_the_first_copies_of_a_vector_are_searched(spark, way):
    """A third of the rows are copies of one vector: ``k`` of them do, and the hits are the same."""
    m, df = random_table(spark, 90)
    kept = {r.row_id for r in S.first_copies(df, 5).collect()}
    assert kept == {0, 1, 2, 3, 4, *range(30, 90)}
    assert rows(S.knn(df, df, 5, many_pairs=0, **WAYS[way])) == brute_force(m, m, 5)
    odd = table(spark, [(i, v) for i, v in enumerate([None, [NAN, 1.0], [0.0, 0.0], [-0.0, 0.0], [1.0, 0.0]] * 3)])
    assert rows_or_nan(S.knn(odd, odd, 2, many_pairs=0, **WAYS[way])) == rows_or_nan(S.knn(odd, odd, 2, **WAYS[way]))
    with pytest.raises(ValueError, match="several rows"):
        S.knn(df, df.unionAll(df), many_pairs=0, **WAYS[way])


def rows_or_nan(hits):
    return sorted((r.query_id, r["rank"], r.row_id, str(r.sim)) for r in hits.collect())
