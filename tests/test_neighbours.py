"""Searches that leave pairs out: by cells with bounds (exact), by a neighbour graph (approximate)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from shelfmark.operators import neighbours, pruned
from shelfmark.operators import similarity as S


def clustered(n=3000, dim=16, clusters=30, noise=0.05, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, dim))
    return (centres[rng.integers(0, clusters, n)] + noise * rng.standard_normal((n, dim))).astype(np.float32)


def frame(spark, matrix, first=0):
    rows = [(first + i, None if v is None else [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "row_id long, embedding array<float>").repartition(3)


def hits(df):
    return sorted((r.query_id, r["rank"], r.row_id, str(r.sim)) for r in df.collect())


def odd(matrix):
    """With copies, zero vectors, a null, a NaN and opposite directions."""
    dim = matrix.shape[1]
    return [*matrix, *matrix[:40], *matrix[:40], *[np.zeros(dim)] * 7, None, [float("nan")] * dim, *-matrix[:20], *5 * matrix[:20]]


@pytest.mark.parametrize("k", [1, 5, 40])
def test_pruned_search_equals_the_exact_one(spark, k):
    corpus = frame(spark, odd(clustered(600)))
    queries = frame(spark, odd(clustered(150, seed=2)), first=10_000)
    for cells in (1, 12, 64):
        got = pruned.pruned_knn(queries, corpus, k, cells=cells, worthwhile=1.0)
        assert hits(got) == hits(S.knn(queries, corpus, k))


def test_cells_are_cut_into_blocks(spark):
    corpus = frame(spark, odd(clustered(300, clusters=3)))
    got = pruned.pruned_knn(corpus, corpus, 3, cells=4, block_bytes=16 * 8 * 20, worthwhile=1.0)
    assert hits(got) == hits(S.knn(corpus, corpus, 3))


def test_clustered_vectors_skip_most_pairs(spark):
    table = frame(spark, clustered())
    search = pruned.CellSearch(table, table, 5, 60)
    assert search.share < 0.1
    assert hits(search.hits()) == hits(S.knn(table, table, 5))


def test_few_rows_and_none(spark):
    for rows in ([], [None, None], [np.zeros(4)], [np.ones(4)] * 3):
        table = frame(spark, rows)
        assert hits(pruned.pruned_knn(table, table, 5, worthwhile=1.0)) == hits(S.knn(table, table, 5))
    for rows in ([], [np.zeros(4)], [np.ones(4)] * 3, [np.ones(4), None, -np.ones(4)]):
        table = frame(spark, rows)
        assert hits(neighbours.graph_knn(table, 5)) == hits(S.knn(table, table, 5))


def test_graph_finds_clustered_neighbours(spark):
    matrix = clustered(2500, dim=24, clusters=40, noise=0.3)
    table = frame(spark, matrix)
    found, exact = neighbours.graph_knn(table, 5), S.knn(table, table, 5)
    assert S.recall(found, exact).first().recall >= 0.95
    sims = {(r.query_id, r.row_id): r.sim for r in S.knn(table, table, len(matrix)).collect()}
    rows = found.collect()
    assert len(rows) == 5 * len(matrix)
    assert all(r.sim == pytest.approx(sims[r.query_id, r.row_id], abs=1e-8) for r in rows)


def test_graph_with_a_third_of_copies(spark):
    matrix = clustered(400, noise=0.2)
    rows = [*matrix, *[matrix[7]] * 200]
    found = pd.DataFrame([r.asDict() for r in neighbours.graph_knn(frame(spark, rows), 5).collect()])
    assert len(found) == 5 * len(rows)
    copies = found[found["query_id"].isin([7, *range(400, 600)])]
    # All copies get the first five of them, in order.
    assert (copies.groupby("query_id")["row_id"].apply(list).map(tuple) == (7, 400, 401, 402, 403)).all()
    assert (copies["sim"].round(6) == 1).all()


def test_graph_refuses_repeated_positions(spark):
    with pytest.raises(ValueError, match="several rows"):
        neighbours.graph_knn(frame(spark, [np.ones(3)]).union(frame(spark, [np.ones(3)])))


def test_tops_of_tasks_meet_in_groups(spark):
    matrix = clustered(300)
    queries, corpus = frame(spark, matrix[:20]), frame(spark, matrix).repartition(90)
    got = S.knn(queries, corpus, 5, broadcast_bytes=20 * 16 * 8)
    assert hits(got) == hits(S.knn(queries, corpus, 5))


def test_a_query_is_moved_once_for_a_stretch_of_cells(spark):
    """Vectors without structure visit every cell, and are not copied for each of them."""
    rng = np.random.default_rng(5)
    table = frame(spark, rng.standard_normal((400, 32)).astype(np.float32))
    search = pruned.CellSearch(table, table, 3, 40)
    assert search.share > 0.9
    first, parts = pruned._stretches(search.pivots, search.count, 100)
    assert int((first + parts).max()) <= 8  # 400 rows in stretches of 100, not full ones at worst
    held = np.bincount(first[parts == 1], search.count[parts == 1])
    assert held.max() <= 100
    assert hits(search.hits()) == hits(S.knn(table, table, 3))


@pytest.fixture
def recall_of(spark, tmp_path):
    from shelfmark.plans.queries import graph_knn_recall

    def run(vectors):
        table = frame(spark, vectors).withColumnRenamed("row_id", "vec_id")
        folder = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        table.write.parquet(f"{folder}/embeddings.parquet")
        return graph_knn_recall(spark, folder).first().asDict()

    return run


def test_recall_does_not_list_all_pairs(monkeypatch, recall_of):
    """The exact search hands on the nearest rows of a query, not the whole table for each."""
    listed, search = [], S.knn

    def counted(*args, **kwargs):
        hits = search(*args, **kwargs)
        listed.append(hits.count())
        return hits

    monkeypatch.setattr(S, "knn", counted)
    assert recall_of(clustered(300, noise=0.3)) == {"n_exact": 1500, "n_inexact": 0, "finds_most": True, "scores_few": True}
    assert listed == [1500]


def test_recall_checks_every_similarity_found(spark, monkeypatch, recall_of):
    """Also those that are not among the nearest, with odd vectors, and by less than a millionth."""
    rows = odd(clustered(200, noise=0.3))
    n = len(rows)
    assert recall_of(rows)["n_inexact"] == 0
    given = [(0, 0, 1.0), (0, 150, 0.5), (1, 1, 1.0 + 2e-9), (2, 2, float("nan")), (n - 21, 3, 0.1)]
    sims = {(r.query_id, r.row_id): r.sim for r in S.knn(frame(spark, rows), frame(spark, rows), n).where("query_id = 5").collect()}
    exact = [(q, r, sim) for (q, r), sim in sims.items()]
    found = spark.createDataFrame([*given, *exact], "query_id long, row_id long, sim double")
    monkeypatch.setattr(neighbours, "graph_knn", lambda table: found)
    assert recall_of(rows)["n_inexact"] == 4


def test_pair_cosines(spark):
    matrix = [*clustered(20), None, np.zeros(16)]
    table = frame(spark, matrix)
    pairs = spark.createDataFrame([(0, 1), (0, 0), (0, 20), (20, 20), (0, 21), (7, 3)], "query_id long, row_id long")
    got = {(r.query_id, r.row_id): r.exact for r in S.pair_cosines(pairs, table, table).collect()}
    unit = [None if v is None else v / (np.linalg.norm(v) or 1) for v in (None if v is None else np.asarray(v, float) for v in matrix)]
    for (q, r), exact in got.items():
        wanted = np.nan if unit[q] is None or unit[r] is None else unit[q] @ unit[r]
        assert exact == pytest.approx(wanted, abs=1e-11, nan_ok=True)
    assert len(got) == 6


def members(rng, n, fresh=0.3):
    """Lists of members as a local join gets them."""
    sketches = rng.integers(0, 2**63, (200, neighbours.BITS // 64), dtype=np.uint64)
    worst = rng.integers(240, 270, 200)
    return [
        [(int(i), sketches[i].tobytes(), int(worst[i]), bool(rng.random() < fresh)) for i in rng.choice(200, rng.integers(1, 97), replace=False)]
        for _ in range(n)
    ]


NEAR = "near array<struct<id: long, sketch: binary, worst: int, fresh: boolean>>"


def test_local_join_compares_every_pair_with_a_fresh_member(spark):
    lists = members(np.random.default_rng(3), 12)
    wanted = set()
    for near in lists:
        for a, left, worst, new in near:
            for b, right, _, newer in near:
                distance = (int.from_bytes(left) ^ int.from_bytes(right)).bit_count()
                if a != b and (new or newer) and distance < worst:
                    wanted.add((a, b, distance))
    found = neighbours._local_join(spark.createDataFrame([(near,) for near in lists], NEAR), 200).collect()
    assert {tuple(r) for r in found} == wanted and wanted


def test_lists_go_to_python_in_short_batches(spark):
    """A list has some 100 sketches, and 10,000 of them would be held by each task at once."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    lists = spark.range(0, 4000, 1, 1).selectExpr("transform(sequence(1, 96), x -> struct(id + x AS id, cast(repeat('a', 64) AS binary) AS sketch, 5 AS worst, true AS fresh)) AS near")
    neighbours._local_join(lists, 48)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    assert max(r.bytes for r in lists.mapInArrow(sizes, "bytes long").collect()) <= 5 << 20


def test_closest_edges_are_told_once(spark):
    rng = np.random.default_rng(4)
    distance = rng.integers(0, 30, (6, 40))
    edges = [(int(a), int(b), int(distance[a, b]), bool(rng.random() < 0.5)) for a, b in zip(rng.integers(0, 6, 900), rng.integers(0, 40, 900))]
    told = pd.DataFrame(edges, columns=["row_id", "other", "distance", "fresh"]).groupby(["row_id", "other", "distance"], as_index=False)["fresh"].min()
    best = told.sort_values(["row_id", "distance", "other"]).groupby("row_id").head(7)
    found = neighbours._closest(spark.createDataFrame(edges, "row_id long, other long, distance int, fresh boolean").repartition(5), 7).collect()
    assert sorted(map(tuple, found)) == sorted(tuple(r) for r in best.itertuples(index=False))


def test_blocks_of_parts_with_and_without_vectors(spark):
    """Sides of a block are gathered from batches, of which one may hold nulls only."""
    parts = [(np.arange(2), np.zeros((2, 0))), (np.arange(2, 5), np.ones((3, 4))), (np.arange(5, 6), np.zeros((1, 0)))]
    ids, units = S._gathered(iter(parts), 6)
    assert ids.tolist() == [0, 1, 2, 3, 4, 5]
    assert np.isnan(units[[0, 1, 5]]).all() and (units[2:5] == 1).all() and units.shape == (6, 4)
    corpus = frame(spark, [*[None] * 50, *odd(clustered(300, noise=0.2))])
    cut = S.knn(corpus, corpus, 5, broadcast_bytes=0, block_bytes=16 * 8 * 90)
    assert hits(cut) == hits(S.knn(corpus, corpus, 5))
