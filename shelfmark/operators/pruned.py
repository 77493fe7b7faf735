"""Exact k-NN that leaves out cells which cannot hold a neighbour.

The corpus is dealt to cells by the closest of a few pivots, which are drawn from it and lie
far from each other. A cell is a ball: its pivot and the largest angle to it. Angles keep the
triangle inequality, so no row of a cell is closer to a query than the query's angle to the
pivot less the radius. A query first searches the cell of its closest pivot; the k-th
similarity found there is what another cell must be able to reach to be visited. Cells that lie
near each other make a stretch, about as large as a block: a query is moved once for each
stretch in which it visits a cell, however many they are, a corpus row once for each block of its
stretch's visitors. Where nearly all cells are to be visited, as with vectors without any
structure, the search by blocks takes over; the result is the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.vectors import as_matrix, unit_rows
from shelfmark.operators.similarity import BLOCK_BYTES, TOP_K, _Best, _as_long, _block, _check_positions, _ranked_hits, _search, _size_of, knn
from shelfmark.session import materialize

# Cells at most, and rows for each of them that pivots are chosen from: both pass the driver.
MOST_CELLS = 1024
DRAWN = 4
# Rounding of angles, and of similarities that are compared at nine decimals.
SLACK = 1e-6
# Tasks a core that a search in stretches is cut into, and queries whose cells are told at a time.
TASKS_A_CORE, TOLD = 4, 4_096
# Share of pairs beyond which blocks are searched without pivots.
WORTHWHILE = 0.05

_HITS = "query_id long, row_id long, sim double, rank int"


def _directed(units: np.ndarray) -> np.ndarray:
    """Whether a vector has a direction: zero, null and NaN have none."""
    return np.abs(np.einsum("ij,ij->i", units, units) - 1) < 1e-3


def pivots_of(corpus: DataFrame, cells: int) -> np.ndarray:
    """Unit vectors of up to ``cells`` rows, each as far as can be from those before it,
    among ``DRAWN`` times as many that are drawn by a hash of their position."""
    drawn = corpus.where(F.col("embedding").isNotNull()).orderBy(F.xxhash64("row_id"), "row_id").limit(DRAWN * cells)
    held = drawn.select("embedding").toArrow()
    units = unit_rows(as_matrix(held["embedding"])) if held.num_rows else np.zeros((0, 1))
    units = units[_directed(units)]
    closest, chosen = np.full(len(units), -2.0), []
    while len(chosen) < cells and len(units) and closest.min() < 1 - SLACK:
        chosen.append(int(closest.argmin()))
        closest = np.maximum(closest, units @ units[chosen[-1]])
    return units[chosen]


def _schema(table: DataFrame, more: str) -> str:
    return f"row_id {table.schema['row_id'].dataType.simpleString()}, embedding {table.schema['embedding'].dataType.simpleString()}, {more}"


def _placed(table: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Rows with their cell and the angle to its pivot. Rows without a direction have the cell
    after the last."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = unit_rows(as_matrix(batch.column("embedding")))
            if not len(units):
                continue
            cosines = units @ pivots.T
            cell = np.argmax(cosines, axis=1).astype(np.int32)
            angle = np.arccos(np.clip(cosines[np.arange(len(units)), cell], -1, 1))
            cell[~_directed(units)] = len(pivots)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(angle)], ["row_id", "embedding", "cell", "angle"])

    return table.select("row_id", "embedding").mapInArrow(place, _schema(table, "cell int, angle double"))


def _cells_to_visit(units: np.ndarray, own: np.ndarray, floor: np.ndarray, pivots: np.ndarray, radius: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For each query and cell whether the cell may hold one of its nearest rows; its own cell,
    which it has searched, does not count."""
    angle = np.arccos(np.clip(units @ pivots.T, -1, 1))
    go = np.ones((len(units), len(count)), bool)
    go[:, :-1] = np.cos(np.clip(angle - radius - SLACK, 0, math.pi)) >= floor[:, None] - SLACK
    go[~_directed(units)] = True
    go &= count > 0
    go[np.arange(len(units)), own] = False
    return go


def _work(queries: DataFrame, pivots: np.ndarray, radius: np.ndarray, count: np.ndarray) -> DataFrame:
    """The pairs of rows that visits make, in parts."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                units = unit_rows(as_matrix(batch.column("embedding")))
                go = _cells_to_visit(units, batch.column("cell").to_numpy(), batch.column("floor").to_numpy(), pivots, radius, count)
                yield pa.RecordBatch.from_arrays([pa.array([int((go * count).sum())])], ["work"])

    return queries.select("row_id", "embedding", "cell", "floor").mapInArrow(tell, "work long")


def _chained(pivots: np.ndarray) -> list[int]:
    """All cells, each followed by the nearest one that is left; the one without direction last."""
    left, chain = np.ones(len(pivots), bool), [0]
    left[0] = False
    while left.any():
        chain.append(int(np.where(left, pivots @ pivots[chain[-1]], -np.inf).argmax()))
        left[chain[-1]] = False
    return [*chain, len(pivots)]


def _stretches(pivots: np.ndarray, count: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each cell its first stretch and over how many its rows are dealt: neighbouring cells
    share one up to ``most`` rows, a cell of more is cut into several of its own."""
    first, parts = np.zeros(len(count), np.int32), np.ones(len(count), np.int32)
    at, held = 0, 0
    for cell in _chained(pivots):
        if held and held + count[cell] > most:
            at, held = at + 1, 0
        first[cell], parts[cell] = at, max(-(-count[cell] // most), 1)
        at, held = (at + parts[cell], 0) if parts[cell] > 1 else (at, held + count[cell])
    return first, parts


def _searched_away(queries: DataFrame, corpus: DataFrame, pivots: np.ndarray, radius: np.ndarray, count: np.ndarray, k: int, most: int) -> DataFrame:
    """The best ``k`` of the cells that each query ``(row_id, embedding, cell, floor)`` visits,
    for each stretch and block of its visitors."""
    first, parts = _stretches(pivots, count, most)
    n = int((first + parts).max())

    def go_to(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds = np.zeros((len(count), n), bool)  # which stretches a cell's rows are in
        for cell in range(len(count)):
            holds[cell, first[cell] : first[cell] + parts[cell]] = True
        for whole in batches:
            for start in range(0, whole.num_rows, TOLD):
                batch = whole.slice(start, TOLD)
                units = unit_rows(as_matrix(batch.column("embedding")))
                go = _cells_to_visit(units, batch.column("cell").to_numpy(), batch.column("floor").to_numpy(), pivots, radius, count)
                at, stretch = np.nonzero(go @ holds)
                for there in range(0, len(at), 8_192):
                    here = slice(there, there + 8_192)
                    rows = batch.select(["row_id", "embedding", "cell", "floor"]).take(pa.array(at[here]))
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(stretch[here].astype(np.int32))], ["row_id", "embedding", "cell", "floor", "stretch"])

    asked = queries.select("row_id", "embedding", "cell", "floor")
    visits = materialize(asked.mapInArrow(go_to, _schema(queries, "cell int, floor double, stretch int")), "visits")
    asking = np.zeros(n, np.int64)
    for r in visits.groupBy("stretch").count().collect():  # a row per stretch
        asking[r.stretch] = r["count"]
    spark = visits.sparkSession
    blocks = F.broadcast(spark.createDataFrame([(i, int(max(-(-q // most), 1))) for i, q in enumerate(asking)], "stretch int, n_q int"))
    places = F.broadcast(spark.createDataFrame([(i, int(f), int(p)) for i, (f, p) in enumerate(zip(first, parts, strict=True))], "cell int, __first int, __parts int"))
    placed = corpus.join(places, "cell").withColumn("stretch", F.col("__first") + F.pmod(F.xxhash64("row_id"), "__parts").cast("int"))
    columns = ["stretch", "q_block", "row_id", "embedding", "cell"]
    rows = (
        visits.join(blocks, "stretch")
        .withColumn("q_block", F.pmod(F.xxhash64("row_id"), "n_q").cast("int"))
        .select(*columns, "floor", F.lit(True).alias("asks"))
        .unionByName(
            placed.join(blocks, "stretch")
            .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.col("n_q") - 1)))
            .select(*columns, F.lit(0.0).alias("floor"), F.lit(False).alias("asks"))
        )
    )

    def search(table: pa.Table) -> pa.Table:
        (ids, units, own, floor), (row_ids, rows, cells, _) = (
            (*_block(*[side[c].combine_chunks() for c in ("row_id", "embedding")]), side["cell"].to_numpy(), side["floor"].to_numpy())
            for side in (table.filter(table["asks"]), table.filter(pc.invert(table["asks"])))
        )
        schema = pa.schema([("query_id", pa.int64()), ("row_id", pa.int64()), ("sim", pa.float64()), ("rank", pa.int32())])
        if not len(ids) or not len(row_ids):
            return pa.Table.from_batches([], schema)
        dim = max(units.shape[1], rows.shape[1])  # null vectors only do not know how long they are
        units, rows = _as_long(units, dim), _as_long(rows, dim)
        go = np.zeros((len(ids), len(count)), bool)
        for start in range(0, len(ids), TOLD):
            here = slice(start, start + TOLD)
            go[here] = _cells_to_visit(units[here], own[here], floor[here], pivots, radius, count)
        order = np.lexsort((row_ids, cells))
        row_ids, rows, cells = row_ids[order], rows[order], cells[order]
        best = _Best(ids, units, k, floor=floor)
        found, starts = np.unique(cells, return_index=True)
        for cell, start, stop in zip(found, starts, [*starts[1:], len(cells)], strict=True):
            visitors = np.flatnonzero(go[:, cell])
            for at in range(start, stop if len(visitors) else start, 8_192):
                here = slice(at, min(at + 8_192, stop))
                best.add(row_ids[here], rows[here], visitors)
        return pa.Table.from_batches(best.batches(), schema)

    return rows.repartition(int(np.maximum(-(-asking // most), 1).sum()), "stretch", "q_block").groupBy("stretch", "q_block").applyInArrow(search, _HITS)


def _searched(visits: DataFrame, corpus: DataFrame, count: np.ndarray, k: int, per_block: int) -> DataFrame:
    """The best ``k`` of each cell, for each of its visitors. A crowded cell is cut into blocks
    on both sides."""
    asking = np.zeros(len(count), np.int64)
    for r in visits.groupBy("cell").count().collect():  # a row per cell
        asking[r.cell] = r["count"]
    blocks = [(i, int(max(-(-q // per_block), 1)), int(max(-(-c // per_block), 1))) for i, (q, c) in enumerate(zip(asking, count, strict=True))]
    sizes = F.broadcast(visits.sparkSession.createDataFrame(blocks, "cell int, n_q int, n_c int"))

    def own(n: str) -> Column:
        return F.pmod(F.xxhash64("row_id"), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    sides = [
        side.join(sizes, "cell").select("cell", q.alias("q_block"), c.alias("c_block"), "row_id", "embedding", F.lit(asks).alias("asks"))
        for side, q, c, asks in ((visits, own("n_q"), every("n_c"), True), (corpus, every("n_q"), own("n_c"), False))
    ]

    def search(table: pa.Table) -> pa.Table:
        asked, held = (
            _block(*[side[c].combine_chunks() for c in ("row_id", "embedding")]) for side in (table.filter(table["asks"]), table.filter(pc.invert(table["asks"])))
        )
        schema = pa.schema([("query_id", pa.int64()), ("row_id", pa.int64()), ("sim", pa.float64()), ("rank", pa.int32())])
        return pa.Table.from_batches(_search(asked, iter([held]), k) if len(asked[0]) and len(held[0]) else [], schema)

    return sides[0].unionByName(sides[1]).groupBy("cell", "q_block", "c_block").applyInArrow(search, _HITS)


class CellSearch:
    """The steps of a pruned search, up to where it is known what remains to be searched."""

    def __init__(self, queries: DataFrame, corpus: DataFrame, k: int, cells: int, block_bytes: int = BLOCK_BYTES):
        self.k, self.share = k, 1.0
        self.pivots = pivots_of(corpus, cells)
        if not len(self.pivots):
            return
        n = len(self.pivots) + 1
        self.per_block = max(block_bytes // (self.pivots.shape[1] * 8), 1)
        self.corpus = materialize(_placed(corpus, self.pivots), "cells")
        self.count, self.radius = np.zeros(n, np.int64), np.zeros(n - 1)
        for r in self.corpus.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("angle")).collect():  # a row per cell
            self.count[r.cell] = r.n
            if r.cell < n - 1:
                self.radius[r.cell] = r.angle
        asked = materialize(_placed(queries, self.pivots), "asked")
        self.home = materialize(_searched(asked, self.corpus, self.count, k, self.per_block), "home")
        # A home cell of several blocks: the k-th best is over all of them.
        kth = _ranked_hits(self.home, k).where((F.col("rank") == k) & ~F.isnan("sim")).select(F.col("query_id").alias("row_id"), F.col("sim").alias("floor"))
        self.queries = materialize(asked.join(kth, "row_id", "left").withColumn("floor", F.coalesce("floor", F.lit(-1.0))), "floors")
        rows = np.zeros(n, np.int64)
        for r in self.queries.groupBy("cell").count().collect():  # a row per cell
            rows[r.cell] = r["count"]
        away = _work(self.queries, self.pivots, self.radius, self.count).agg(F.sum("work")).first()[0] or 0
        self.asking = int(rows.sum())
        self.share = (int((rows * self.count).sum()) + away) / max(int(rows.sum() * self.count.sum()), 1)

    def hits(self) -> DataFrame:
        # Enough pairs of blocks for all cores.
        cores = self.corpus.sparkSession.sparkContext.defaultParallelism
        most = max(min(self.per_block, math.ceil(math.sqrt(self.asking * int(self.count.sum()) / (TASKS_A_CORE * cores)))), 1)
        away = _searched_away(self.queries, self.corpus, self.pivots, self.radius, self.count, self.k, most)
        return _ranked_hits(self.home.unionByName(away).drop("rank"), self.k)


def pruned_knn(
    queries: DataFrame, corpus: DataFrame, k: int = TOP_K, cells: int | None = None, block_bytes: int = BLOCK_BYTES, worthwhile: float = WORTHWHILE
) -> DataFrame:
    """The exact ``k`` nearest corpus rows of every query, ``(query_id, row_id, sim, rank)``,
    as :func:`similarity.knn` returns them. ``cells`` defaults to a cell for 64 rows,
    ``MOST_CELLS`` at most. With over ``worthwhile`` of all pairs left, ``knn`` does it."""
    n_corpus, _ = _size_of(corpus)
    _check_positions(corpus)
    _check_positions(queries)
    search = CellSearch(queries, corpus, k, cells or min(max(n_corpus // 64, 1), MOST_CELLS), block_bytes)
    if not len(search.pivots) or search.share > worthwhile:
        return knn(queries, corpus, k)
    return search.hits()
