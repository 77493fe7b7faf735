"""Approximate k-NN of a whole table by a neighbour graph that improves itself.

Every vector gets a sketch: the signs of ``BITS`` random projections, in which the share of
unequal bits estimates the angle. The graph starts from neighbours in sorted order: the table
is sorted by its sketches, each time from another byte on, and rows are compared with those in
their block of the order. Then rounds of local joins: the neighbours of a row, and a sample of
the rows that it is a neighbour of, are compared with each other, since a neighbour's neighbour
is often one. A pair is compared again only if one of its edges is new, and handed on only if
it is better than the worst that one of its rows has. Rounds end when few edges change. Last,
each row's edges are scored with the vectors themselves.

Rows of equal vectors are one vertex, so that copies do not fill each other's lists; a hit on
it is a hit on its rows, first positions first. A vertex has ``degree`` edges at most and
sketches are all that travels with them, so a round moves some 50 bytes times twice the degree
for each vertex, however long the vectors are. Blocks are runs of a sorted order, not buckets:
a crowded region is cut like any other. All rounds are stored tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.vectors import TIE_DECIMALS, as_matrix, unit_rows
from shelfmark.operators.similarity import TOP_K, best_first
from shelfmark.session import materialize, short_batches

BITS = 512
DEGREE = 48
# Sorted orders that the graph starts from, and rows of a block in them.
ORDERS = 4
BLOCK = 128
# Rounds end when so few of the edges are new, or after so many.
SETTLED = 0.02
MOST_ROUNDS = 12

_EDGES = "row_id long, other long, distance int"


def _rows(vectors: pa.Array, dim: int) -> np.ndarray:
    """A matrix with ``dim`` columns, also where all vectors of the batch are null."""
    matrix = as_matrix(vectors)
    return matrix if matrix.shape[1] == dim else np.full((len(vectors), dim), np.nan)


def _sketch(dim: int, seed: int):
    planes = np.random.default_rng(seed).standard_normal((dim, BITS))

    @F.arrow_udf(T.BinaryType())
    def signs(vectors: pa.Array) -> pa.Array:
        bits = np.packbits(_rows(vectors, dim) @ planes > 0, axis=1)
        return pa.FixedSizeBinaryArray.from_buffers(pa.binary(BITS // 8), len(bits), [None, pa.py_buffer(bits.tobytes())]).cast(pa.binary())

    return signs


@F.arrow_udf(T.DoubleType())
def _cosine(left: pa.Array, right: pa.Array) -> pa.Array:
    a, b = as_matrix(left), as_matrix(right)
    dim = max(a.shape[1], b.shape[1])
    sims = np.einsum("ij,ij->i", unit_rows(_rows(left, dim)), unit_rows(_rows(right, dim)))
    return pa.array(np.round(sims, TIE_DECIMALS) if dim else np.full(len(left), np.nan))


def _words(sketches: pa.Array) -> np.ndarray:
    """Sketches as rows of 64-bit words."""
    held = b"".join(sketches.to_pylist())
    return np.frombuffer(held, np.uint64).reshape(len(sketches), BITS // 64)


def _unequal_bits(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of sketches as rows of 64-bit words: how many bits differ."""
    # A count per word, which is at most 64: eight bytes, added up in four fields of 16 bits.
    counts = np.bitwise_count(left ^ right).view(np.uint64)[..., 0]
    low = np.uint64(0x00FF00FF00FF00FF)
    fields = (counts & low) + ((counts >> np.uint64(8)) & low)
    return ((fields * np.uint64(0x0001000100010001)) >> np.uint64(48)).astype(np.int64)


def _best(rows: np.ndarray, others: np.ndarray, distance: np.ndarray, degree: int) -> pa.RecordBatch:
    """Of each row the ``degree`` closest others, each once."""
    order = np.lexsort((others, distance, rows))
    rows, others, distance = rows[order], others[order], distance[order]
    again = np.concatenate([[False], (rows[1:] == rows[:-1]) & (others[1:] == others[:-1])]) if len(rows) else np.zeros(0, bool)
    rows, others, distance = rows[~again], others[~again], distance[~again]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
    kept = place < degree
    return pa.RecordBatch.from_arrays([pa.array(rows[kept]), pa.array(others[kept]), pa.array(distance[kept].astype(np.int32))], ["row_id", "other", "distance"])


def _start(points: DataFrame, degree: int) -> DataFrame:
    """Edges between rows that stand close in one of the sorted orders."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words = np.zeros(0, np.int64), np.zeros((0, BITS // 64), np.uint64)
        for batch in batches:
            ids = np.concatenate([ids, batch.column("row_id").to_numpy()])
            words = np.concatenate([words, _words(batch.column("sketch"))])
            while len(ids) >= 2 * BLOCK:
                yield block(ids[:BLOCK], words[:BLOCK])
                ids, words = ids[BLOCK // 2 :], words[BLOCK // 2 :]  # blocks overlap by half
        if len(ids) > 1:
            yield block(ids, words)

    def block(ids: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
        distance = _unequal_bits(words[:, None], words[None])
        at, other = np.nonzero(ids[:, None] != ids[None])
        return _best(ids[at], ids[other], distance[at, other], degree)

    step = BITS // 8 // ORDERS
    turned = [F.concat(F.substring("sketch", 1 + n * step, BITS // 8), F.substring("sketch", 1, n * step)) for n in range(ORDERS)]
    placed = points.select("row_id", "sketch", F.posexplode(F.array(*turned)).alias("order", "key"))
    ranged = placed.repartitionByRange("order", "key", "row_id").sortWithinPartitions("order", "key", "row_id")
    return ranged.select("row_id", "sketch").mapInArrow(compare, _EDGES)


def _closest(edges: DataFrame, degree: int) -> DataFrame:
    """The ``degree`` closest edges of each row; an edge that was there before is not fresh."""
    # All of an edge have one distance, so they share a place, and rows are dealt out once.
    order = Window.partitionBy("row_id").orderBy("distance", "other")
    near = edges.repartition("row_id").withColumn("place", F.dense_rank().over(order)).where(F.col("place") <= degree)
    return near.groupBy("row_id", "other").agg(F.min("distance").alias("distance"), F.min("fresh").alias("fresh"))


def _lists(graph: DataFrame, points: DataFrame, degree: int, round_no: int) -> DataFrame:
    """Each row's neighbours with their sketches, and the worst distance that each of them has."""
    back = graph.select(F.col("other").alias("node"), F.col("row_id").alias("id"), "fresh")
    # A sample of those that point here, drawn in two steps, so that a hub is never one group.
    chance = F.xxhash64("id", "node", F.lit(round_no))
    for keys in (["node", F.spark_partition_id()], ["node"]):
        order = Window.partitionBy(*keys).orderBy(chance)
        back = back.withColumn("place", F.row_number().over(order)).where(F.col("place") <= degree).drop("place")
    ahead = graph.select(F.col("row_id").alias("node"), F.col("other").alias("id"), "fresh")
    lists = ahead.unionByName(back).groupBy("node", "id").agg(F.max("fresh").alias("fresh"))
    worst = graph.groupBy("row_id").agg(F.max("distance").alias("worst"), F.count(F.lit(1)).alias("n"))
    known = points.join(worst, "row_id").select(
        F.col("row_id").alias("id"), "sketch", F.when(F.col("n") < degree, F.lit(BITS + 1)).otherwise(F.col("worst")).alias("worst")
    )
    grouped = lists.join(known, "id").groupBy("node").agg(F.collect_list(F.struct("id", "sketch", "worst", "fresh")).alias("near"))
    return grouped.where(F.exists("near", lambda x: x["fresh"])).select("near")


def _local_join(lists: DataFrame, degree: int) -> DataFrame:
    """Pairs within each list, one of them fresh, that better the worst of one of them."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                yield improve(batch.column("near").slice(start, 256))

    def improve(near: pa.ListArray) -> pa.RecordBatch:
        held = near.flatten()
        sizes = near.value_lengths().to_numpy()
        ends = np.cumsum(sizes)
        fresh = held.field("fresh").to_numpy(zero_copy_only=False)
        # Fresh members stand first in their list, and each is compared with those behind it.
        order = np.lexsort((~fresh, np.repeat(np.arange(len(sizes)), sizes)))
        n_fresh = np.diff(np.concatenate([[0], np.cumsum(fresh)])[np.concatenate([[0], ends])])
        ids, worst = held.field("id").to_numpy()[order], held.field("worst").to_numpy()[order]
        words = _words(held.field("sketch"))[order]
        longest = int(sizes.max(initial=0))
        real = np.arange(longest) < sizes[:, None]
        at = np.where(real, ends[:, None] - sizes[:, None] + np.arange(longest), 0)
        rows, others, distances = [], [], []
        for x in range(int(n_fresh.max(initial=0))):
            some = np.flatnonzero(n_fresh > x)
            own, behind = at[some, x, None], at[some, x + 1 :]
            distance = _unequal_bits(words[own], words[behind])
            apart = real[some, x + 1 :] & (ids[own] != ids[behind])
            for row, other in ((own, behind), (behind, own)):
                good = np.nonzero(apart & (distance < worst[row]))
                rows.append(ids[np.broadcast_to(row, distance.shape)[good]])
                others.append(ids[np.broadcast_to(other, distance.shape)[good]])
                distances.append(distance[good])
        none = np.zeros(0, np.int64)
        return _best(*(np.concatenate([none, *part]) for part in (rows, others, distances)), degree)

    return short_batches(lists).mapInArrow(compare, _EDGES)


def neighbour_graph(points: DataFrame, degree: int = DEGREE, settled: float = SETTLED, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """``(row_id, other, distance)``: the closest other rows found for each row of
    ``(row_id, sketch)``, a stored table with unique rows and few equal sketches."""
    graph = materialize(_closest(_start(points, degree).withColumn("fresh", F.lit(True)), degree), "graph")
    for round_no in range(most_rounds):
        better = _local_join(_lists(graph, points, degree, round_no), degree).withColumn("fresh", F.lit(True))
        graph = materialize(_closest(graph.withColumn("fresh", F.lit(False)).unionByName(better), degree), "graph")
        n, fresh = graph.agg(F.count(F.lit(1)), F.count_if("fresh")).first()
        if fresh <= settled * n:
            break
    return graph.select("row_id", "other", "distance")


def graph_knn(table: DataFrame, k: int = TOP_K, degree: int = DEGREE, seed: int = 0, settled: float = SETTLED) -> DataFrame:
    """About the ``k`` nearest rows of every row of ``(row_id, embedding)``, itself among
    them: ``(query_id, row_id, sim, rank)``. Similarities are exact, neighbours may be
    missed; measure with ``similarity.recall``. Fewer vertices than ``degree`` make the
    search exact. ``degree`` times the number of different vectors are scored."""
    stored = materialize(table.select("row_id", "embedding"), "vectors")
    if stored.groupBy("row_id").count().where("count > 1").head(1):
        raise ValueError("a row_id stands for several rows")
    first = stored.where(F.col("embedding").isNotNull()).select(F.size("embedding")).first()
    # A vertex is a vector; its number is its first position.
    vertices = stored.groupBy("embedding").agg(F.min("row_id").alias("row_id"))
    points = materialize(vertices.withColumn("sketch", _sketch(first[0] if first else 1, seed)("embedding")), "points")
    edges = neighbour_graph(points.select("row_id", "sketch"), max(degree, k), settled)
    own = points.select("row_id", "embedding")
    pairs = edges.select("row_id", "other").join(own, "row_id").join(
        own.select(F.col("row_id").alias("other"), F.col("embedding").alias("embedding_2")), "other"
    )
    selves = own.select("row_id", F.col("row_id").alias("other"), _cosine("embedding", "embedding").alias("sim"))
    scored = pairs.select("row_id", "other", _cosine("embedding", "embedding_2").alias("sim")).unionByName(selves)
    hits = materialize(_top(scored.withColumnRenamed("row_id", "vertex"), "other", k), "hits")
    # Positions of a vertex, the first k, drawn in two steps like any hot group.
    members = materialize(stored.join(own.withColumnRenamed("row_id", "vertex"), stored["embedding"].eqNullSafe(own["embedding"])).select("vertex", stored["row_id"]), "members")
    few = members
    for keys in (["vertex", F.spark_partition_id()], ["vertex"]):
        few = few.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("row_id"))).where(F.col("place") <= k).drop("place")
    found = hits.join(few.withColumnRenamed("vertex", "other"), "other").select("vertex", "row_id", "sim")
    best = _top(found, "row_id", k, "rank").withColumnRenamed("row_id", "hit")
    return members.join(best, "vertex").select(F.col("row_id").alias("query_id"), F.col("hit").alias("row_id"), "sim", "rank")


def _top(hits: DataFrame, row: str, k: int, rank: str | None = None) -> DataFrame:
    order = Window.partitionBy("vertex").orderBy(*best_first("sim", row))
    placed = hits.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= k)
    return placed.withColumnRenamed("__place", rank) if rank else placed.drop("__place")
