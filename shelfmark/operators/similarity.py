"""Cosine similarity and exact or approximate top-k over embedding tables.

Frames hold ``(row_id, embedding)``; ``row_id`` is unique, for queries within the
values of an optional column ``by`` (positions restart per split). A corpus in which
positions repeat is refused. Results order by similarity, NaN last, then by ``row_id``. Similarities are rounded to
``TIE_DECIMALS`` so that copies of a vector tie instead of being told apart by
the last bits of a sum.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.vectors import TIE_DECIMALS, as_matrix, cosine_to, unit_rows
from shelfmark.operators.once import evaluate_once
from shelfmark.session import materialize, spread

# Fixed value: how many neighbours a query asks for.
TOP_K = 5

# A side is broadcast up to this many bytes of float64; where neither fits, both
# are cut into blocks of at most this size and meet through a shuffle.
BROADCAST_BYTES = 64 << 20
BLOCK_BYTES = 64 << 20

# Rows of a block that are made double precision at a time.
CELL_ROWS = 16_384

# Pairs of rows beyond which a search first leaves out what equal vectors cannot hold.
MANY_PAIRS = 1 << 30

# Groups in which the best rows of a corpus' tasks meet first.
TASK_GROUPS = 64

_HITS = "query_id long, row_id long, sim double, rank int"


def pick_vector(table: DataFrame, row_id: int) -> np.ndarray:
    """The vector at one position; fails unless exactly one row has it."""
    rows = table.where(F.col("row_id") == row_id).select("embedding").take(2)
    if len(rows) != 1:
        raise ValueError(f"row_id {row_id} matches {'no row' if not rows else 'several rows'}")
    return np.asarray(rows[0][0], dtype=np.float64)


def best_first(sim: str = "sim", row_id: str = "row_id") -> list[Column]:
    """Sort keys of a result: NaN last, then similarity, then position."""
    return [F.isnan(sim), F.col(sim).desc(), F.col(row_id)]


def similarities(table: DataFrame, query: np.ndarray) -> DataFrame:
    """``(row_id, sim)`` of every row against one vector; one narrow pass."""
    sim = F.round(cosine_to(query, F.col("embedding")), TIE_DECIMALS)
    return table.select("row_id", F.coalesce(sim, F.lit(float("nan"))).alias("sim"))


def ranked(sims: DataFrame) -> DataFrame:
    """All similarities, best first."""
    return sims.orderBy(*best_first())


def top_k(table: DataFrame, query_row: int = 0, k: int = TOP_K) -> DataFrame:
    """``(query_id, row_id, sim, rank)`` of the ``k`` rows most similar to one row.

    The row itself takes part. Every task keeps its own best ``k``; the ranking
    window sees the ``k`` survivors only.
    """
    sims = similarities(table, pick_vector(table, query_row))
    best = sims.orderBy(*best_first()).limit(k).withColumn("query_id", F.lit(query_row).cast("long"))
    return _ranked_hits(best, k)


def _ranked_hits(hits: DataFrame, k: int, by: str | None = None) -> DataFrame:
    keys = [by] if by else []
    order = Window.partitionBy(*keys, "query_id").orderBy(*best_first())
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(*keys, "query_id", "row_id", "sim", "rank")
    )


def with_records(hits: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """Attach columns of the table's row at each hit's position (not by ``id``,
    which may repeat)."""
    return hits.join(table.select("row_id", *columns), "row_id")


# --- many queries -----------------------------------------------------------

# Positions, or structs of a ``by`` value and a position.
Ids = np.ndarray | pa.StructArray
BY = "__by"


class _Best:
    """The best ``k`` rows of every query among the blocks seen so far."""

    def __init__(self, query_ids: Ids, units: np.ndarray, k: int, chunk: int = 128, floor: np.ndarray | None = None):
        self.query_ids, self.units, self.k, self.chunk = query_ids, units, k, chunk
        self.query = np.zeros(0, np.int64)
        self.row = np.zeros(0, np.int64)
        self.key = np.zeros(0)  # rounded similarity, -inf for NaN
        # Each query's k-th best key, or that of a search of other rows.
        self.floor = np.full(len(query_ids), -np.inf) if floor is None else floor.copy()
        # Row id so far. Rows that a given floor stands for may have any.
        self.highest = -np.inf if floor is None else np.inf

    def add(self, row_ids: np.ndarray, units: np.ndarray, asking: np.ndarray | None = None) -> None:
        """Take in a block of corpus rows, in ascending ``row_ids``, for all queries or those
        at the places ``asking``."""
        # Rows past all earlier ones lose every tie, so only a clearly better key
        # counts; others may win one. The margins allow for the rounding.
        step = 10.0**-TIE_DECIMALS
        bar = self.floor + (0.4 * step if row_ids[0] > self.highest else -step)
        self.highest = max(self.highest, row_ids[-1])
        found = [(self.query, self.row, self.key)]
        asking = np.arange(len(self.units)) if asking is None else asking
        for start in range(0, len(asking), self.chunk):
            here = asking[start : start + self.chunk]
            sims = self.units[here] @ units.T
            keep = ~(sims < bar[here, None])  # NaN stays in
            q, r = _places(keep)
            many = np.bincount(q, minlength=len(here)) > 4 * self.k
            if many.any():
                keep[many] = self._top_of_each(_key(sims[many]))
                q, r = _places(keep)
            found.append((here[q], row_ids[r], _key(sims[q, r])))
        held = len(self.query)
        self.query, self.row, self.key = (np.concatenate(part) for part in zip(*found))
        if len(self.query) > held:
            self._cut()

    def _top_of_each(self, key: np.ndarray) -> np.ndarray:
        n = key.shape[1]
        if n <= self.k:
            return np.ones(key.shape, dtype=bool)
        bar = np.partition(key, n - self.k, axis=1)[:, n - self.k, None]
        keep = key >= bar
        over = np.count_nonzero(keep, axis=1) > self.k  # ties at the bar: the first ones stay
        above, level = key[over] > bar[over], key[over] == bar[over]
        room = self.k - np.count_nonzero(above, axis=1)[:, None]
        keep[over] = above | (level & (np.cumsum(level, axis=1, dtype=np.int32) <= room))
        return keep

    def _cut(self) -> None:
        order = np.lexsort((self.row, -self.key, self.query))
        place = _place_in_run(self.query[order])
        order, place = order[place < self.k], place[place < self.k]
        self.query, self.row, self.key = self.query[order], self.row[order], self.key[order]
        last = place == self.k - 1
        self.floor[self.query[last]] = np.maximum(self.floor[self.query[last]], self.key[last])

    def batches(self) -> Iterator[pa.RecordBatch]:
        taken = self.query_ids[self.query] if isinstance(self.query_ids, np.ndarray) else self.query_ids.take(pa.array(self.query))
        named = {"query_id": taken} if isinstance(taken, np.ndarray) else dict(zip((BY, "query_id"), taken.flatten(), strict=True))
        table = pa.table(
            {
                **named,
                "row_id": self.row,
                "sim": np.where(np.isneginf(self.key), np.nan, self.key),
                "rank": (_place_in_run(self.query) + 1).astype(np.int32),
            }
        )
        yield from table.to_batches(max_chunksize=65_536)


def _key(sims: np.ndarray) -> np.ndarray:
    key = np.round(sims, TIE_DECIMALS)
    key[np.isnan(key)] = -np.inf
    return key


def _places(kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of what is true in a matrix in which little is."""
    return np.divmod(np.flatnonzero(kept), max(kept.shape[1], 1))


def _place_in_run(sorted_values: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... within each run of equal values."""
    return np.arange(len(sorted_values)) - np.searchsorted(sorted_values, sorted_values, side="left")


Block = tuple[Ids, np.ndarray]  # ids, unit vectors


def _search(queries: Block, corpus: Iterator[Block], k: int) -> Iterator[pa.RecordBatch]:
    best = _Best(*queries, k)
    for row_ids, units in corpus:
        # A batch of nulls only does not know how long its vectors are.
        dim = max(best.units.shape[1], units.shape[1])
        best.units, units = _as_long(best.units, dim), _as_long(units, dim)
        order = np.argsort(row_ids, kind="stable")
        row_ids, units = row_ids[order], units[order]
        # A short first piece sets a bar that most of the rest fails to reach.
        cuts = [0, *range(512, len(row_ids), 8_192), len(row_ids)] if len(row_ids) else [0]
        for start, stop in zip(cuts, cuts[1:]):
            best.add(row_ids[start:stop], units[start:stop])
    yield from best.batches()


def _as_long(units: np.ndarray, dim: int) -> np.ndarray:
    return units if units.shape[1] == dim else np.full((len(units), dim), np.nan)


def _block(ids: pa.Array, vectors: pa.Array, by: pa.Array | None = None) -> Block:
    if by is not None:
        return pa.StructArray.from_arrays([by, ids], ["by", "row_id"]), unit_rows(as_matrix(vectors))
    return np.asarray(ids.to_numpy(zero_copy_only=False), np.int64), unit_rows(as_matrix(vectors))


def _gathered(parts: Iterator[Block], n: int) -> Block:
    """Blocks of ``n`` rows in all, one at least, as one of them."""
    ids, units, at = [], np.zeros((n, 0)), 0
    for part_ids, part in parts:
        if part.shape[1] > units.shape[1]:  # so far all were null
            units = np.full((n, part.shape[1]), np.nan)
        units[at : at + len(part)] = _as_long(part, units.shape[1])
        ids.append(part_ids)
        at += len(part)
    return np.concatenate(ids) if isinstance(ids[0], np.ndarray) else pa.concat_arrays(ids), units


def _hits_schema(queries: DataFrame, by: str | None = None) -> str:
    return (f"{BY} {queries.schema[by].dataType.simpleString()}, " if by else "") + _HITS


def _check_positions(corpus: DataFrame) -> None:
    """Fail on a position that stands twice; only positions are shuffled."""
    twice = corpus.groupBy("row_id").count().where("count > 1").head(1)
    if twice:
        raise ValueError(f"row_id {twice[0][0]} stands for several rows of the corpus: search one split at a time")


def _size_of(table: DataFrame) -> tuple[int, int]:
    """Row count and vector length; on a stored table the count reads footers only."""
    first = table.where(F.col("embedding").isNotNull()).select(F.size("embedding")).first()
    return table.count(), max(first[0] if first else 1, 1)


def first_copies(corpus: DataFrame, k: int) -> DataFrame:
    """The ``k`` first positions of every distinct vector. Equal vectors tie and are told
    apart by position, so no other row is among the ``k`` nearest of anything. Short texts have
    few distinct vectors where words are hashed to few buckets."""
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("row_id"))
    return corpus.select("row_id", "embedding").withColumn("__copy", place).where(F.col("__copy") <= k).drop("__copy")


def knn(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = TOP_K,
    by: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
    many_pairs: int = MANY_PAIRS,
) -> DataFrame:
    """The exact ``k`` nearest corpus rows of every query:
    ``(query_id, row_id, sim, rank)``, with ``by`` in front where queries have it.

    Both sides are counted first. With over ``many_pairs`` pairs of rows, a corpus gives way
    to the first ``k`` rows of each of its distinct vectors, which have the same hits. A small corpus is broadcast, and every query is
    answered where it lies, with no shuffle. Few queries are broadcast, and each
    task of the corpus hands on its best ``k``, which Spark ranks in groups of tasks
    and then as a whole.
    Where neither fits, both are cut into blocks by a hash of ``row_id`` and every
    pair of blocks meets in one task, which again hands on ``k`` rows per query. Both
    sides are read more than once: store what an encoder made before searching it.
    """
    n_queries, dim = _size_of(queries)
    n_corpus = corpus.count()
    _check_positions(corpus)
    if n_queries * n_corpus > many_pairs:
        corpus = materialize(first_copies(corpus, k), "copies")
        n_corpus = corpus.count()
    if by:
        queries = queries.withColumn(BY, F.col(by))
    keys = [BY] if by else []

    def named(hits: DataFrame) -> DataFrame:
        return hits.withColumnRenamed(BY, by) if by else hits

    if n_corpus * dim * 8 <= broadcast_bytes:
        return named(_knn_broadcast_corpus(queries, corpus, k, keys))
    if n_queries * dim * 8 <= broadcast_bytes:
        return named(_ranked_hits(_knn_broadcast_queries(queries, corpus, k, keys), k, *keys))
    # Blocks of equal size, small enough for memory and enough of them for all cores.
    cores = queries.sparkSession.sparkContext.defaultParallelism
    per_block = max(min(block_bytes // (dim * 8), math.ceil(math.sqrt(n_queries * n_corpus / cores))), 1)
    n_q, n_c = math.ceil(n_queries / per_block), math.ceil(n_corpus / per_block)
    # A partition per pair of blocks, which is the unit of work.
    counts = {"n_q": F.lit(n_q), "n_c": F.lit(n_c)}
    hits = _knn_cells(queries.withColumns(counts), corpus.withColumns(counts), [], k, n_q * n_c, keys)
    return named(_ranked_hits(hits, k, *keys))


def _shared(table: DataFrame, keys: list[str] = ()):
    """A counted, small table as a broadcast block."""
    held = table.select("row_id", "embedding", *keys).toArrow().combine_chunks()
    parts = [held[c].combine_chunks() for c in ("row_id", "embedding", *keys)]
    return table.sparkSession.sparkContext.broadcast(_block(*parts))


def _knn_broadcast_corpus(queries: DataFrame, corpus: DataFrame, k: int, keys: list[str]) -> DataFrame:
    shared = _shared(corpus)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _search(_block(*batch.columns), iter([shared.value]), k)

    schema = _hits_schema(queries, BY if keys else None)
    return spread(queries.select("row_id", "embedding", *keys)).mapInArrow(search, schema)


def _knn_broadcast_queries(queries: DataFrame, corpus: DataFrame, k: int, keys: list[str]) -> DataFrame:
    shared = _shared(queries, keys)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (_block(b.column(0), b.column(1)) for b in batches if b.num_rows)
        yield from _search(shared.value, blocks, k)

    found = corpus.select("row_id", "embedding").mapInArrow(search, _hits_schema(queries, BY if keys else None))
    # Tasks stay as small as the corpus was cut, so that a lost one is soon done again; what
    # they hand on meets in groups of tasks before it meets as a whole.
    group = F.pmod(F.spark_partition_id(), F.lit(TASK_GROUPS))
    order = Window.partitionBy(*keys, "query_id", "__group").orderBy(*best_first())
    best = found.withColumn("__group", group).withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= k)
    return best.drop("__group", "__place")


def _knn_cells(
    queries: DataFrame, corpus: DataFrame, keys: list[str], k: int, partitions: int, by: list[str] = ()
) -> DataFrame:
    """Search block against block. Rows carry ``n_q`` and ``n_c``, the number of
    blocks each side of their group is cut into; a query goes to every corpus
    block of its group and the other way round."""

    def block(count: str) -> Column:
        return F.pmod(F.xxhash64("row_id"), F.col(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count).cast("int") - 1))

    cell = [*keys, "q_block", "c_block"]
    rows = queries.select(
        *keys, block("n_q").alias("q_block"), every("n_c").alias("c_block"),
        "row_id", "embedding", F.lit(True).alias("asks"), *by,
    ).unionByName(
        corpus.select(
            *keys, every("n_q").alias("q_block"), block("n_c").alias("c_block"),
            "row_id", "embedding", F.lit(False).alias("asks"),
            *[F.lit(None).cast(queries.schema[c].dataType).alias(c) for c in by],
        )
    )

    def search(table: pa.Table) -> pa.Table:
        def side(asks: bool, *more: str) -> Iterator[Block]:
            for batch in table.to_batches(max_chunksize=CELL_ROWS):
                part = batch.filter(batch["asks"] if asks else pc.invert(batch["asks"]))
                if part.num_rows:
                    yield _block(*[part[c] for c in ("row_id", "embedding", *more)])

        schema = pa.schema(
            [*[(c, table.schema.field(c).type) for c in by],
             ("query_id", pa.int64()), ("row_id", pa.int64()), ("sim", pa.float64()), ("rank", pa.int32())]
        )
        n_asked = pc.sum(table["asks"]).as_py() or 0
        # Only the side that asks is held as a whole in double precision.
        return pa.Table.from_batches(_search(_gathered(side(True, *by), n_asked), side(False), k) if n_asked else [], schema)

    return rows.repartition(partitions, *cell).groupBy(*cell).applyInArrow(search, _hits_schema(queries, *by))


# --- approximate ------------------------------------------------------------


def approximate_knn(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = TOP_K,
    tables: int = 8,
    bits: int | None = None,
    seed: int = 0,
    block_bytes: int = BLOCK_BYTES,
    bucket_rows: int = 4,
    probes: int = 4,
) -> DataFrame:
    """Nearest rows among those sharing a random-hyperplane bucket with the query.

    The number of hyperplanes grows with the corpus, so that a bucket holds about
    ``bucket_rows`` of its rows whatever its size and the share of pairs that are
    scored falls (see :func:`scored_share`); ``bits`` fixes it instead. A query also
    looks into ``probes`` neighbouring buckets of each table, across the hyperplanes
    that it lies closest to.

    Opt-in: may miss neighbours, and finds fewer than ``k`` where buckets are
    sparse; measure with :func:`recall`. Similarities of what is found are
    exact. A bucket that holds much of the corpus is cut into blocks like an
    exact search, so no task gets a whole one and none is dropped.
    """
    n_corpus, dim = _size_of(corpus)
    if bits is None:
        bits = bits_for(n_corpus, bucket_rows)
    per_block = max(block_bytes // (dim * 8), 1)
    keys = ["table_no", "bucket"]
    q, c = (_bucketed(side, dim, tables, bits, seed, n) for side, n in ((queries, probes), (corpus, 0)))

    def blocks(table: DataFrame, name: str) -> DataFrame:
        n = F.ceil(F.count(F.lit(1)) / per_block).cast("int")
        return table.groupBy(*keys).agg(n.alias(name))

    sizes = blocks(q, "n_q").join(blocks(c, "n_c"), keys)
    if tables << bits <= 200_000:  # the most rows it can have
        sizes = F.broadcast(sizes)
    cores = corpus.sparkSession.sparkContext.defaultParallelism
    parts = max(math.ceil(tables * (n_corpus + queries.count()) / per_block), cores)
    found = _knn_cells(q.join(sizes, keys), c.join(sizes, keys), keys, k, parts)
    return _ranked_hits(found.groupBy("query_id", "row_id").agg(F.max("sim").alias("sim")), k)


def bits_for(n_corpus: int, bucket_rows: int) -> int:
    """Hyperplanes that leave about ``bucket_rows`` of a corpus in a bucket."""
    return min(max(math.ceil(math.log2(max(n_corpus, 1) / bucket_rows)), 0), 30)


def scored_share(
    queries: DataFrame,
    corpus: DataFrame,
    tables: int = 8,
    bits: int | None = None,
    seed: int = 0,
    bucket_rows: int = 4,
    probes: int = 4,
) -> DataFrame:
    """Pairs that an approximate search scores, over all its tables, and their share of all
    pairs. From bucket sizes; no pair is made."""
    n_corpus, dim = _size_of(corpus)
    bits = bits_for(n_corpus, bucket_rows) if bits is None else bits
    keys = ["table_no", "bucket"]
    q, c = (
        _bucketed(side, dim, tables, bits, seed, n).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
        for side, name, n in ((queries, "n_q", probes), (corpus, "n_c", 0))
    )
    scored = F.coalesce(F.sum(F.col("n_q") * F.col("n_c")), F.lit(0)).alias("scored")
    return q.join(c, keys).agg(scored).withColumn("share", F.try_divide("scored", F.lit(max(queries.count() * n_corpus, 1))))


def _bucketed(table: DataFrame, dim: int, tables: int, bits: int, seed: int, probes: int) -> DataFrame:
    """Rows once for each hash table and bucket that they are in or look into."""
    planes = np.random.default_rng(seed).standard_normal((dim, tables * bits))
    near = min(probes, bits)
    each = tables * (1 + near)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def signature(vectors: pa.Array) -> pa.Array:
        heights = (as_matrix(vectors) @ planes).reshape(len(vectors), tables, bits)
        codes = ((heights > 0) * (1 << np.arange(bits))).sum(axis=2, keepdims=True).astype(np.int32)
        if near:
            closest = np.argsort(np.abs(heights), axis=2, kind="stable")[:, :, :near]
            codes = np.concatenate([codes, codes ^ (1 << closest).astype(np.int32)], axis=2)
        offsets = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * each)
        return pa.ListArray.from_arrays(offsets, pa.array(codes.ravel()))

    signed = evaluate_once(table.select("row_id", "embedding"), codes=signature("embedding"))
    placed = signed.select("row_id", "embedding", F.posexplode("codes").alias("place", "bucket"))
    return placed.withColumn("table_no", F.floor(F.col("place") / (1 + near)).cast("int")).drop("place")


@F.arrow_udf(T.DoubleType())
def _pair_cosine(left: pa.Array, right: pa.Array) -> pa.Array:
    a, b = unit_rows(as_matrix(left)), unit_rows(as_matrix(right))
    dim = max(a.shape[1], b.shape[1])
    sims = (_as_long(a, dim) * _as_long(b, dim)).sum(axis=1)
    known = left.is_valid().to_numpy(zero_copy_only=False) & right.is_valid().to_numpy(zero_copy_only=False)
    return pa.array(np.where(known, sims, np.nan))


def pair_cosines(pairs: DataFrame, queries: DataFrame, corpus: DataFrame) -> DataFrame:
    """Pairs ``(query_id, row_id)`` with ``exact``, the cosine of their two vectors, not rounded.
    Each pair's vectors are fetched by two joins, so this costs as much as there are pairs."""
    asked = queries.select(F.col("row_id").alias("query_id"), F.col("embedding").alias("__asked"))
    held = corpus.select("row_id", F.col("embedding").alias("__held"))
    both = pairs.join(asked, "query_id").join(held, "row_id")
    return both.select(*pairs.columns, _pair_cosine("__asked", "__held").alias("exact"))


def recall(approximate: DataFrame, exact: DataFrame, by: str | None = None) -> DataFrame:
    """Share of the exact hits that the approximate search found."""
    keys = [*([by] if by else []), "query_id", "row_id"]
    found = approximate.select(*keys, F.lit(1).alias("found"))
    return exact.join(found, keys, "left").agg(
        F.count(F.lit(1)).alias("n_exact"),
        F.count("found").alias("n_found"),
        F.try_divide(F.count("found"), F.count(F.lit(1))).alias("recall"),
    )
