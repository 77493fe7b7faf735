"""Helpers shared by the operators: Arrow batches in and out, byte views, hashes."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.once import once_per_worker
from shelfmark.session import fresh_path, input_bytes, materialize, range_partitions

# Bytes of text that NumPy code handles at once; a byte may take a hundred bytes of arrays.
# A longer text is a batch alone.
BATCH_BYTES = 1 << 18

#: A-Z to a-z, all other bytes as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

# Rows of an Arrow batch. Texts are long, and a batch is held by the JVM and the worker.
BATCH_ROWS = 1000

Field = tuple[str, str, pa.DataType]  # name, Spark type, Arrow type


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def binary(column: pa.Array) -> pa.LargeBinaryArray:
    """Texts as UTF-8 bytes; null as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if not pa.types.is_large_binary(column.type) else column
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def parts(batch: pa.RecordBatch, text: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` bytes of text, a row at least."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def joined(texts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts one after another, and the offsets of the texts in them."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def in_tasks(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` for rows with texts: in batches of ``BATCH_ROWS`` rows, which the
    session is told, and with what a task has freed given back at its end."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # what arrays have left of the heap
            trim(0)

    return df.mapInArrow(tidy, schema)


def map_texts(
    df: DataFrame,
    start: Callable[[], Callable[[pa.LargeBinaryArray], list]],
    fields: list[Field],
    text: str = "text",
    keep: list[str] | None = None,
    limit: int = BATCH_BYTES,
) -> DataFrame:
    """Add columns computed from a text column, in Arrow batches, without a shuffle.

    ``start`` is called once per task and returns the function that turns texts into
    columns. ``keep`` names the input columns to return (default: all). An input
    column named like a new one, whatever its case, gives way to it.
    """
    new = {name.lower() for name, _, _ in fields}
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    read = list(dict.fromkeys([*keep, text]))
    out = pa.schema([(name, kind) for name, _, kind in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            for part in parts(batch, text, limit):
                columns = step(binary(part.column(text)))
                columns = [pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, out, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + columns,
                    schema=pa.schema([part.schema.field(c) for c in keep] + list(out)),
                )

    schema = ", ".join(
        [f"`{c.replace('`', '``')}` {df.schema[c].dataType.simpleString()}" for c in keep] + [f"{n} {k}" for n, k, _ in fields]
    )
    return in_tasks(df.select(*[F.col(f"`{c.replace('`', '``')}`") for c in read]), run, schema)


def remainder(column: str, by: int) -> F.Column:
    """crc32 of a value as text, modulo ``by``; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % by


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values in place."""
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def random_words(seed: int, n: int) -> np.ndarray:
    """``n`` odd 64-bit constants, the same on every machine."""
    return mix(np.arange(seed * n + 1, seed * n + n + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


# Powers that a worker keeps: enough for a portion; a longer stretch makes its own and lets
# them go.
KEPT_POWERS = 1 << 19
_BASE = int(random_words(1031, 1)[0]) | 5


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, or more: one pair of tables
    for all that a worker hashes."""

    def table(size: int) -> tuple[np.ndarray, np.ndarray]:
        steps = np.full(size, _BASE, np.uint64)
        steps[0] = 1
        up = np.multiply.accumulate(steps)
        steps[1:] = inverse(_BASE)
        return up, np.multiply.accumulate(steps, out=steps)

    return once_per_worker("powers", _BASE, lambda: table(KEPT_POWERS)) if n <= KEPT_POWERS else table(n)


class Rolling:
    """Hashes of any stretch of a byte buffer from prefix sums modulo 2**64. Each seed has its
    own values of bytes; powers are shared."""

    def __init__(self, seed: int):
        self.values = random_words(seed, 256)
        self.down = np.ones(1, np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        up, self.down = _powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        terms = self.values[data]
        terms *= up[: len(data)]
        np.cumsum(terms, out=sums[1:])
        return sums

    def of(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hash of data[start:stop], equal for equal stretches wherever they stand."""
        h = sums[stop] - sums[start]
        h *= self.down[start]
        return mix(h)


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.frombuffer(LOWER, np.uint8)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and stops of the words (runs without ASCII white space) of joined texts, and
    where each text's words begin among them, with the total at the end."""
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], word[:-1]]) if len(data) else word
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.concatenate([word[1:], [False]]) if len(data) else word
    stops = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


class Store:
    """Intermediate tables of one operator in the shared folder, dropped when no longer
    of use. What is left goes when the session ends (see ``session.materialize``)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        out = materialize(df, name)
        self.paths[id(out)] = out.inputFiles()[0].rpartition("/")[0] if out.inputFiles() else ""
        return out

    def deal(self, df: DataFrame, by: list[str], name: str) -> DataFrame:
        """A stored table in buckets by the hash of ``by``: a join on these columns moves
        only its other side. Equal rows share a bucket."""
        path = fresh_path(self.spark, name)
        most = int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
        n = min(range_partitions(df), most)
        entry = f"{name}_{uuid.uuid4().hex}"
        df.repartition(n, *by).write.bucketBy(n, *by).option("path", path).saveAsTable(entry, format="parquet")
        out = self.spark.table(entry)
        self.spark.sql(f"DROP TABLE `{entry}`")  # the entry only: files at a given path stay
        self.paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            if path := self.paths.pop(id(df), ""):
                place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


def sendable(df: DataFrame, most: int = 16 << 20) -> DataFrame:
    """A stored table marked for broadcast if its files hold ``most`` bytes at most; as it
    is otherwise, for a join by shuffle."""
    return F.broadcast(df) if input_bytes(df) <= most else df
