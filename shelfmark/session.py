"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings every job of this library is written for. Shuffle partition counts
# are left to the cluster: AQE coalesces what turns out small and splits what
# turns out skewed.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Many small files: count one as 64 KB when packing tasks, not as 4 MB.
    "spark.sql.files.openCostInBytes": "65536",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Recording the call site of every Column costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Inputs below this size per core may be dealt out anew (see spread).
SPREAD_BYTES = 32 << 20

# Stored bytes a sorted partition is sized for (see range_partitions).
RANGE_BYTES = 64 << 20

# Bytes of an Arrow batch: lines may be long, and a batch of 10,000 of them is held several
# times over by its worker.
ARROW_BATCH_BYTES = 4 << 20

# What Spark says of a frame whose size it does not know.
UNKNOWN_BYTES = 1 << 62

# Stored bytes up to which a table is sent to all tasks (see broadcast_if_small).
BROADCAST_TABLE_BYTES = 16 << 20

_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def build_session(
    app: str = "shelfmark", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the library's settings; ``conf`` entries win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    Only a local session may fall back to a folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="shelfmark-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    _delete_at_end(spark, folder)
    return folder


def _delete_at_end(spark: SparkSession, folder: str) -> None:
    """Make a folder that is deleted when the driver's JVM ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)  # only what exists can be marked
    system.deleteOnExit(path)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to a fresh Parquet table in the shared folder, read it back.

    Cuts the lineage and freezes values that depend on how a stage was split
    (partition ids, running ids), so that every later reader sees the same ones
    even when executors are lost. The table goes when the session ends.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder for a table, gone when the session ends."""
    folder = f"{_scratch.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _delete_at_end(spark, folder)
    return f"{folder}/table"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables materialized inside this block are deleted at its end.

    For jobs that leave their results in written tables of their own.
    """
    folder = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def swap_in(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replace what is at ``path`` by what ``write`` puts into the folder that it is given.

    The new table is written beside the old one and takes its place by renaming when it is
    whole, so a job that fails or is lost leaves the old table as it was. If the driver is
    lost between the two renames, the old table is at ``path`` with ``.replaced`` behind it
    and the next call puts it back first. Readers of the old files fail once they are gone.
    """
    path = path.rstrip("/")
    place, old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.replaced", f"{path}.staged-{uuid.uuid4().hex}"))
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())

    def rename(a, b) -> None:
        if not system.rename(a, b):
            raise OSError(f"cannot rename {a} to {b}")

    if system.exists(old) and not system.exists(place):
        rename(old, place)
    try:
        write(new.toString())
    except BaseException:
        system.delete(new, True)
        raise
    system.delete(old, True)
    if system.exists(place):
        rename(place, old)
    elif place.getParent() is not None:
        system.mkdirs(place.getParent())
    rename(new, place)
    system.delete(old, True)


def input_bytes(df: DataFrame) -> int:
    """Size of the files and literal rows a frame is read from, as Spark knows it
    without reading them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def range_partitions(df: DataFrame) -> int:
    """How many ranges to sort a frame into: by its size on disk, and no fewer than
    the session's shuffle partitions, which also count where the size is unknown."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = input_bytes(df)
    return least if size >= UNKNOWN_BYTES else max(math.ceil(size / RANGE_BYTES), least)


def short_batches(df: DataFrame) -> DataFrame:
    """The frame, whose session is told to cut Arrow batches by bytes and not by rows alone."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    return df


def spread(df: DataFrame, bytes_per_core: int = SPREAD_BYTES) -> DataFrame:
    """Deal a small file out over all cores ahead of work done row by row.

    A Parquet file of one row group is one task however many cores wait. Judged
    by the size of the files, not by reading them; an input large enough to fill
    the cluster is returned as is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if input_bytes(df) <= cores * bytes_per_core else df


def broadcast_if_small(stored: DataFrame, of: DataFrame | None = None, most: int = BROADCAST_TABLE_BYTES) -> DataFrame:
    """Mark ``stored`` for broadcast when its files hold at most ``most`` bytes.

    Beyond that the frame is returned as is and Spark joins it by shuffle. The size is
    that of the files, so it is for frames read from a table that :func:`materialize`
    wrote; ``of`` names that table where ``stored`` is derived from it row by row.
    """
    return F.broadcast(stored) if input_bytes(stored if of is None else of) <= most else stored
