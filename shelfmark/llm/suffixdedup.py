"""Removal of repeated byte strings with a logarithmic family of suffix arrays.

A byte goes if it lies in a string of ``length`` bytes that starts at another place too.
Not every suffix has to be indexed for that. In each window of ``length`` bytes the
leftmost smallest hash of the strings of ``head`` bytes names one place, and equal
windows name equal places; only suffixes that begin at a named place are kept, one for
some 70 bytes of text. A suffix stands in an array by the fingerprint of its head, and
the arrays are sorted by it.

Documents come in batches. A new batch gets a suffix array; it is merge-scanned against
every level of the index, which tells the heads that occur again; then it becomes the
lowest level, and levels of one size merge into one of twice the size. A level has one
row per head however often that occurs, so a passage that a third of all documents
share is one row.

Texts move once: they are dealt out by key into a stored table in buckets, and what is
found about them (blocks, spans) goes to the buckets.

For heads that occur again the windows around them are compared. The windows that name
one place make a block; a block whose bytes occur twice is settled as a whole. What is
left, blocks at the edges of matches, is compared window by window: by head in one go,
and for a head with very many different blocks by a hash of each window over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Rolling, Store, binary, in_tasks, joined, mix, parts, sendable

LENGTH, HEAD = 200, 32
#: Different blocks of one head that one task compares; more are dealt out by window.
TOGETHER = 2048

_heads, _blocks = Rolling(71), Rolling(72)
_SHIFT = np.uint64(32)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row, from least values of blocks."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    rows = -(-len(values) // width)
    grid = np.full(rows * width, np.iinfo(values.dtype).max, values.dtype)
    grid[: len(values)] = values
    grid = grid.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def named_places(texts: pa.LargeBinaryArray, length: int, head: int):
    """Suffixes to index, with the block of windows that names each.

    Returns fingerprints of heads and of blocks, the text, the first window's place in
    it, the number of windows, and how far the head lies behind the first window.
    """
    data, offsets = joined(texts)
    n = len(data) - head + 1
    if len(data) < length:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing, nothing, nothing
    place = np.arange(n)
    heads = _heads.of(_heads.prefix(data), place, place + head)
    order = (heads >> _SHIFT << _SHIFT) | place.astype(np.uint64)
    least = (sliding_least(order, length - head + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    windows = np.flatnonzero(owner[: len(least)] == owner[length - 1 : length - 1 + len(least)])
    named = least[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (named[1:] != named[:-1]) | (windows[1:] != windows[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(windows))[: len(first)] - 1
    low, high, at = windows[first], windows[last], named[first]
    blocks = _blocks.of(_blocks.prefix(data), low, high + length)
    blocks ^= mix((at - low).astype(np.uint64) << _SHIFT | (high - low).astype(np.uint64))
    who = owner[low]
    return heads[at].view(np.int64), blocks.view(np.int64), who, low - offsets[who], high - low + 1, at - low


def _suffixes(docs: DataFrame, length: int, head: int) -> DataFrame:
    """Fingerprints of the suffixes of each batch, with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                heads, _, who, *_ = named_places(binary(part.column("text")), length, head)
                group = part.column("batch").to_numpy()[who] if len(who) else who
                for b in np.unique(group):
                    keys, n = np.unique(heads[group == b], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), b, np.int32), pa.int32()), pa.array(keys), pa.array(n)], names=["batch", "head", "n"]
                    )

    return in_tasks(docs.select("batch", "text"), run, "batch int, head long, n long")


def repeated_heads(docs: DataFrame, store: Store, length: int, head: int, batches: int) -> DataFrame:
    """Heads that occur twice or more, by building the index batch by batch."""
    runs = store.put(_suffixes(docs, length, head), "suffixes")
    levels: list[tuple[int, DataFrame]] = []
    found: DataFrame | None = None

    def array_of(df: DataFrame) -> DataFrame:
        return df.groupBy("head").agg(F.sum("n").alias("n"))

    for b in range(batches):
        new = store.put(array_of(runs.where(F.col("batch") == b)).sortWithinPartitions("head"), "array")
        hits = [new.where("n > 1").select("head")]
        hits += [new.select("head").join(level.select("head").hint("merge"), "head") for _, level in levels]
        for hit in hits:
            found = hit if found is None else found.unionByName(hit)
        levels.append((0, new))
        if len(levels) > 1 and levels[-1][0] == levels[-2][0]:
            # Levels are about to go: settle what the scans have found so far.
            settled = store.put(found.distinct(), "found")
            found = settled
            while len(levels) > 1 and levels[-1][0] == levels[-2][0]:
                (rank, a), (_, b_) = levels[-2:]
                merged = store.put(array_of(a.unionByName(b_)).sortWithinPartitions("head"), "array")
                levels[-2:] = [(rank + 1, merged)]
                store.drop(a, b_)
    out = store.put(found.distinct(), "repeated")
    store.drop(runs, *[level for _, level in levels])
    return out


def _candidates(docs: DataFrame, repeated: DataFrame, length: int, head: int) -> DataFrame:
    """Blocks around heads that occur again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                heads, blocks, who, low, n, ahead = named_places(binary(part.column("text")), length, head)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc").take(pa.array(who)),
                        part.column("mark").take(pa.array(who)),
                        pa.array(heads),
                        pa.array(blocks),
                        pa.array(low, pa.int64()),
                        pa.array(n.astype(np.int32)),
                        pa.array(ahead.astype(np.int32)),
                    ],
                    names=["doc", "mark", "head", "block", "low", "n", "ahead"],
                )

    schema = "doc long, mark long, head long, block long, low long, n int, ahead int"
    return in_tasks(docs.select("doc", "mark", "text"), run, schema).join(sendable(repeated), "head")


def _contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of wanted blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                out = []
                rows = zip(
                    binary(part.column("text")), part.column("doc").to_pylist(), part.column("mark").to_pylist(), part.column("wanted").to_pylist(), strict=True
                )
                for text, doc, mark, blocks in rows:
                    text = text.as_py()
                    for w in blocks:
                        end = w["low"] + w["n"] - 1 + length
                        out.append((w["head"], w["hot"], w["only"], doc, mark, w["low"], w["n"], w["ahead"], text[w["low"] : end]))
                columns = [list(c) for c in zip(*out, strict=True)] if out else [[] for _ in range(9)]
                kinds = [pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["head", "hot", "only", "doc", "mark", "low", "n", "ahead", "bytes"],
                )

    schema = "head long, hot boolean, only boolean, doc long, mark long, low long, n int, ahead int, bytes binary"
    asked = docs.select("doc", "mark", "text").join(sendable(wanted), ["doc", "mark"])
    return in_tasks(asked.select("doc", "mark", "text", "wanted"), run, schema)


def _windows(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, window number in its block, and identity of all windows of blocks. Windows
    are alike if their bytes are and the head stands at the same distance."""
    data, offsets = joined(batch.column("bytes").cast(pa.large_binary()))
    n = batch.column("n").to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[row] + step
    same = _blocks.of(_blocks.prefix(data), start, start + length)
    ahead = batch.column("ahead").to_numpy().astype(np.int64)[row] - step
    key = batch.column("head").to_numpy()[row].view(np.uint64) + ahead.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return row, step, mix(same ^ mix(key))


SPAN = "doc long, mark long, start long, stop long"


def _spans(batch: pa.RecordBatch, row: np.ndarray, step: np.ndarray, length: int) -> pa.RecordBatch:
    """Byte spans of windows that are in order, neighbours joined."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (step[1:] != step[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row))[: len(first)] - 1
    at = row[first]
    low = batch.column("low").to_numpy()[at]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc").take(pa.array(at)), batch.column("mark").take(pa.array(at)), pa.array(low + step[first]), pa.array(low + step[last] + length)],
        names=["doc", "mark", "start", "stop"],
    )


def _compare(contexts: DataFrame, length: int) -> DataFrame:
    """Spans of windows that two blocks of a head share, for heads of few blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def judge(batch):
            row, step, same = _windows(batch, length)
            order = np.argsort(same, kind="stable")
            s = same[order]
            equal = np.zeros(len(s) + 1, bool)
            equal[1:-1] = s[1:] == s[:-1]
            again = np.zeros(len(s), bool)
            again[order] = equal[1:] | equal[:-1]
            again &= batch.column("only").to_numpy(zero_copy_only=False)[row]
            return _spans(batch, row[again], step[again], length)

        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            # Rows are sorted by head; the last head may go on in the next batch.
            heads = batch.column("head").to_numpy()
            cut = int(np.searchsorted(heads, heads[-1])) if len(heads) else 0
            if cut:
                yield judge(batch.slice(0, cut))
            held = batch.slice(cut)
        if held is not None and held.num_rows:
            yield judge(held)

    return contexts.repartition("head").sortWithinPartitions("head").mapInArrow(run, SPAN)


def _compare_dealt(contexts: DataFrame, length: int) -> DataFrame:
    """The same for heads of very many blocks: windows are counted over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, step, same = _windows(batch, length)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc").take(at),
                    batch.column("mark").take(at),
                    pa.array(batch.column("low").to_numpy()[row] + step),
                    pa.array(same.view(np.int64)),
                    batch.column("only").take(at),
                ],
                names=["doc", "mark", "start", "same", "only"],
            )

    seen = contexts.mapInArrow(run, "doc long, mark long, start long, same long, only boolean")
    counts = seen.groupBy("same").count().where("count > 1").select("same")
    return seen.where("only").join(counts, "same").select("doc", "mark", "start", (F.col("start") + length).alias("stop"))


def repeated_spans(docs: DataFrame, store: Store, length: int = LENGTH, head: int = HEAD, batches: int = 4) -> DataFrame:
    """Byte spans to remove, by ``doc`` and ``mark``; they may overlap.

    ``docs`` has doc, mark and text.
    """
    docs = docs.withColumn("batch", F.pmod(F.xxhash64("doc", "mark"), F.lit(batches)).cast("int"))
    repeated = repeated_heads(docs, store, length, head, batches)
    blocks = store.put(_candidates(docs, repeated, length, head), "blocks")
    # One row stands for all with the same block: the one with the least hash.
    rank = F.xxhash64("doc", "mark", "low")
    alike = store.put(blocks.groupBy("head", "block").agg(F.count("*").alias("copies"), F.min(rank).alias("first")), "alike")
    # Heads with different blocks, one of them alone: its windows may yet occur in another.
    mixed = alike.groupBy("head").agg(F.count("*").alias("different"), F.min("copies").alias("least")).where("different > 1 and least = 1")
    mixed = store.put(mixed.select("head", (F.col("different") > TOGETHER).alias("hot")), "mixed")
    judged = store.put(
        blocks.join(alike, ["head", "block"]).join(sendable(mixed), "head", "left").select(
            "doc",
            "mark",
            "head",
            "low",
            "n",
            "ahead",
            (F.col("copies") == 1).alias("only"),
            "hot",
            (rank == F.col("first")).alias("stands"),
        ).where("not only or hot is not null"),
        "judged",
    )
    store.drop(blocks, alike, repeated, mixed)
    whole = judged.where("not only").select("doc", "mark", F.col("low").alias("start"), (F.col("low") + F.col("n") - 1 + length).alias("stop"))
    asked = judged.where("hot is not null and (only or stands)")
    wanted = store.put(
        asked.groupBy("doc", "mark").agg(F.collect_list(F.struct("head", "hot", "only", "low", "n", "ahead")).alias("wanted")), "wanted"
    )
    contexts = store.put(_contexts(docs, wanted, length), "contexts")
    return (
        whole.unionByName(_compare(contexts.where("not hot"), length)).unionByName(_compare_dealt(contexts.where("hot"), length))
    )


def joined_spans(starts: list[int], stops: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(starts, stops, strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


FIELDS = {
    "n_bytes": ("bigint", pa.int64()),
    "n_removed": ("bigint", pa.int64()),
    "n_spans": ("bigint", pa.int64()),
    "spans": ("array<struct<start:bigint,stop:bigint>>", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
    "kept_sha256": ("string", pa.string()),
    "kept": ("binary", pa.binary()),
    "kept_text": ("string", pa.string()),
}


def without_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    batches: int = 4,
    keep: list[str] | None = None,
    outputs: list[str] | None = None,
) -> DataFrame:
    """Remove every byte that a string of ``length`` bytes covers which starts elsewhere too.

    Adds n_bytes, n_removed, n_spans, spans (joined byte spans), kept_sha256, kept (the
    bytes that stay) and kept_text (the whole characters among them), or those named in
    ``outputs``. Strings are judged on the
    input; matches never cross texts. A null text is an empty one; texts shorter than
    ``length`` stay whole. Rows with one key are told apart by their texts; rows equal
    in both lose the same bytes. Input columns named like an output are replaced.
    """
    outputs = list(FIELDS) if outputs is None else outputs
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in outputs]
    number = F.col(key).cast("bigint") if docs.schema[key].dataType.typeName() in ("byte", "short", "integer", "long") else F.xxhash64(key)
    # A struct holds the columns kept, so that no name clashes with one of ours.
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(number, F.lit(-(1 << 63))).alias("doc"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark"),
    )
    store = Store(docs.sparkSession)
    named = store.deal(named, ["doc", "mark"], "texts")
    spans = repeated_spans(named.select("doc", "mark", "text"), store, length, batches=batches)
    spans = store.put(
        spans.groupBy("doc", "mark").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops")), "spans"
    )
    schema = ", ".join([f"row {named.schema['row'].dataType.simpleString()}"] + [f"{o} {FIELDS[o][0]}" for o in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                out: dict[str, list] = {o: [] for o in FIELDS}
                rows = zip(binary(part.column("text")), part.column("starts").to_pylist(), part.column("stops").to_pylist(), strict=True)
                for value, starts, stops in rows:
                    value = value.as_py()
                    gone = joined_spans(starts or [], stops or [])
                    at, kept = 0, []
                    for a, b in gone:
                        kept.append(value[at:a])
                        at = b
                    kept = b"".join([*kept, value[at:]])
                    out["n_bytes"].append(len(value))
                    out["n_removed"].append(len(value) - len(kept))
                    out["n_spans"].append(len(gone))
                    out["spans"].append([{"start": a, "stop": b} for a, b in gone])
                    out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                    out["kept"].append(kept)
                    out["kept_text"].append(kept.decode("utf-8", "ignore"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), *[pa.array(out[o], FIELDS[o][1]) for o in outputs]], names=["row", *outputs]
                )

    joined_ = named.join(sendable(spans), ["doc", "mark"], "left").select("row", "text", "starts", "stops")
    found = in_tasks(joined_, run, schema)
    return found.select(*[F.col(f"row.`{c}`") for c in keep], *outputs)


def digest(docs: DataFrame) -> DataFrame:
    return without_repeats(docs, keep=["doc_id"], outputs=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
