"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Each word shingle is hashed once. The leading bits of a hash name its bin, and a bin
keeps its smallest hash. An empty bin borrows from the first bin that is not empty in a
random order of its own, the same for all documents (optimal densification), which
leaves bins that agree with the probability of the sets' similarity. Of each bin the low
four bits are stored, packed sixteen to a number; the chance that they agree by accident
is taken out of the estimate.

Everything runs inside the JVM, row by row: a fingerprint needs no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import range_partitions

BINS, BIN_BITS = 256, 8
#: Bits stored of each bin; a hexadecimal digit of the fingerprint.
BITS = 4
REST = (1 << (64 - BIN_BITS)) - 1
#: Bins that an empty bin asks first, one after another.
PROBES = 8
MAX_RANGES = 1_000_000


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def probes() -> list[list[int]]:
    """For each bin the bins it asks first, by a fixed multiplicative rule."""
    mask = (1 << 64) - 1
    out = []
    for b in range(BINS):
        order = sorted((j for j in range(BINS) if j != b), key=lambda j, b=b: ((b * BINS + j + 1) * 0x9E3779B97F4A7C15 & mask) * 0xD6E8FEB86659FD93 >> 20 & mask)
        out.append(order[:PROBES])
    return out


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingle_hashes(text: Column, size: int = 5) -> Column:
    """A hash for each run of ``size`` words; of all words where there are fewer."""
    return let(
        words(text),
        lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (size - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, size)))
        ),
    )


def bin_of(code: Column) -> Column:
    """0 to 255, in the order of the codes."""
    return (F.shiftright(code, 64 - BIN_BITS) + BINS // 2).cast("int")


def binned(codes: Column) -> Column:
    """The smallest code of each bin, in order; the bin's largest code if it is empty.

    The largest codes are added first, so that every bin has one and they come out as
    one sorted run per bin.
    """
    ends = longs([((b - BINS // 2) << (64 - BIN_BITS)) | REST for b in range(BINS)])
    return let(
        F.sort_array(F.concat(codes, ends)),
        lambda s: F.filter(s, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(s, i - 1)))),
    )


def is_empty(code: Column) -> Column:
    return code.bitwiseAND(F.lit(REST)) == F.lit(REST)


def densified(bins: Column) -> Column:
    asked = F.array(*[F.array(*[F.lit(j) for j in row]) for row in probes()])

    def borrowed(d: Column, b: Column) -> Column:
        first = F.get(F.filter(F.transform(F.get(asked, b), lambda j: F.get(d, j)), lambda y: ~is_empty(y)), F.lit(0))
        full = F.filter(d, lambda y: ~is_empty(y))
        later = F.array_min(F.transform(full, lambda y: F.struct(F.xxhash64(b, bin_of(y)).alias("o"), y.alias("y")))).getField("y")
        return F.coalesce(first, later)

    return let(bins, lambda d: F.transform(d, lambda x, b: F.when(is_empty(x), borrowed(d, b)).otherwise(x)))


def packed(bins: Column) -> Column:
    """Low bits of all bins, sixteen bins to a number.

    They are taken after a hash with the bin's number, so that a code that stands in many
    bins, as in short texts, agrees by accident in each of them on its own.
    """
    each = 64 // BITS

    def pack(d: Column, k: Column) -> Column:
        low = F.transform(
            F.slice(d, k * each + 1, each), lambda x, i: F.xxhash64(x, k * each + i).bitwiseAND(F.lit((1 << BITS) - 1))
        )
        return F.aggregate(low, F.lit(0).cast("bigint"), lambda total, x: F.shiftleft(total, BITS).bitwiseOR(x))

    return let(bins, lambda d: F.transform(F.sequence(F.lit(0), F.lit(BINS // each - 1)), lambda k: pack(d, k)))


def sketch(text: Column, size: int = 5) -> Column:
    """The packed fingerprint of a text; an empty array without words."""
    return let(
        shingle_hashes(F.coalesce(text, F.lit("")), size),
        lambda codes: F.when(F.size(codes) == 0, F.array().cast("array<bigint>")).otherwise(packed(densified(binned(codes)))),
    )


def written(parts: Column) -> Column:
    """A packed fingerprint as hexadecimal digits, one a bin."""
    return F.array_join(F.transform(parts, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity of two shingle sets from packed fingerprints.

    Of ``BINS`` places a share E agrees. A place agrees if the bins do, or by the chance
    C of ``BITS`` equal bits: E = J + (1 - J) C. Two texts without words are alike, and
    unlike any other.
    """
    ones = F.lit(int("1" * (64 // BITS), 16))
    apart = F.lit(0)
    for k in range(BINS * BITS // 64):
        x = F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        apart = apart + F.bit_count(x.bitwiseAND(ones))
    chance = 1 / (1 << BITS)
    agree = 1 - apart / BINS
    none, other = F.size(a) == 0, F.size(b) == 0
    return (
        F.when(none & other, 1.0)
        .when(none | other, 0.0)
        .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (agree - chance) / (1 - chance))))
    )


def with_next(docs: DataFrame, key: str = "doc_id", columns: tuple[str, ...] = ("text",), **more: Column) -> DataFrame:
    """Add ``next``, a struct of ``columns`` of the row that follows by ``key``.

    Columns of ``more`` are added first, once for every row, and are part of the struct.
    After the last row comes the first. Rows with one key follow each other by their
    columns; a null key comes first. The rows are dealt into ranges of keys, each sorted
    on its own; the row that follows a range is added to it beforehand, so that the
    texts move once.
    """
    ranges = min(4 * range_partitions(docs), MAX_RANGES)
    keyed = docs.withColumn("__key", F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 63))))
    cuts = min(64, ranges)
    low, high, steps = keyed.agg(
        F.min("__key"), F.max("__key"), F.percentile_approx("__key", [i / cuts for i in range(1, cuts)] or [0.5], F.lit(1000))
    ).first()
    if low is None:
        return docs.withColumns(more).withColumn("next", F.struct(*columns, *more))
    # Shares of the rows, and within each equal widths.
    bounds = sorted({low, *steps, high + 1})
    width = [max(1, math.ceil((b - a) / max(1, ranges // len(bounds)))) for a, b in zip(bounds, bounds[1:], strict=False)]
    share = F.size(F.filter(longs(bounds[1:-1]), lambda b: b <= F.col("__key")))
    within = F.floor((F.col("__key").cast("decimal(20,0)") - F.get(longs(bounds), share)) / F.get(longs(width), share))
    keyed = keyed.withColumn("__range", share.cast("bigint") * (2 * MAX_RANGES) + within.cast("bigint"))
    # One row a range: MAX_RANGES at most.
    firsts = keyed.groupBy("__range").agg(F.min("__key").alias("__key"))
    order = Window.orderBy("__range")
    after = firsts.select(
        "__range", F.coalesce(F.lead("__key").over(order), F.lit(low)).alias("__key")
    )
    guests = keyed.drop("__range").join(F.broadcast(after), "__key").withColumn("__guest", F.lit(True))
    both = keyed.withColumn("__guest", F.lit(False)).unionByName(guests).withColumns(more)
    line = Window.partitionBy("__range").orderBy("__guest", "__key", *columns)
    return (
        both.withColumn("next", F.lead(F.struct(*columns, *more)).over(line)).where(~F.col("__guest")).drop("__range", "__key", "__guest")
    )


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint", size: int = 5) -> DataFrame:
    """Add the fingerprint of a text as hexadecimal digits; empty for a null, empty or
    wordless text. Equal texts have equal fingerprints. A column named like the output
    is replaced."""
    return docs.withColumn(out, written(sketch(F.col(text), size)))


def digest(docs: DataFrame) -> DataFrame:
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chained = with_next(base, own=sketch(F.col("text")))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = (
        chained.withColumn("n_chars", F.char_length("text").cast("bigint"))
        .withColumn("edited", F.concat(F.expr("left(text, cast(n_chars - floor(n_chars / 2) as int))"), F.substring(F.col("next.text"), F.lit(1), half)))
        .withColumn("other", sketch(F.col("edited")))
    )
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("own")).alias("fingerprint"),
        written(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next.own")).alias("near_next"),
    )
