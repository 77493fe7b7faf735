"""MinHash near-duplicate groups with odd sketches.

A document is its set of word shingles. MinHash samples of the set are used twice: bands
of them name buckets, and all of them are folded into an odd sketch, a short bitmap in
which each sample flips one bit. The exclusive or of two sketches has few bits where
sets are very similar, and its number of ones estimates a high similarity closely.

Documents with one set are one node. In each bucket a leader is drawn and compared, by
sketch, with the others; nodes that may be alike are joined into families, widely. What
a bucket holds of different families is compared in blocks, again by sketch. Only within
families are full sets compared, and never all with all. Everyone is compared with the
family's first member, then with a second centre that lies close to it. Let D(x) be what
x and the centre do not share. Then 100 |x & y| >= T |x | y| is the same as

    w(x) + w(y) <= 2 (100 + T) |D(x) & D(y)|,  w(x) = (100 + T) |D(x)| - (100 - T) |x|

so that x is linked to the member y of least w if the left side is not positive, and
otherwise has to share elements of D with whomever it is linked to. Groups of near copies
thus cost about as many comparisons of full sets as they have members. For the members
that are still apart, the inequality is evaluated against the rest of the family in
blocks: from weights and the elements of D that are not one's own alone, which is exact
and needs no further sets. No task makes pairs that are not links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Rolling, Store, binary, joined, lowered, map_texts, mix, parts, random_words, sendable, word_spans

SAMPLES, BANDS, ROWS = 256, 32, 5
SKETCH_BITS = 512
LONGS = SKETCH_BITS // 64
#: Estimates below these are taken as surely below the threshold: for families, and for
#: pairs. They lie over seven and six standard errors under 0.8.
FAMILY, PAIR = 0.2, 0.16
#: Rows of a block, and columns of the matrices that compare two blocks.
BLOCK, COLUMNS = 1024, 4096
#: Leaders of buckets are drawn anew for each of so many groups of bands.
DRAWS = 4

_words = Rolling(11)
_steps = random_words(12, 64)
_scale = (random_words(13, SAMPLES) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_shift = (random_words(14, SAMPLES) >> np.uint64(32)).astype(np.uint32)


def shingle_sets(texts: pa.LargeBinaryArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, sorted, one text after another, and
    where each text's begin, with the total at the end."""
    data, offsets = joined(texts)
    data = lowered(data)
    starts, stops, first = word_spans(data, offsets)
    words = _words.of(_words.prefix(data), starts, stops)
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    h = np.zeros(len(words), np.uint64)
    left = np.repeat(first[1:], n) - np.arange(len(words))  # words from here to the end
    for k in range(size):
        ok = left > k
        h[ok] += words[np.flatnonzero(ok) + k] * _steps[k]
    # A text of fewer words is one shingle; otherwise the last places begin none.
    begins = (left >= size) | ((np.repeat(n, n) < size) & (np.arange(len(words)) == np.repeat(first[:-1], n)))
    h, owner = mix(h[begins] + np.minimum(left[begins], size).astype(np.uint64)), owner[begins]
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(len(n) + 1))


def signatures(h: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bands and odd sketches of sets that are not empty."""
    low = (h >> np.uint64(32)).astype(np.uint32)
    sets = len(cut) - 1
    bands = np.zeros((sets, BANDS), np.uint64)
    sketch = np.zeros((sets, LONGS), np.uint64)
    at = np.arange(sets)
    value = np.empty_like(low)
    for i in range(SAMPLES):
        np.multiply(low, _scale[i], out=value)
        value += _shift[i]
        least = np.minimum.reduceat(value, cut[:-1]).astype(np.uint64)
        spot = mix((least << np.uint64(16)) | np.uint64(i))
        bit = spot >> np.uint64(64 - 9)
        sketch[at, (bit >> np.uint64(6)).astype(np.int64)] ^= np.uint64(1) << (bit & np.uint64(63))
        if i < BANDS * ROWS:
            band = i // ROWS
            bands[:, band] = bands[:, band] * np.uint64(0x9E3779B97F4A7C15) + spot
    for b in range(BANDS):
        bands[:, b] = mix(bands[:, b] + np.uint64(b))
    return bands, sketch


def _lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(values).reshape(-1).view(np.int64))
    )


SIGNED = [
    ("n", "bigint", pa.int64()),
    ("set_a", "bigint", pa.int64()),
    ("set_b", "bigint", pa.int64()),
    ("bands", "array<bigint>", pa.list_(pa.int64())),
    ("sketch", "array<bigint>", pa.list_(pa.int64())),
]


def _signed(texts: pa.LargeBinaryArray, size: int) -> list:
    h, cut = shingle_sets(texts, size)
    n = np.diff(cut)
    full = np.flatnonzero(n)
    a, b = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
    bands, sketch = np.zeros((len(n), BANDS), np.uint64), np.zeros((len(n), LONGS), np.uint64)
    if len(full):
        begin = cut[:-1][full]
        a[full] = np.add.reduceat(mix(h.copy()), begin)
        b[full] = np.add.reduceat(mix(h * np.uint64(0xE7037ED1A0B428DB) + np.uint64(1)), begin)
        bands[full], sketch[full] = signatures(h, np.append(begin, len(h)))
    return [pa.array(n), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), _lists(bands), _lists(sketch)]


def apart(a: Column, b: Column) -> Column:
    """Ones in the exclusive or of two sketches."""
    total = F.lit(0)
    for k in range(LONGS):
        total = total + F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k))))
    return total


def most_apart(similarity: float) -> int:
    """Ones that two sketches of sets of this similarity have, as expected.

    2 k (1 - J) samples flip bits of only one of the two; of m flips among n bits an odd
    number hits (1 - (1 - 2 / n) ** m) / 2 of the bits.
    """
    flips = 2 * SAMPLES * (1 - similarity)
    return int(SKETCH_BITS * (1 - (1 - 2 / SKETCH_BITS) ** flips) / 2)


def components(edges: DataFrame, store: Store) -> DataFrame:
    """node and label of all nodes on edges (a, b); the label is the least node reached.

    In each round every node joins its neighbour of most edges, if that has more than
    itself (of equals, by a hash that changes); joined nodes become one and edges within
    are dropped. Stars are gone after one round. All rounds are joins over tables.
    """
    live = store.put(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    steps: list[DataFrame] = []
    turn = 0
    while live.head(1):
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        weight = F.count("*") * F.lit(1 << 32) + F.shiftrightunsigned(F.xxhash64(F.col("a"), F.lit(turn)), 32)
        degree = store.put(both.groupBy("a").agg(weight.alias("weight")), "degree")
        best = (
            both.join(degree.select(F.col("a").alias("b"), "weight"), "b")
            .groupBy("a")
            .agg(F.max_by("b", "weight").alias("to"), F.max("weight").alias("best"))
            .join(degree, "a")
            .select(F.col("a").alias("node"), F.when(F.col("best") > F.col("weight"), F.col("to")).otherwise(F.col("a")).alias("to"))
        )
        best = store.put(best, "step")
        # Twice, so that chains shrink faster.
        step = store.put(
            best.join(best.select(F.col("node").alias("to"), F.col("to").alias("next")), "to").select("node", F.col("next").alias("to")), "step"
        )
        to = lambda side, step=step: step.select(F.col("node").alias(side), F.col("to").alias(f"to_{side}"))
        new = live.join(to("a"), "a").join(to("b"), "b").where("to_a <> to_b")
        fresh = store.put(new.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
        store.drop(live, degree, best)
        live = fresh
        steps.append(step)
        turn += 1
    if not steps:
        return live.select(F.col("a").alias("node"), F.col("b").alias("label"))
    end = steps[0]
    for step in steps[1:]:
        end = end.join(step.select(F.col("node").alias("to"), F.col("to").alias("next")), "to", "left").select(
            "node", F.coalesce("next", "to").alias("to")
        )
    end = store.put(end, "ends")
    least = end.groupBy("to").agg(F.min("node").alias("label"))
    out = store.put(end.join(least, "to").select("node", "label"), "labels")
    store.drop(end, *steps)
    return out


def _blocked(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows dealt out so that every row with ``minor`` set meets all rows of its ``key``.

    Both are cut into blocks (i, j) of about BLOCK rows; ``asks`` marks the rows that are
    there as minor ones. Returned in the order of the blocks within each partition.
    """
    blocks = rows.groupBy(key).agg(
        F.ceil(F.count_if("minor") / BLOCK).cast("int").alias("minors"), F.ceil(F.count("*") / BLOCK).cast("int").alias("alls")
    )
    placed = rows.join(blocks, key).withColumn("spot", F.xxhash64("node"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    met = placed.where("minors > 0").withColumn("i", every("minors")).withColumn("j", F.pmod("spot", "alls").cast("int"))
    asks = placed.where("minor").withColumn("i", F.pmod("spot", "minors").cast("int")).withColumn("j", every("alls"))
    order = [key, "i", "j"]
    both = met.select(*order, *columns, F.lit(False).alias("asks")).unionByName(asks.select(*order, *columns, F.lit(True).alias("asks")))
    return both.repartition(*order).sortWithinPartitions(*order)


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, str, str]) -> Iterator[pa.RecordBatch]:
    """Sorted batches as one batch per group; a group is a block and so of bounded size."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy() for c in keys])
        edges = np.flatnonzero(np.any(key[:, 1:] != key[:, :-1], axis=0)) + 1
        starts = np.append(0, edges)
        for x, y in zip(starts, edges, strict=False):
            yield batch.slice(x, y - x)
        held = batch.slice(starts[-1])  # the last one may go on in the next batch
    if held is not None and held.num_rows:
        yield held


def _sides(group: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    asks = group.column("asks").to_numpy(zero_copy_only=False)
    return np.flatnonzero(asks), np.flatnonzero(~asks)


PAIRS = "a long, b long"


def _pair_batch(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _across(rows: DataFrame, most: int) -> DataFrame:
    """Pairs (a, b) of different families of a bucket whose sketches are close.

    ``rows``: h, node, label, sketch and minor. The minor families of a bucket are
    compared with all of it, block by block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ("h", "i", "j")):
            node, label = group.column("node").to_numpy(), group.column("label").to_numpy()
            sketch = group.column("sketch").flatten().to_numpy().view(np.uint64).reshape(-1, LONGS)
            asks, rest = _sides(group)
            a, b = [], []
            for s in asks:
                other = rest[label[rest] != label[s]]
                close = other[np.bitwise_count(sketch[other] ^ sketch[s]).sum(axis=1) <= most]
                a += [node[s]] * len(close)
                b += node[close].tolist()
            yield _pair_batch(a, b)

    pairs = _blocked(rows, "h", ["node", "label", "sketch"]).mapInArrow(run, PAIRS)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _rest(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that are left, from weights and common elements of D alone.

    ``rows``: family, node, label, w, d and minor. For each minor row and block one link
    to each other label is enough. Elements that no minor row of a block has cannot be
    shared with one, so a block's matrices have a column for each that one has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ("family", "i", "j")):
            node, label, w = (group.column(c).to_numpy() for c in ("node", "label", "w"))
            lists = group.column("d")
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            element = lists.flatten().to_numpy()
            asks, rest = _sides(group)
            known = np.unique(element[np.isin(owner, asks)])
            at = np.searchsorted(known, element)
            held = np.zeros(len(element), bool)
            held[at < len(known)] = known[at[at < len(known)]] == element[at < len(known)]
            common = np.zeros((len(asks), len(rest)), np.float32)
            for start in range(0, len(known), COLUMNS):
                now = held & (at >= start) & (at < start + COLUMNS)
                matrix = np.zeros((len(lists), min(COLUMNS, len(known) - start)), np.float32)
                matrix[owner[now], at[now] - start] = 1
                common += matrix[asks] @ matrix[rest].T
            a, b = [], []
            for k, s in enumerate(asks):
                fits = rest[(w[s] + w[rest] <= 2 * (100 + percent) * common[k].astype(np.int64)) & (label[rest] != label[s])]
                _, first = np.unique(label[fits], return_index=True)
                a += [node[s]] * len(first)
                b += node[fits[first]].tolist()
            yield _pair_batch(a, b)

    return _blocked(rows, "family", ["node", "label", "w", "d"]).mapInArrow(run, PAIRS)


def _families(nodes: DataFrame, store: Store, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs, and label of the family of each node that has any."""
    wide, narrow = most_apart(similarity - FAMILY), most_apart(similarity - PAIR)
    bands = nodes.select("node", F.posexplode("bands").alias("band", "h"))
    # Few draws, so that a group of near copies has few leaders and few pairs with them.
    drawn = F.min_by("node", F.xxhash64(F.col("band") % DRAWS, "node"))
    buckets = bands.groupBy("h").agg(F.count("*").alias("size"), drawn.alias("leader")).where("size > 1")
    bands = bands.drop("band")
    members = store.put(bands.join(buckets, "h"), "members")
    pairs = members.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    sketches = nodes.select("node", "sketch")
    side = lambda s: sketches.select(F.col("node").alias(s), F.col("sketch").alias(f"sketch_{s}"))
    near = store.put(
        pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", apart(F.col("sketch_a"), F.col("sketch_b")).alias("apart")).where(F.col("apart") <= wide),
        "near",
    )
    family = components(near, store)
    # Buckets of three or more that hold several families: their other pairs.
    of = members.where("size > 2").join(family, "node", "left").withColumn("label", F.coalesce("label", "node"))
    counted = family.groupBy("label").agg(F.count("*").alias("members"))
    of = store.put(of.join(counted, "label", "left").withColumn("members", F.coalesce("members", F.lit(1))), "of")
    major = of.groupBy("h").agg(F.max_by("label", "members").alias("major"), F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = of.join(major.where("low <> high").select("h", "major"), "h").withColumn("minor", F.col("label") != F.col("major"))
    mixed = store.put(mixed.select("h", "node", "label", "minor"), "mixed")
    across = store.put(_across(mixed.join(sketches, "node"), narrow), "across")
    store.drop(members, of, mixed)
    if across.head(1):
        family = components(near.select("a", "b").unionByName(across), store)
    # Of the pairs with leaders, each node's closest is worth a look at full sets.
    closest = near.groupBy("a").agg(F.min_by("b", "apart").alias("b"))
    return closest.unionByName(across), family


def _linked(percent: int) -> Column:
    return 100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, shared, n_a, n_b on full sets."""
    side = lambda s: sets.select(F.col("node").alias(s), F.col("hashes").alias(f"set_{s}"))
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .select(
            "a",
            "b",
            F.size(F.array_intersect("set_a", "set_b")).cast("bigint").alias("shared"),
            F.size("set_a").cast("bigint").alias("n_a"),
            F.size("set_b").cast("bigint").alias("n_b"),
        )
    )


def _links(pairs: DataFrame, family: DataFrame, sets: DataFrame, store: Store, percent: int) -> DataFrame:
    """Links (a, b) that join all nodes that links connect, within families."""
    first = family.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))
    asked = pairs.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).unionByName(first).distinct()
    known = store.put(_confirmed(asked, sets), "confirmed")
    links = store.put(known.where(_linked(percent)).select("a", "b"), "links")
    label = components(links, store)

    def mixed(label: DataFrame) -> DataFrame:
        """Families whose nodes are not all linked: family, node and label so far."""
        now = family.select("node", F.col("label").alias("family")).join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
        open_ = now.groupBy("family").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        return now.join(open_.select("family"), "family")

    def weight(n: Column, differing: Column) -> Column:
        return (100 + percent) * differing - (100 - percent) * n

    left = store.put(mixed(label), "open")
    if not left.head(1):
        return links
    # The member that differs least from the first is the second centre.
    from_first = known.join(left.select(F.col("node").alias("a"), F.col("family").alias("b")), ["a", "b"])
    differing = F.col("n_a") + F.col("n_b") - 2 * F.col("shared")
    centre = store.put(from_first.groupBy(F.col("b").alias("family")).agg(F.min_by("a", weight(F.col("n_a"), differing)).alias("centre")), "centre")
    asked = left.join(centre, "family").where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b"))
    around = store.put(
        _confirmed(asked, sets).withColumn("w", weight(F.col("n_a"), differing)).join(centre.withColumnRenamed("centre", "b"), "b"), "around"
    )
    nearest = store.put(around.groupBy("family").agg(F.min_by("a", "w").alias("nearest"), F.min("w").alias("least")), "nearest")
    placed = around.join(nearest, "family")
    links = store.put(
        links.unionByName(around.where(_linked(percent)).select("a", "b")).unionByName(
            placed.where("w + least <= 0 and a <> nearest").select("a", F.col("nearest").alias("b"))
        ),
        "links",
    )
    label = components(links, store)
    left = store.put(mixed(label), "open")
    if not left.head(1):
        return links
    # What is still apart must share elements that the centre lacks, or lack the same.
    main = left.join(centre, "family").where("node = centre").select("family", F.col("label").alias("main"))
    side = lambda s: sets.select(F.col("node").alias(s), F.col("hashes").alias(f"set_{s}"))
    own = left.join(centre, "family").where("node <> centre").join(side("node"), "node").join(side("centre"), "centre")
    own = own.withColumn("d", F.concat(F.array_except("set_node", "set_centre"), F.array_except("set_centre", "set_node")))
    elements = store.put(own.select("family", "node", "label", F.explode("d").alias("element")), "elements")
    # Only elements of nodes of different labels can make a link.
    common = elements.groupBy("family", "element").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    shared = elements.join(common.select("family", "element"), ["family", "element"])
    shared = shared.groupBy("family", "node", "label").agg(F.collect_list("element").alias("d"))
    weights = placed.select(F.col("a").alias("node"), "w", "least")
    # With all of them shared, and the least weight of its family, a node must still reach
    # the threshold.
    able = shared.join(weights, "node").where(F.col("w") + F.col("least") <= 2 * (100 + percent) * F.size("d"))
    able = able.join(main, "family").withColumn("minor", F.col("label") != F.col("main"))
    able = store.put(able.select("family", "node", "label", "w", "d", "minor"), "able")
    return store.put(links.unionByName(_rest(able, percent)), "links")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """Group documents whose sets of ``words``-word shingles are ``percent`` similar.

    Returns one row per document: doc (the key, as a number), mark (a hash of the text,
    which tells rows with one key apart), n_shingles, component_id (the least key that
    links reach, the document itself included), kept (doc = component_id) and first
    (true for one row of each group). A text of fewer words is one shingle. Null and
    empty texts and texts without words have no shingles and are linked with nothing.
    A null key counts as the least. Links are confirmed on full sets; two documents at
    the threshold share no bucket in about 3 of a million cases, and the cut on what the
    sketches say is six of their standard errors below; groups with several links hardly
    notice either.
    """
    store = Store(docs.sparkSession)
    nothing = -(1 << 63)
    named = docs.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(nothing)).alias("doc"),
        F.coalesce(F.hash(text), F.lit(0)).alias("mark"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    # Written, so that the rows' numbers hold for all readers.
    signed = map_texts(named, lambda: lambda t: _signed(t, words), SIGNED, keep=["doc", "mark"])
    rows = store.put(signed.withColumn("row", F.monotonically_increasing_id()), "signed")
    classes = store.put(rows.where("n > 0").groupBy("set_a", "set_b", "n").agg(F.min("row").alias("node")), "classes")
    members = store.put(rows.drop("bands", "sketch").join(classes, ["set_a", "set_b", "n"], "left").select("row", "doc", "mark", "n", "node"), "members")
    nodes = rows.join(classes.select(F.col("node").alias("row")), "row").select(F.col("row").alias("node"), "doc", "mark", "bands", "sketch")
    nodes = store.put(nodes, "nodes")
    store.drop(rows, classes)
    pairs, family = _families(nodes, store, percent / 100)
    pairs = store.put(pairs, "pairs")
    places = store.put(nodes.join(family.select("node"), "node").select("doc", "mark", "node"), "places")

    def hashes(t):
        h, cut = shingle_sets(t, words)
        return [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(h.view(np.int64)))]

    asked = named.join(sendable(places), ["doc", "mark"])
    sets = map_texts(asked, lambda: hashes, [("hashes", "array<bigint>", pa.list_(pa.int64()))], keep=["node"])
    sets = store.put(sets.dropDuplicates(["node"]), "sets")
    links = _links(pairs, family, sets, store, percent)
    label = components(links, store)
    store.drop(sets, nodes)
    grouped = members.join(label, "node", "left").withColumn("label", F.coalesce("label", "node", -1 - F.col("row")))
    grouped = store.put(grouped, "grouped")
    least = grouped.groupBy("label").agg(F.min("doc").alias("component_id"))
    named_ = grouped.join(least, "label")
    firsts = named_.where("doc = component_id").groupBy("label").agg(F.min("row").alias("first"))
    out = store.put(
        named_.join(firsts, "label").select(
            "doc", "mark", F.col("n").alias("n_shingles"), "component_id", (F.col("doc") == F.col("component_id")).alias("kept"), (F.col("row") == F.col("first")).alias("first")
        ),
        "groups",
    )
    store.drop(grouped, members)
    return out


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without all but one of each group, with their own columns."""
    groups = near_groups(docs, key, text, **options)
    stay = groups.where("first").select(F.col("doc").alias("__doc"), F.col("mark").alias("__mark"))
    named = docs.withColumn("__doc", F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 63)))).withColumn("__mark", F.coalesce(F.hash(text), F.lit(0)))
    out = named.join(sendable(stay), ["__doc", "__mark"], "left_semi")
    some = groups.where("n_shingles > 0").select("doc", "mark")
    if some.distinct().count() < some.count():
        # Rows equal in both are repeated; those without words are linked with nothing.
        blank = F.length(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", "")) == 0
        out = out.where(~blank).dropDuplicates(["__doc", "__mark"]).unionByName(out.where(blank))
    return out.drop("__doc", "__mark")


def digest(docs: DataFrame) -> DataFrame:
    groups = near_groups(docs.select("doc_id", "text"), words=4)
    least = F.lit(-(1 << 63))
    return groups.select(
        F.nullif("doc", least).alias("doc_id"), "n_shingles", F.nullif("component_id", least).alias("component_id"), "kept"
    )


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
r AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT r.d, l.b FROM r JOIN l ON l.a = r.c)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.c AS component_id, w.doc_id = c.c AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT d, min(c) AS c FROM r GROUP BY d) c ON c.d = w.doc_id
"""
