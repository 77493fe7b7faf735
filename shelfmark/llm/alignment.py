"""Two tokenizers side by side: which tokens of one cover which of the other.

Each text is encoded by both libraries; the bytes of its tokens must be the text's. In a batch
the tokens of each side are rows (document, start, end); ``pandas.merge_asof``, keyed by
document, finds for each token's start the token of the other side that covers it. The two
directions together are all overlapping pairs, each once. Pairs that end together are links,
and their ends cut the text into groups. How often an id pair is linked is counted over the
whole corpus; a document's links are then rated by these counts: pairs that hold a good share
of all links, which are few by arithmetic, are sent to all tasks, the others are shuffled,
where none is frequent any more.

Texts are cut before a space between a word and a letter, where both tokenizers begin a token
whatever stands around. A stretch between two cuts is encoded once while a worker remembers it.
A long text is aligned in pieces that follow each other in counts, hash and pairs, so that
memory is that of a megabyte of text. A text that is null or empty, or whose
tokens' bytes are not its own, has no tokens: counts of zero, no pairs, an empty hash.
Repeated rows count as often as they stand; keys are only passed on.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Store, map_texts
from shelfmark.operators.once import once_per_worker

# Letters of a piece at least, and bytes of text whose tokens are rows at once.
PIECE = 1 << 16
SECTION_BYTES = 1 << 19

# A pair with this share of all links is sent to all tasks; there are no more than its inverse.
FREQUENT = 1 << 17

# Stretches that a worker remembers the ids of, and letters of such a stretch at most.
KEPT = 400_000
KEPT_LETTERS = 64

# Where both tokenizers begin a token whatever stands around, and no piece reaches across.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_CUT = re.compile(f"(?<=[{_LETTERS}0-9.,]) (?=[{_LETTERS}])")
_FIRST = frozenset(re.findall(f"[{_LETTERS}]", "".join(map(chr, range(256)))))
_LAST = _FIRST | frozenset("0123456789.,")

# Stretches between cuts that are encoded as one text.
TOGETHER = 500

_PAIR = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())])
_GROUP = pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])

#: What :func:`with_alignment` can add.
COLUMNS = {
    "n_a": ("n_a", "long", pa.int64()),
    "n_b": ("n_b", "long", pa.int64()),
    "n_groups": ("n_groups", "long", pa.int64()),
    "n_links": ("n_links", "long", pa.int64()),
    "n_overlaps": ("n_overlaps", "long", pa.int64()),
    "groups_sha256": ("groups_sha256", "string", pa.string()),
    "links": ("links", "array<struct<a:int,b:int,n:int>>", pa.list_(_PAIR)),
    "groups": ("groups", "array<struct<a:array<int>,b:array<int>>>", pa.list_(_GROUP)),
}


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with. Printable
    ones stand for themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Side:
    """A tokenizer as ids of texts, and the bytes, lengths and decimal forms of ids."""

    def __init__(self, path: str):
        if path.endswith(".json"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            library.encode_special_tokens = True  # their strings are text
            kind = json.loads(library.to_str())["pre_tokenizer"] or {}
            if kind.get("type") != "ByteLevel":
                raise ValueError(f"{path} is no byte-level vocabulary")
            letters, size = byte_letters(), library.get_vocab_size()
            self.bytes = [bytes(letters[c] for c in t) if (t := library.id_to_token(i)) and all(c in letters for c in t) else (t or "").encode() for i in range(size)]
            self.encode = lambda texts: [e.ids for e in library.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
            self.cuts = True
        else:
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=path)
            pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
            self.bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
            self.encode = lambda texts: model.encode(texts, num_threads=1)
            self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def tokens(self, texts: list[str]) -> list[bytes | None]:
        """The ids of each text as bytes of int32, or None if their bytes are not a space and the text."""
        out = []
        for text, ids in zip(texts, self.encode(texts), strict=True):
            same = b"".join(map(self.bytes.__getitem__, ids)) == b" " + text.encode()
            out.append(array("i", ids).tobytes() if same else None)
        return out

    def tokens_between_cuts(self, stretches: list[str]) -> list[bytes | None]:
        """The same for stretches that a cut can stand before and behind: encoded as one text,
        whose tokens are dealt out by their ends."""
        ids = array("i", self.encode([" ".join(stretches)])[0]).tobytes()
        written = [b" " + s.encode() for s in stretches]
        numbers = np.frombuffer(ids, np.int32)
        if b"".join(map(self.bytes.__getitem__, numbers.tolist())) != b"".join(written):
            return self.tokens(stretches)
        ends = np.cumsum(self.lengths[numbers])
        stops = (4 * np.searchsorted(ends, np.cumsum([len(w) for w in written]), side="right")).tolist()
        return [ids[lo:hi] for lo, hi in zip([0, *stops], stops)]


class _Pair:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = _Side(path_a), _Side(path_b)
        self.cuts = self.a.cuts and self.b.cuts
        # What follows an id in a document's written groups: ',' in a group, '|' or ';' at its end.
        self.written = [f"{i}{c}" for side, ends in ((self.a, ",|"), (self.b, ",;")) for i in range(len(side.bytes)) for c in ends]
        self.kept: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def tokens(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and B of all pieces, how many each has, and whether their bytes are its
        own; a piece of which they are not has none."""
        split = [_CUT.split(p) if self.cuts else [p] for p in pieces]
        told = self._look_up({stretch for own in split for stretch in own})
        both = [[told[stretch] for stretch in own] for own in split]
        sound = [None not in own for own in both]
        sides = [[b"".join([x[k] for x in own]) if ok else b"" for own, ok in zip(both, sound, strict=True)] for k in (0, 1)]
        ids = [np.frombuffer(b"".join(side), np.int32) for side in sides]
        counts = [np.array([len(x) // 4 for x in side], np.int64) for side in sides]
        return ids[0], counts[0], ids[1], counts[1], np.array(sound, bool)

    def _look_up(self, stretches: set[str]) -> dict[str, tuple | None]:
        """What is kept is used again or encoded; of two generations the older one goes."""
        told, new = {}, []
        for stretch in stretches:
            if stretch in self.kept:
                told[stretch] = self.kept[stretch]
            elif stretch in self.older:
                told[stretch] = self.kept[stretch] = self.older[stretch]
            else:
                new.append(stretch)
        inner, outer = [], []
        for stretch in new:
            whole = self.cuts and stretch[:1] in _FIRST and stretch[-1:] in _LAST
            (inner if whole else outer).append(stretch)
        found = [(outer, self.a.tokens, self.b.tokens)]
        for i in range(0, len(inner), TOGETHER):
            found.append((inner[i : i + TOGETHER], self.a.tokens_between_cuts, self.b.tokens_between_cuts))
        for some, of_a, of_b in found:
            for stretch, a, b in zip(some, of_a(some), of_b(some), strict=True):
                told[stretch] = None if a is None or b is None else (a, b)
                if len(stretch) <= KEPT_LETTERS:
                    self.kept[stretch] = told[stretch]
        if len(self.kept) > KEPT:
            self.kept, self.older = {}, self.kept
        return told

    def pieces(self, text: str) -> Iterator[str]:
        start = 0
        while start < len(text):
            cut = _CUT.search(text, start + PIECE) if self.cuts else None
            stop = cut.start() if cut else len(text)
            yield text[start:stop]
            start = stop + 1  # both begin a piece with a space of their own


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """Pairs of rows of two frames ``(doc, start, end)`` whose ranges overlap, as their
    numbers ``a`` and ``b``. Each side's ranges fill their document without a gap, and rows
    are in the order of ``start``, which counts on through the documents."""
    sides = {"a": a, "b": b}
    starts = {name: side["start"].to_numpy() for name, side in sides.items()}
    found = []
    for this, other in ("ab", "ba"):
        keyed = sides[other][["doc", "start"]].assign(**{other: np.arange(len(sides[other]))})
        covering = pd.merge_asof(sides[this][["doc", "start"]], keyed, on="start", by="doc")[other].to_numpy()
        found.append({this: np.arange(len(covering)), other: covering})
    # Where both start at once, the pair stands in both directions.
    again = starts["a"][found[1]["a"]] == starts["b"]
    return pd.DataFrame({side: np.concatenate([found[0][side], found[1][side][~again]]) for side in "ab"})


def _ranges(lengths: np.ndarray, docs: np.ndarray) -> pd.DataFrame:
    ends = np.cumsum(lengths)
    return pd.DataFrame({"doc": docs, "start": ends - lengths, "end": ends})


class _Row:
    """What the pieces of a text have come to."""

    def __init__(self):
        self.sound, self.counts = True, np.zeros(5, np.int64)
        self.hash, self.links, self.groups = hashlib.sha256(), [], []

    def columns(self) -> dict:
        if not self.sound or not self.counts[0]:
            return {"counts": np.zeros(5, np.int64), "groups_sha256": "", "links": np.zeros((0, 3), np.int64), "groups": []}
        keys, n = np.concatenate([k for k, _ in self.links]), np.concatenate([n for _, n in self.links])
        if len(self.links) > 1:
            keys, inverse = np.unique(keys, return_inverse=True)
            n = np.bincount(inverse, n).astype(np.int64)
        links = np.stack([keys >> 32, keys & 0xFFFFFFFF, n], axis=1)
        return {"counts": self.counts, "groups_sha256": self.hash.hexdigest(), "links": links, "groups": self.groups}


def _align(pair: _Pair, pieces: list[tuple[_Row, str, bool]], lists: bool) -> None:
    """Add the alignment of some pieces to their rows. A piece carries whether it is the
    first of its row."""
    ids_a, n_a, ids_b, n_b, sound = pair.tokens([p for _, p, _ in pieces])
    for (row, _, _), ok in zip(pieces, sound, strict=True):
        row.sound &= bool(ok)
    numbers = np.arange(len(pieces))
    a, b = (_ranges(side.lengths[ids], np.repeat(numbers, n)) for side, ids, n in ((pair.a, ids_a, n_a), (pair.b, ids_b, n_b)))
    met = overlaps(a, b)
    at_a, at_b = met["a"].to_numpy(), met["b"].to_numpy()
    ends_a, ends_b, doc_a = a["end"].to_numpy(), b["end"].to_numpy(), a["doc"].to_numpy()
    linked = ends_a[at_a] == ends_b[at_b]
    link_a, link_b = at_a[linked], at_b[linked]
    link_doc = doc_a[link_a]
    key = ids_a[link_a].astype(np.int64) << 32 | ids_b[link_b]
    order = np.lexsort((key, link_doc))
    key, of = key[order], link_doc[order]
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (of[1:] != of[:-1])])) if len(key) else np.zeros(0, np.int64)
    times, key, of = np.diff(np.append(first, len(order))), key[first], of[first]
    # Tokens of both sides in the order of groups: a group's tokens of A, then those of B.
    last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    last_a[link_a] = last_b[link_b] = True
    size = len(ids_a) + len(ids_b)
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    n_groups = int(last_a.sum())
    before_a = np.cumsum(np.bincount(group_a, minlength=n_groups))
    before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=n_groups))])
    codes = np.empty(size, np.int64)
    codes[np.arange(len(ids_a)) + before_b[group_a]] = 2 * ids_a + last_a
    codes[np.arange(len(ids_b)) + before_a[group_b]] = 2 * len(pair.a.bytes) + 2 * ids_b.astype(np.int64) + last_b
    table = pair.written
    words = list(map(table.__getitem__, codes.tolist())) if size else []
    stop_a, stop_b, stops = np.cumsum(n_a), np.cumsum(n_b), np.searchsorted(of, numbers, side="right")
    groups = np.bincount(doc_a[last_a], minlength=len(pieces))
    links, pairs = np.bincount(link_doc, minlength=len(pieces)), np.bincount(doc_a[at_a], minlength=len(pieces))
    tokens = stop_a + stop_b
    for i, (row, _, begins) in enumerate(pieces):
        if not sound[i]:
            continue
        row.counts += [n_a[i], n_b[i], groups[i], links[i], pairs[i]]
        lo = tokens[i - 1] if i else 0
        text = "".join(words[lo : tokens[i]])[:-1]
        row.hash.update((text if begins else ";" + text).encode())
        here = slice(stops[i - 1] if i else 0, stops[i])
        row.links.append((key[here], times[here]))
        if lists:
            row.groups += [{side: [int(x) for x in part.split(",")] for side, part in zip("ab", g.split("|"), strict=True)} for g in text.split(";")]


def with_alignment(
    docs: DataFrame, path_a: str, path_b: str, text: str = "text", keep: Sequence[str] | None = None, outputs: Sequence[str] = tuple(COLUMNS)
) -> DataFrame:
    """Adds the columns named in ``outputs`` (see ``COLUMNS``), in batches and without a
    shuffle. A is a byte-level ``tokenizers`` file, which gets a space before the text, B a
    ``sentencepiece`` model that puts one there itself. ``n_links`` counts pairs of tokens
    that end together, ``n_overlaps`` all pairs that share a byte; ``links`` holds the
    different id pairs of the links, ``groups`` the ids of each group in order. An input
    column named like an output gives way to it."""
    lists = "groups" in outputs

    def start():
        pair = once_per_worker("alignment", (path_a, path_b), lambda: _Pair(path_a, path_b))

        def step(texts: pa.LargeBinaryArray) -> list:
            rows, waiting, held = [], [], 0
            for value in texts:
                rows.append(_Row())
                for n, piece in enumerate(pair.pieces(value.as_py().decode())):
                    waiting.append((rows[-1], piece, n == 0))
                    held += len(piece)
                    if held >= SECTION_BYTES:
                        _align(pair, waiting, lists)
                        waiting, held = [], 0
            if waiting:
                _align(pair, waiting, lists)
            told = [r.columns() for r in rows]
            counts = np.array([t["counts"] for t in told], np.int64).reshape(-1, 5)
            made = dict(zip(("n_a", "n_b", "n_groups", "n_links", "n_overlaps"), counts.T, strict=True))
            made["groups_sha256"] = [t["groups_sha256"] for t in told]
            links = np.concatenate([t["links"] for t in told]) if told else np.zeros((0, 3), np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(t["links"]) for t in told])]).astype(np.int32)
            struct = pa.StructArray.from_arrays([pa.array(links[:, i].astype(np.int32)) for i in range(3)], fields=list(_PAIR))
            made["links"] = pa.ListArray.from_arrays(offsets, struct, type=pa.list_(_PAIR))
            made["groups"] = [t["groups"] for t in told]
            return [made[name] for name in outputs]

        return step

    return map_texts(docs, start, [COLUMNS[name] for name in outputs], text, keep=None if keep is None else list(keep))


def rated(aligned: DataFrame, row: str, store: Store, frequent: int = FREQUENT) -> DataFrame:
    """``(row, n_best, count_sum)`` of rows with links, from a stored table with ``links``
    and a unique column ``row``: links whose pair is linked as often as any of its B id,
    corpus-wide, and the sum of the pairs' counts over the links.

    A document is one row per different pair. Pairs with a ``frequent``-th of all links, so
    at most ``frequent`` of them, are broadcast; of the others none has more."""
    links = aligned.select(F.col(row).alias("row"), F.inline("links"))
    counts = store.put(links.groupBy("a", "b").agg(F.sum("n").alias("count")), "pairs")
    total = counts.agg(F.sum("count")).first()[0] or 0
    highest = F.broadcast(counts.groupBy("b").agg(F.max("count").alias("highest")))  # at most B's vocabulary
    counts = counts.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))
    often = F.col("count") * frequent >= total
    few, others = F.broadcast(counts.where(often)), counts.where(~often)
    sums = [F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")]
    near = links.join(few, ["a", "b"]).groupBy("row").agg(*sums)
    far = links.join(few, ["a", "b"], "left_anti").join(others, ["a", "b"]).groupBy("row").agg(*sums)
    return near.unionByName(far).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def digest(docs: DataFrame, paths: tuple[str, str] | None = None, frequent: int = FREQUENT) -> DataFrame:
    store = Store(docs.sparkSession)
    outputs = [c for c in COLUMNS if c != "groups"]
    aligned = with_alignment(docs.select("doc_id", "text"), *(paths or default_paths()), keep=["doc_id"], outputs=outputs)
    aligned = store.put(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    told = aligned.drop("links").join(rated(aligned, "row", store, frequent), "row", "left")
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")}
    return told.withColumns(zero).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")
