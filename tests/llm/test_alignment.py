"""Alignment of two tokenizers against offsets found one by one."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pandas as pd
import pytest
from helpers import EDGES, LONG, edge_docs
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from shelfmark.llm import alignment
from shelfmark.llm.common import Store

PATHS = alignment.default_paths()
LETTERS = alignment.byte_letters()


def sides(text):
    a, b = Tokenizer.from_file(PATHS[0]), SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(LETTERS[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    want = (" " + text).encode()
    if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return [], []

    def ranges(ids, parts):
        out, at = [], 0
        for i, p in zip(ids, parts, strict=True):
            out.append((i, at, at + len(p)))
            at += len(p)
        return out

    return ranges(ids_a, bytes_a), ranges(ids_b, bytes_b)


def plain(texts):
    docs, counts = [], Counter()
    for text in texts:
        a, b = sides(text or "")
        by_end = {e: i for i, _, e in b}
        links = [(i, by_end[e]) for i, _, e in a if e in by_end]
        groups, ga, gb, rest = [], [], [], list(b)
        for i, _, e in a:
            ga.append(str(i))
            if e in by_end:
                while rest and rest[0][2] <= e:
                    gb.append(str(rest.pop(0)[0]))
                groups.append(f"{','.join(ga)}|{','.join(gb)}")
                ga, gb = [], []
        n_overlaps, k = 0, 0
        for _, s, e in a:
            while k < len(b) and b[k][2] <= s:
                k += 1
            n_overlaps += sum(1 for x in b[k : k + e - s] if x[1] < e)
        counts.update(links)
        docs.append((len(a), len(b), len(groups), links, n_overlaps, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [(na, nb, ng, len(ls), sum(counts[x] == highest[x[1]] for x in ls), sum(counts[x] for x in ls), sha, no) for na, nb, ng, ls, no, sha in docs]


def odd_texts():
    rng = random.Random(3)
    parts = ["the", " token", "  ", "\n", "ünï", "人", "\U0001f600", "<s>", "<|endoftext|>", "don't", "1234", "▁", "é", "\x00", "\r\n", "ization", ".", " ", " "]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(120)]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 1, 40], ids=["all sent", "all shuffled", "both"])
def test_digest(spark, frequent):
    texts = [*odd_texts(), None, "", " ", "same text", "same text"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = {r.doc_id: tuple(r)[1:] for r in alignment.digest(df, frequent=frequent).collect()}
    assert [rows[i] for i in range(len(texts))] == plain(texts)


def test_pieces_change_nothing(spark, monkeypatch):
    text = " ".join(odd_texts()).replace("▁", "") + " " + LONG[:30_000]
    pair = alignment._Pair(*PATHS)
    want = plain([text])[0]
    for size, section in ((1 << 16, 1 << 19), (40, 1), (200, 900)):
        monkeypatch.setattr(alignment, "PIECE", size)
        pieces = list(pair.pieces(text))
        assert " ".join(pieces) == text and (size > 1000 or len(pieces) > 50)
        row, waiting = alignment._Row(), []
        for n, piece in enumerate(pieces):
            waiting.append((row, piece, n == 0))
            if sum(len(p) for _, p, _ in waiting) >= section:
                alignment._align(pair, waiting, True)
                waiting = []
        if waiting:
            alignment._align(pair, waiting, True)
        told = row.columns()
        assert (*told["counts"][:4], told["counts"][4], told["groups_sha256"]) == (*want[:4], want[7], want[6])
        written = ";".join(",".join(map(str, g["a"])) + "|" + ",".join(map(str, g["b"])) for g in told["groups"])
        assert hashlib.sha256(written.encode()).hexdigest() == want[6]
        assert told["links"][:, 2].sum() == want[3]


def test_overlaps_are_the_union_of_both_directions():
    a = pd.DataFrame({"doc": [0, 0, 0, 1], "start": [0, 1, 4, 6], "end": [1, 4, 6, 9]})
    b = pd.DataFrame({"doc": [0, 0, 1, 1], "start": [0, 3, 6, 7], "end": [3, 6, 7, 9]})
    assert sorted(map(tuple, alignment.overlaps(a, b).to_numpy().tolist())) == [(0, 0), (1, 0), (1, 1), (2, 1), (3, 2), (3, 3)]


@pytest.mark.parametrize("rows", [None, []], ids=["rows", "empty"])
def test_edges(spark, rows):
    docs = edge_docs(spark, rows)
    out = alignment.with_alignment(docs, *PATHS)
    assert {*docs.columns} - {"n_tokens"} <= {*out.columns} and {*alignment.COLUMNS} <= {*out.columns}
    for r in out.collect():
        assert (r.n_a > 0) == bool(r.text) == (r.groups_sha256 != "")
        assert len(r.groups) == r.n_groups and sum(x.n for x in r.links) == r.n_links
    assert alignment.digest(docs).count() == (len(EDGES) if rows is None else 0)


def test_frequent_pairs_are_bounded(spark):
    df = spark.createDataFrame([(i, f"a b c d{i % 7}") for i in range(60)], "doc_id long, text string")
    store = Store(spark)
    aligned = store.put(alignment.with_alignment(df, *PATHS, keep=["doc_id"], outputs=["links"]), "aligned")
    assert alignment.rated(aligned, "doc_id", store, 3).count() == 60
