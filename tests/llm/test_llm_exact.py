"""Operators against brute force and against the libraries they have to agree with."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import os
import random
import tempfile
import textwrap
import time
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from conftest import plan_of
from helpers import sentence, shingles, words
from pyspark.sql import functions as F

from shelfmark.llm import classlm, decontaminate, extract, fingerprint, licenses, neardup, pieces, suffixdedup, tokencount, toxicity
from shelfmark.llm.common import binary


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


# Near duplicates


def groups(texts, size, percent):
    sets = [shingles(t, size) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def near_copies(seed):
    """A large group of copies with up to eight changed words, chains, exact copies and
    texts that share a long passage."""
    rng = random.Random(seed)
    base = sentence(rng, 150)
    texts = []
    for _ in range(150):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4, 5, 6, 8])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    chain = sentence(rng, 120)
    for i in range(12):
        chain[10 * i : 10 * i + 2] = [f"y{i}a", f"y{i}b"]
        texts += [" ".join(chain)] * (1 + i % 2)
    passage = sentence(rng, 80)
    for _ in range(60):
        texts.append(" ".join(passage + sentence(rng, rng.randrange(10, 90), 9000)))
    texts += ["", None, "one two", "one two", "ONE two", "one two three", "Ünïcode x y z"]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed,size", [(1, 4)])
def test_near_groups(spark, seed, size):
    texts = near_copies(seed)
    want, counts = groups(texts, size, 80)
    rows = {r.doc: r for r in neardup.near_groups(frame(spark, texts), words=size).collect()}
    assert [rows[i].component_id for i in range(len(texts))] == want
    assert [rows[i].n_shingles for i in range(len(texts))] == counts


def test_blocks_across_families(spark, monkeypatch):
    """Large buckets of several families are compared in blocks, with equal results."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    texts = near_copies(3)
    want, _ = groups(texts, 4, 80)
    rows = {r.doc: r.component_id for r in neardup.near_groups(frame(spark, texts), words=4).collect()}
    assert [rows[i] for i in range(len(texts))] == want


def test_odd_sketch_estimates():
    rng = random.Random(5)
    for share in (0.5, 0.7, 0.8, 0.9, 0.97):
        miss = []
        for _ in range(20):
            both = [rng.getrandbits(64) for _ in range(600)]
            own = round(600 * (1 - share) / share / 2)
            a, b = (np.unique(np.array(both + [rng.getrandbits(64) for _ in range(own)], np.uint64)) for _ in range(2))
            h = np.concatenate([a, b])
            _, sketch = neardup.signatures(h, np.array([0, len(a), len(h)]))
            ones = int(np.bitwise_count(sketch[0] ^ sketch[1]).sum())
            flips = math.log(1 - 2 * ones / neardup.SKETCH_BITS) / math.log(1 - 2 / neardup.SKETCH_BITS)
            miss.append(1 - flips / (2 * neardup.SAMPLES) - share)
        assert abs(np.mean(miss)) < 0.03 and np.std(miss) < 0.06


def test_components_of_chains_and_stars(spark):
    store = neardup.Store(spark)
    rng = random.Random(9)
    names = list(range(300))
    rng.shuffle(names)
    edges = list(zip(names[:99], names[1:100], strict=True)) + [(names[150], names[i]) for i in range(151, 250)] + [(names[260], names[260])]
    label = {r.node: r.label for r in neardup.components(spark.createDataFrame(edges, "a long, b long"), store).collect()}
    assert {label[n] for n in names[:100]} == {min(names[:100])} and {label[n] for n in names[150:250]} == {min(names[150:250])}


# Suffix arrays


def removed(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(x[i : i + length] for x in raw for i in range(len(x) - length + 1))
    out = []
    for x in raw:
        gone = np.zeros(len(x) + 1, int)
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(x), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(x, np.uint8)[~gone])).hexdigest()))
    return out


def passages(seed):
    rng = random.Random(seed)
    shared = [" ".join(sentence(rng, n, 5000)) for n in (30, 40, 45, 60, 120)] + ["é" * 150, "ab" * 400, "a" * 199, "b" * 200]
    texts = [None, "", "x" * 199, "y" * 200, "y" * 201, "z" * 1000]
    for _ in range(80):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            parts.append(" ".join(sentence(rng, rng.randrange(0, 60), 9000)))
            if rng.random() < 0.6:
                p = rng.choice(shared)
                cut = rng.randrange(0, 30)
                parts.append(p[cut : len(p) - rng.randrange(0, 30)])
        texts.append(rng.choice([" ", ""]).join(parts))
    return texts + texts[10:14]


@pytest.mark.parametrize("seed,together,batches", [(1, 2048, 4), (2, 2, 3)])
def test_removed_bytes(spark, monkeypatch, seed, together, batches):
    monkeypatch.setattr(suffixdedup, "TOGETHER", together)
    texts = passages(seed)
    out = suffixdedup.without_repeats(frame(spark, texts), batches=batches)
    rows = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()}
    assert [rows[i] for i in range(len(texts))] == removed(texts, 200)


# Decontamination


def test_overlaps(spark):
    rng = random.Random(4)
    items = [(i, " ".join(sentence(rng, rng.choice([3, 12, 13, 14, 30]), 50))) for i in range(40)] + [(50, "Ünï-cödé, Zwölf!"), (51, "...")]
    texts = [" ".join(sentence(rng, rng.randrange(0, 80), 50)) for _ in range(60)]
    for i in range(40):
        w = items[i % 40][1].upper().split()
        texts.append(" ".join(sentence(rng, 9, 50)) + " - " + "; ".join(w[rng.randrange(2) :]) + "\n" + " ".join(sentence(rng, 9, 50)))
    texts.append("before ünï CÖDÉ? ünï cödé (zwölf) after")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (64 << 20, 300):  # one automaton, many blocks
        out = decontaminate.find_overlaps(frame(spark, texts), bench, block_bytes=size)
        rows = {r.doc_id: r for r in out.collect()}
        for i, text in enumerate(texts):
            own = decontaminate.words(text.encode())
            hit, found = set(), set()
            for item, body in items:
                for w in decontaminate.windows(body.encode(), 13):
                    w = w.split()
                    for k in range(len(own) - len(w) + 1):
                        if own[k : k + len(w)] == w:
                            hit.update(range(k, k + len(w)))
                            found.add(str(item))
            assert (rows[i].n_words, rows[i].n_hit, rows[i]["items"]) == (len(own), len(hit), sorted(found))
            told = [w for s in rows[i].spans for w in decontaminate.words(text[s.start : s.end].encode())]
            assert told == [own[k] for k in sorted(hit)]


# HTML


def test_boilerplate():
    page = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body><header class="site">Site name</header>
    <div id="cookie-notice">We use cookies to make this page better for you.</div><nav><a href=x>Home</a></nav>
    <main><article><header><h1>The   title</h1></header><p>First <b>para</b>graph&nbsp;one &lt;here&gt;.<p>Second<!-- no --> one.
    <div class="ad-slot">Buy this very good thing now, it is cheap.</div><ul><li>point one<li>point two</ul>
    <script>var t="</p>";</script><form>Name <input> <button>Send</button></form><table><tr><td>a<td>b</table>
    <section class="reader-comments"><p>I really liked this article a lot, thank you for it.</p></section></article>
    <aside>Other things to read.</aside></main><footer>&copy; me</footer></body></html>"""
    assert extract.content(page) == ["The title", "First paragraph one <here>.", "Second one.", "point one", "point two", "a", "b"]
    plain = "<body><div><p>" + "This is a long line of text that says a lot. " * 3 + "</p><p>Yes.</p></div><p class=footer>Bye</p>"
    assert extract.content(plain)[-1] == "Yes."


def test_wrappers_named_like_boilerplate():
    line = "This is a long line of text that says a lot. "
    first, second = (line * 3).strip(), (line * 2).strip()
    aside = "<div class='sidebar'><p>Other things that one might want to read here.</p></div>"
    for name in ("has-sidebar", "no-comments", "search-results", "story-with-ads", "page-sidebar", "layout social"):
        for inner in (f"<article><h1>Title</h1><p>{first}</p><p>{second}</p></article>", f"<div><h1>Title</h1><p>{first}</p><p>{second}</p></div>"):
            page = f"<html><body><nav><a href=x>Home</a></nav><div class='{name}'>{inner}{aside}</div><footer>Bye now.</footer></body></html>"
            assert extract.content(page) == ["Title", first, second], page
    comments = f"<div id='comments'><article><p>{first}</p></article></div>"
    assert extract.content(f"<article><p>{first}</p><p>{second}</p></article>{comments}") == [first, second]


def test_silent_elements_end_with_their_parents():
    line = "This is a long line of text that says a lot. " * 3
    for odd in ("<svg/>", "<math />", "<svg><svg></svg>x</svg>", "<div><select><option>a</div>", "<p><object data=x>o</p>", "<template><p>t</template>", "<select>"):
        for end in ("", "</body></html>"):
            page = f"<html><head><title>T</title></head><body><p>{line}</p>{odd}<p>{line}</p>{end}"
            assert extract.content(page) == [line.strip()] * 2, page
    assert extract.content(f"<head><title>T</title><p>{line}</p>") == [line.strip()]
    assert len(extract.parse("<select>a" * 3000).blocks) == 3000
    assert extract.content(f"<object><p>{line}</p><object>no</object><p>{line}</p>") == [line.strip()] * 2


def test_minimum_cut_is_least():
    rng = random.Random(6)
    for _ in range(200):
        n = rng.randrange(1, 8)
        costs = [(rng.random() * 3, rng.random() * 3) for _ in range(n)]
        edges = [(a, b, rng.random()) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def total(sides, costs=costs, edges=edges):
            return sum(c[not s] for c, s in zip(costs, sides, strict=True)) + sum(w for a, b, w in edges if sides[a] != sides[b])

        got = extract.minimum_cut(costs, edges)
        assert total(got) == pytest.approx(min(total(s) for s in itertools.product([True, False], repeat=n)))


# Language model


def test_class_model(spark):
    rng = random.Random(7)
    texts = []
    for _ in range(300):  # two languages, a rare word now and then
        own = "ab"[rng.randrange(2)]
        texts.append(" ".join(f"{own}{int(rng.paretovariate(0.8)) % 60}" if rng.random() < 0.9 else f"{own}r{rng.randrange(5000)}" for _ in range(40)))
    held = frame(spark, texts).withColumn("train", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2)
    rows = {r.doc_id: r for r in classlm.with_scores(held, "train", unit_share=1e-3, lookup_share=3e-4, n_classes=8).collect()}
    train = [zlib.crc32(str(i).encode()) % 7 != 2 for i in range(300)]
    c = collections.Counter(w for t, own in zip(texts, train, strict=True) if own for w in [*words(t), None])
    n, v = sum(c.values()), len(c)
    for i, t in enumerate(texts):
        w = [*words(t), None]
        assert (rows[i].n_tokens, rows[i].n_known, rows[i].train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert rows[i].base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
    out = [rows[i] for i in range(300) if not train[i]]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 0.1 * sum(r.n_tokens for r in out)


def test_probabilities_sum_to_one(spark):
    texts = ["a b c a b", "b c d", "rare1 a rare2 b"] * 20
    docs = frame(spark, texts).withColumn("train", F.lit(True))
    model, counts = classlm.fit(docs, unit_share=0.05, lookup_share=0.01, n_classes=3)
    known = {r["hash"]: (r["ending"], r["n_train"]) for r in counts.collect()}
    units = classlm.Units(model.units)
    for before in range(3):
        total = 10 ** (model.transition[before, model.classes[units.end]] + model.emission[units.end])
        for h, (ending, n) in known.items():
            u = int(units.of(np.array([h]), np.array([ending]))[0])
            shared = u >= len(model.units)
            total += 10 ** (model.transition[before, model.classes[u]] + model.emission[u]) * (n + 1 if shared else 1)
        for e in range(classlm.ENDINGS):  # one unknown word in each
            u = len(model.units) + e
            total += 10 ** (model.transition[before, model.classes[u]] + model.emission[u])
        assert total == pytest.approx(1.0)


def test_rare_words_go_with_their_neighbours(spark):
    rng = random.Random(8)
    texts = [" ".join(f"{'xy'[k % 2]}{rng.randrange(3)}" if rng.random() < 0.7 else f"{'pq'[k % 2]}{rng.randrange(9000)}end" for k in range(40)) for _ in range(1500)]
    docs = frame(spark, texts).withColumn("train", F.lit(True))
    model, counted = classlm.fit(docs, unit_share=1e-2, lookup_share=1e-3, n_classes=4)
    rows = {r["hash"]: r["cls"] for r in counted.collect()}
    hashes = {w: int(classlm.hashed_words(binary(pa.array([w])))[0][0]) for w in set(" ".join(texts).split()) if w[0] in "pq"}
    assert len(hashes) > 5000 and all(rows[h] is not None for h in hashes.values())
    by = collections.Counter((w[0], rows[h]) for w, h in hashes.items())
    (p, _), (q, _) = (collections.Counter({c: n for (x, c), n in by.items() if x == y}).most_common(1)[0] for y in "pq")
    assert p != q and by["p", p] + by["q", q] > 0.9 * len(hashes)  # all of them end alike
    one = [r.score for r in classlm.with_scores(docs, "train", unit_share=1e-2, lookup_share=1e-3, n_classes=4).orderBy("doc_id").collect()]
    all_ = [r.score for r in classlm.with_scores(docs, "train", unit_share=1e-2, lookup_share=1e-9, n_classes=4).orderBy("doc_id").collect()]
    assert one == pytest.approx(all_)  # joined or looked up


def test_class_model_as_plain_rounds(spark):
    """Rounds and scores by plain Python, from the classes of frequent words and endings."""
    rng = random.Random(9)
    texts = [" ".join(f"w{int(rng.paretovariate(0.6)) % 900}{'ab'[rng.randrange(2)]}" for _ in range(rng.randrange(30))) for _ in range(400)]
    train = [i % 5 != 0 for i in range(len(texts))]
    docs = frame(spark, texts).withColumn("train", F.col("doc_id") % 5 != 0)
    k, options = 4, {"unit_share": 1e-2, "lookup_share": 1e-3, "n_classes": 4}
    model, counted = classlm.fit(docs, **options)
    got = {r["hash"]: r["cls"] for r in counted.where("n_train > 0").collect()}
    end = int(model.classes[-1])

    def hashed(word):
        h, ending, _ = classlm.hashed_words(binary(pa.array([word])))
        return int(h[0]), int(ending[0])

    n = collections.Counter(w for t, own in zip(texts, train, strict=True) if own for w in words(t))
    key = {w: hashed(w) for t in texts for w in words(t)}
    unit = {int(h): i for i, h in enumerate(model.units)}
    ending = model.classes[len(model.units) : -1]
    cls = {w: int(model.classes[unit[key[w][0]]] if key[w][0] in unit else ending[key[w][1]]) for w in n}
    lines = [[None, *words(t), None] for t, own in zip(texts, train, strict=True) if own]

    def count(cls):
        m = np.zeros((k, k), np.int64)
        for line in lines:
            for a, b in zip(line, line[1:], strict=False):
                m[cls.get(a, end), cls.get(b, end)] += 1
        return m

    matrix = count(cls)
    for _ in range(2):
        into, share = matrix.sum(axis=0) + 1.0, np.log(classlm.transitions(matrix))
        gains = collections.defaultdict(lambda: np.zeros(k))
        for line in lines:
            for a, w, b in zip(line, line[1:], line[2:], strict=False):
                gains[w] += share[cls.get(a, end)] - np.log(into) + share[:, cls.get(b, end)]
        moved = {w: c if key[w][0] in unit else int(np.argmax(gains[w])) for w, c in cls.items()}
        if classlm.likelihood(count(moved)) <= classlm.likelihood(matrix):
            break
        cls, matrix = moved, count(moved)
    assert len(model.units) > 5 and sum(key[w][0] not in unit for w in n) > 300
    assert all(got[key[w][0]] == c for w, c in cls.items() if key[w][0] not in unit)
    assert np.array_equal(model.transition, np.log10(classlm.transitions(matrix)))

    weight = collections.Counter(model.classes.tolist())
    for w, c in cls.items():
        weight[c] += n[w] + (key[w][0] not in unit)
    weight[end] += len(lines)
    rows = {r.doc_id: r.score for r in classlm.with_scores(docs, "train", **options).collect()}
    for i, t in enumerate(texts):
        score, before = 0.0, end
        for w in [*words(t), None]:
            c = end if w is None else cls.get(w, int(ending[key[w][1]]))
            score += model.transition[before, c] + math.log10(((len(lines) if w is None else n[w]) + 1) / weight[c])
            before = c
        assert rows[i] == pytest.approx(score)


@pytest.mark.parametrize("better", [0, 1, 2, 3])
def test_seldom_words_score_as_looked_up_ones(spark, monkeypatch, better):
    """Whichever round is the last that is kept."""
    rng = random.Random(13)
    texts = [" ".join(f"{'xy'[j % 2]}{rng.randrange(3)}" if rng.random() < 0.5 else f"{rng.randrange(400)}{rng.choice('abc')}end" for j in range(rng.randrange(40))) for _ in range(120)]
    docs = frame(spark, [*texts, " ".join(["unseen"] * 300), "unseen 7aend new1 new2 unseen"]).withColumn("train", F.col("doc_id") % 6 != 0)
    docs = docs.withColumn("train", F.col("train") & (F.col("doc_id") < 120))
    real, scores = classlm.likelihood, []
    for lookup_share in (1e-2, 1e-9):
        rounds = iter([i for r in range(4) for i in (r + 1 if r < better else -1, r)])  # a round's, that of the best so far
        monkeypatch.setattr(classlm, "likelihood", lambda matrix, rounds=rounds: real(matrix) * 0 + next(rounds))
        rows = classlm.with_scores(docs, "train", unit_share=2e-2, lookup_share=lookup_share, n_classes=4, rounds=3).collect()
        scores.append({r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows})
    assert len(scores[0]) == 122 and scores[0].keys() == scores[1].keys()
    for i, row in scores[0].items():
        assert row == pytest.approx(scores[1][i])


def test_class_model_leaves_no_shuffle_files(spark):
    """What its jobs shuffle is gone when the model is there, however little memory is collected."""
    rng = random.Random(14)
    docs = frame(spark, [" ".join(f"w{int(rng.paretovariate(0.6)) % 5000}" for _ in range(60)) for _ in range(300)]).withColumn("train", F.col("doc_id") % 5 != 0)
    folders = os.environ.get("SPARK_LOCAL_DIRS") or spark.sparkContext.getConf().get("spark.local.dir", tempfile.gettempdir())

    def files():
        return {f for d in folders.split(",") for f in Path(d).glob("**/blockmgr-*/*/shuffle_*.data")}

    before = files()
    out = classlm.with_scores(docs, "train", unit_share=1e-2, lookup_share=1e-3, n_classes=4)
    for _ in range(100):  # they are removed in the background
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert out.count() == 300


def test_totals_of_many_parts(monkeypatch):
    monkeypatch.setattr(classlm, "HELD", 50)
    rng = np.random.default_rng(15)
    parts = [rng.integers(0, 2**40 if i % 3 else 90, rng.integers(0, 40)) for i in range(30)]
    totals, got = classlm.Totals(), collections.Counter()
    for part in parts:
        totals.add(part)
        if totals.full:
            got.update(dict(zip(*(x.ravel().tolist() for x in totals.take()), strict=True)))
    keys, sums = totals.take()
    got.update(dict(zip(keys.tolist(), sums[0].tolist(), strict=True)))
    assert got == collections.Counter(np.concatenate(parts).tolist())
    keys = np.unique(rng.integers(0, 8192, 500))
    n = rng.integers(1, 2**40, len(keys))
    again = classlm.unpacked(len(keys), classlm.packed(keys, n))
    assert np.array_equal(again[0], keys) and np.array_equal(again[1], n)


def test_held_out_texts_teach_nothing(spark):
    rng = random.Random(10)
    texts = [" ".join(f"w{int(rng.paretovariate(0.8)) % 300}" for _ in range(20)) for _ in range(200)]
    scores = []
    for more in ("", " w7 w8 w9 strange" * 50):
        docs = frame(spark, [t + more * (i % 4 == 0) for i, t in enumerate(texts)]).withColumn("train", F.col("doc_id") % 4 != 0)
        rows = classlm.with_scores(docs, "train", unit_share=1e-2, lookup_share=1e-3, n_classes=4).where("doc_id % 4 != 0").collect()
        scores.append({r.doc_id: r.score for r in rows})
    assert scores[0].keys() == scores[1].keys() and all(scores[0][i] == pytest.approx(scores[1][i]) for i in scores[0])


def test_exchange_gains_what_it_says():
    rng = np.random.default_rng(8)
    units, classes = 30, 4
    pairs = np.unique(rng.integers(0, units, (200, 2)), axis=0)
    n = rng.integers(1, 50, len(pairs))

    def likelihood(m):
        return classlm.xlogx(m).sum() - classlm.xlogx(m.sum(0)).sum() - classlm.xlogx(m.sum(1)).sum()

    own = rng.integers(0, classes, units)
    m = np.bincount(own[pairs[:, 0]] * classes + own[pairs[:, 1]], n, classes**2).reshape(classes, classes)
    for u in range(units):
        right = np.bincount(own[pairs[pairs[:, 0] == u, 1]], n[pairs[:, 0] == u], classes)
        left = np.bincount(own[pairs[pairs[:, 1] == u, 0]], n[pairs[:, 1] == u], classes)
        same = n[(pairs[:, 0] == u) & (pairs[:, 1] == u)].sum()
        to, gain = classlm.best_class(m, own[u], left, right, same)
        best = []
        for c in range(classes):
            other = own.copy()
            other[u] = c
            best.append(likelihood(np.bincount(other[pairs[:, 0]] * classes + other[pairs[:, 1]], n, classes**2).reshape(classes, classes)))
        assert gain == pytest.approx(max(best) - best[own[u]], abs=1e-6) and best[to] == pytest.approx(max(best))
    a, b = classlm.exchange(pairs[:, 0], pairs[:, 1], n, units, classes, 10)
    assert np.allclose(b, np.bincount(a[pairs[:, 0]] * classes + a[pairs[:, 1]], n, classes**2).reshape(classes, classes))


# Tokenizers

ODD = "a 's 're ' 've '' \n \r\n \t é ☃ x1 ² Ⅷ ١ 　 \x85 \x1c ﬁ <|endoftext|> <s> </s> \xa0 Ünï \x00 人 abababab . ... 'll 'D ▁ \U0001f600".split(" ")


def odd_texts(seed, n=400):
    rng = random.Random(seed)
    pool = [*ODD, " ", "  ", "the", "ing", "ab" * 30]
    return ["".join(rng.choice(pool) for _ in range(rng.randrange(25))) for _ in range(n)]


def test_pieces_as_the_library_has_them():
    model = pieces.Vocabulary(pieces.default_model())
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefghij") for _ in range(5000))
    for text in [*odd_texts(1), long]:
        ids = np.frombuffer(model.encode(text), "<i4").tolist()
        assert ids == model.library.encode(text)
        assert model.decode(ids).decode() == text.replace("▁", " ")


def test_whole_texts_are_committed_piece_by_piece(monkeypatch):
    model = pieces.Vocabulary(pieces.default_model())
    model.cuts = False
    meeting, held = pieces.Vocabulary._meeting, []

    def seen(last, back, longest):
        held.append(len(last))
        return meeting(last, back, longest)

    monkeypatch.setattr(pieces.Vocabulary, "_meeting", staticmethod(seen))
    rng = random.Random(8)
    for text in ["".join(rng.choice("abcdefghij é.☃") for _ in range(20_000)), "ab" * 5000, " ".join(odd_texts(9))]:
        held.clear()
        assert np.frombuffer(model.encode(text), "<i4").tolist() == model.library.encode(text)
        assert len(held) > 50 and max(held) <= 6 * model.longest


def test_a_small_memory_changes_nothing(monkeypatch):
    text = " ".join(odd_texts(10, 100))
    want = pieces.Vocabulary(pieces.default_model()).encode(text)
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    assert pieces.Vocabulary(pieces.default_model()).encode(text) == want


def test_search_by_scores_is_best():
    model = pieces.Vocabulary(pieces.default_model(), "unigram")
    rng = random.Random(2)
    found = {p: i for p, i in model.ids.items() if set(p) <= set("abc")}
    for _ in range(60):
        text = "".join(rng.choice("abc") for _ in range(9))
        codes = model.search(text)
        assert "".join(map(model.piece, codes)) == text
        best = {0: 0.0}
        for end in range(1, len(text) + 1):
            best[end] = max(best[s] + model.scores[found[text[s:end]]] for s in range(end) if text[s:end] in found)
        assert sum(model.scores[c] for c in codes) == pytest.approx(best[len(text)])


def test_counts_as_the_library_has_them():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokencount.default_tokenizer())
    own = tokencount.Counter(tokencount.default_tokenizer(), most_states=2000, most_words=50)
    texts = [*odd_texts(2), "", "abcdefgh" * 500]
    assert own.counts(texts).tolist() == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_chunks_compose():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, tokencount.CLASSES, 5000).astype(np.uint8)
    one = tokencount.boundaries(symbols, width=5000)
    for width in (1, 7, 64):
        assert (tokencount.boundaries(symbols, width) == one).all()


# Fingerprints


def test_fingerprints(spark):
    rng = random.Random(11)
    texts = [" ".join(sentence(rng, rng.choice([3, 20, 80, 400]), 3000)) for _ in range(60)]
    texts += [" ".join(t.split()[:-3] + ["new"]) for t in texts[:30]] + texts[:5]
    rng.shuffle(texts)
    docs = spark.createDataFrame([(7 * i + 1000 * (i > 50), t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    out = fingerprint.digest(docs)
    assert "Python" not in plan_of(out) and "Arrow" not in plan_of(out) and "Pandas" not in plan_of(out)
    rows = sorted(out.collect(), key=lambda r: r.doc_id)
    miss = []
    jaccard = lambda a, b: len(a & b) / len(a | b)
    for i, r in enumerate(rows):
        after, half = texts[(i + 1) % len(texts)], len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + after[:half]
        assert (r.n_chars, r.edited_sha256) == (len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
        for near, other in ((r.near_edited, edited), (r.near_next, after)):
            a, b = shingles(texts[i], 5), shingles(other, 5)
            if len(a | b) > 60:  # a few shingles are a small sample
                miss.append(near - jaccard(a, b))
    assert np.sqrt(np.mean(np.square(miss))) < 0.05
    seen = {}
    assert all(seen.setdefault(t, r.fingerprint) == r.fingerprint for t, r in zip(texts, rows, strict=True))
    short = {t: f for t, f in seen.items() if len(t.split()) < 10}
    assert len(set(short.values())) == len(short)


# Toxicity


def test_held_out_toxicity(spark):
    rng = random.Random(12)
    bad = ["zorblat", "quixnard", "fumblewort"]
    rows, labels = [], []
    for i in range(900):
        w = sentence(rng, rng.randrange(5, 80), 800)
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randrange(2, 5)):
                w.insert(rng.randrange(len(w)), rng.choice(bad).title())
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic or rng.random() < 0.03), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    told = spark.createDataFrame([r[:2] for r in labels], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.digest(docs, told).collect()}
    held = [(got[i].predicted, truth) for i, _, truth in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got)
    assert sum(p == t for p, t in held) / len(held) > 0.97 and not any(p and not t for p, t in held)


def test_grams_stay_inside_texts():
    one = [toxicity.distinct(*toxicity.grams(binary(pa.array([t]))))[1].tolist() for t in ("", "ab", "Abc d", "é\n人x")]
    who, what = toxicity.distinct(*toxicity.grams(binary(pa.array(["", "ab", "Abc d", "é\n人x"]))))
    assert [what[who == i].tolist() for i in range(4)] == one


# Licenses


def test_licenses(spark):
    texts = [
        "Some text.\nLicensed under the Apache License, Version 2.0.\nMore text.",
        "licensed under CC BY-NC 4.0",
        "Licensed under CC BY-NC 3.0.\nReleased under the MIT license",
        "Copyright 2020 someone. All rights reserved.\n\n\n\n\nThis work is licensed under the GNU General Public License, version 3.",
        "A licence to talk about warranties, nothing more.",
        "Licensed under the Apache License, Version 1.1.",
    ]
    got = {r.doc_id: r for r in licenses.digest(frame(spark, texts)).collect()}
    assert [got[i].licenses for i in range(6)] == ["Apache-2.0", "CC-BY-NC-4.0", "MIT", "GPL-3.0,LicenseRef-proprietary", "", ""]
    assert [got[i].n_exact for i in range(6)] == [1, 1, 1, 2, 0, 0]
    f = got[0].findings[0]
    assert texts[0][f.start : f.stop] == "Licensed under the Apache License, Version 2.0"
    changed = licenses.scan(licenses.WORDINGS[1][1].replace("in compliance with", "in accordance with"))
    assert changed[0].license == "Apache-2.0" and set(changed[0].differences) == {"-compliance", "+accordance"}


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
@pytest.mark.parametrize("width", [30, 72, 80])
def test_licenses_over_broken_lines(mark, width):
    for name, wording in licenses.WORDINGS:
        lines = textwrap.wrap(wording, width, break_on_hyphens=False, break_long_words=False)
        text = "Some words before.\n" + "".join(f"{mark}{x}\n" for x in lines) + "And words that follow it.\n"
        found = licenses.scan(text)
        assert [(f.license, f.differences) for f in found] == [(name, ())], text


def test_licenses_of_other_spellings_and_versions():
    told = {
        "// SPDX-License-Identifier: MIT": "MIT",
        "/* SPDX-License-Identifier: GPL-2.0-or-later */": "GPL-2.0-or-later",
        "It comes under the terms of the MIT license.": "MIT",
        "Licensed under GPL v3.0": "GPL-3.0",
        "License: Apache License 2.0": "Apache-2.0",
        "Licensed under CC BY-SA 3.0": "CC-BY-SA-3.0",
        "Distributed under the Boost Software License, Version 1.0. (See the file.)": "BSL-1.0",
        "This work is licensed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
        "Licensed under the Boost Software License, Version 2.0.": None,
        "SPDX-License-Identifier: Strange-1.0": None,
    }
    for text, name in told.items():
        assert [f.license for f in licenses.scan(text)] == [name] * (name is not None), text


def test_licenses_are_ranked_by_what_they_explain():
    """Fewer words differ from the shorter wording, but the longer one saves more bytes."""
    said = [f"permission{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(42)]
    short, long = ["license", *said[:30]], ["license", *said]
    text = " ".join([*long[:-10], *(w + "x" if i in (2, 5) else w for i, w in enumerate(long[-10:]))])
    for order in (1, -1):
        found = licenses.scan(text, tuple([("short", " ".join(short)), ("long", " ".join(long))][::order]))
        assert [f.license for f in found] == ["long"] and len(found[0].differences) == 4
    assert [f.license for f in licenses.scan(" ".join(short), (("short", " ".join(short)), ("long", " ".join(long))))] == ["short"]


def test_licenses_in_any_case():
    for name, wording in licenses.WORDINGS:
        for text in (wording.upper(), wording.replace(" ", " \t ").title(), f"{wording.upper()} {'other words ' * 60}"):
            assert [(f.license, f.differences) for f in licenses.scan(text)] == [(name, ())], text
    beside = "\n".join(w for _, w in licenses.WORDINGS)  # all of them in one block
    assert [f.license for f in licenses.scan(beside)] == [n for n, _ in licenses.WORDINGS]


def test_held_out_words_change_no_training_score(spark):
    rng = random.Random(12)
    rows = [(i, " ".join(sentence(rng, 30, 60)), i % 5 != 0) for i in range(200)]
    turned = [(i, text if train else f"{text} {' '.join(['held out words'] * 9)} w1 w2 w3", train) for i, text, train in rows]
    told = []
    for some in (rows, turned):
        df = spark.createDataFrame(some, "doc_id long, text string, train boolean").repartition(2)
        told.append({r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in classlm.with_scores(df, "train", keep=("doc_id",)).collect()})
    for i, _, train in rows:
        if train:
            assert told[0][i] == pytest.approx(told[1][i])


def test_kinds_of_all_code_points():
    """As the library's pre-tokenizer sees them; a sample of what Python's tables know, and
    all that they hold to be unassigned in blocks that have letters today."""
    from tokenizers import pre_tokenizers

    library = pre_tokenizers.ByteLevel(add_prefix_space=False)
    kinds = tokencount.kinds()
    some = [*range(0, 0x3000, 7), *range(0x1C80, 0x1C90), *range(0xA7C0, 0xA7E0), *range(0x105C0, 0x105F4), *range(0x10D40, 0x10D90), *range(0x1CC00, 0x1CD00)]
    for point in some:
        if point in tokencount.WHITE:
            continue
        letter, number = (len(library.pre_tokenize_str(c + chr(point))) == 1 for c in "a1")
        assert kinds[point] == (tokencount.LETTER if letter else tokencount.NUMBER if number else tokencount.OTHER), hex(point)
