"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search walks over a normalised text and keeps, for each of the last places, the
best piece that ends there and where it begins. No piece is longer than the longest of
the model, so only that many places can still be gone on from. As soon as the paths
back from all of them meet in one boundary, the ids up to it are committed and the
places before it forgotten: what the search holds does not grow with the text. The text
itself and its ids are held whole. Where no piece spans a blank in its middle, a text is
cut before blanks; the stretches are searched on their own, and those that a worker
remembers not again.

Two kinds of model are searched alike. With a unigram model a step costs the piece's
score and the best sum wins. With a BPE model a step is allowed only where merging
would leave the two pieces side by side, which leaves one path to each place: the
sequence of pieces whose neighbours all get along is the one that merging ends with.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import map_texts
from shelfmark.operators.once import once_per_worker

SPACE = "▁"
#: What no piece ends with.
NOTHING: tuple[dict, None, dict] = ({}, None, {})
#: Codes before the first piece, and of a place that no path leads to.
START, NEVER = 1 << 30, (1 << 30) + 1
#: Stretches in a generation of those that a worker remembers, and the longest that it does.
REMEMBERED, SHORT = 250_000, 32
#: Pairs of pieces that a worker remembers.
PAIRS = 400_000


class Known(dict):
    """What was made of the last stretches; others are made when asked for. When
    ``REMEMBERED`` are held they become the older generation, and the one before goes."""

    def __init__(self, make):
        self.make = make
        self.older: dict = {}

    def __missing__(self, stretch: str) -> bytes:
        ids = self.older.get(stretch)
        if ids is None:
            ids = self.make(stretch)
        if len(stretch) <= SHORT:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[stretch] = ids
        return ids


class Vocabulary:
    """The pieces of a model file. ``kind`` is "bpe" or "unigram"."""

    def __init__(self, path: str, kind: str = "bpe"):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        self.kind = kind
        special = (self.library.is_control, self.library.is_unknown, self.library.is_unused, self.library.is_byte)
        self.ids: dict[str, int] = {}
        self.names = [self.library.id_to_piece(i) for i in range(size)]
        self.raw: list[bytes] = []
        self.byte = [-1] * 256
        for i in range(size):
            piece = self.names[i]
            if self.library.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif any(f(i) for f in special):
                self.raw.append(b"")
            else:
                self.ids[piece] = i
                self.raw.append(piece.replace(SPACE, " ").encode())
        self.unknown = self.library.unk_id()
        if self.unknown >= 0:
            self.raw[self.unknown] = " ⁇ ".encode()
        self.fallback = min(self.byte) >= 0
        self.scores = [self.library.get_score(i) for i in range(size)]
        self.score = {p: self.scores[i] for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        #: Texts can be cut before a run of blanks if no piece spans such a place.
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.worst = min(self.score.values(), default=0.0) - 10.0
        #: Pieces from their last letter backwards: for each letter those that may stand
        #: before it, the piece that begins here, and which pieces may stand before that.
        self.trie: dict = {}
        self.pairs: dict[int, dict[int, bool]] = {}
        self.n_pairs = 0
        for piece, i in self.ids.items():
            kids = self.trie
            for letter in piece[:0:-1]:
                kids = kids.setdefault(letter, ({}, None, {}))[0]
            kids[piece[0]] = (kids[piece[0]][0] if piece[0] in kids else {}, i, self.pairs.setdefault(i, {}))
        self.edges: tuple[dict, dict] = ({}, {})
        self.words = Known(lambda word: self._encode(SPACE + word))
        self.known = Known(self._encode)

    def normalise(self, text: str) -> str:
        return self.library.normalize(text)

    def merged(self, text: str, down_to: int = 1) -> list[str]:
        """What merging ends with: always the best pair, leftmost first."""
        parts, score = list(text), self.score
        while len(parts) > down_to:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edge(self, piece: str, right: bool) -> list[tuple[str, float]] | None:
        """Symbols that stand at an edge while a piece is merged, and the score of the
        merge that ends each, from the piece itself to a character. None if scores do
        not fall from merge to merge, or if merging does not lead to the piece."""
        out = self.edges[right].get(piece)
        if out is None and piece not in self.edges[right]:
            out, end, symbol = [], float("-inf"), piece
            while out is not None:
                out.append((symbol, end))
                if len(symbol) == 1:
                    break
                halves = self.merged(symbol, 2)
                if len(halves) != 2 or any(self.score.get(h, 1.0) <= self.score[symbol] for h in halves if len(h) > 1):
                    out = None
                    break
                end, symbol = self.score[symbol], halves[right]
            self.edges[right][piece] = out
        return out

    def piece(self, code: int) -> str:
        """A piece by its id; characters outside the vocabulary have negative codes."""
        return self.names[code] if code >= 0 else chr(-1 - code)

    def together(self, a: int, b: int) -> bool:
        """Merging leaves the two pieces side by side: no merge across their border
        comes before those that take its symbols further into either piece."""
        if a in (START, NEVER):
            return a == START
        left, right = self.piece(a), self.piece(b)
        ends, starts = self.edge(left, True), self.edge(right, False)
        if ends is None or starts is None:
            return self.merged(left + right) == [left, right]
        return self._kept_apart(ends, starts)

    def _learn(self, a: int, b: int) -> bool:
        if self.n_pairs >= PAIRS:
            for held in self.pairs.values():
                held.clear()
            self.n_pairs = 0
        self.n_pairs += 1
        out = self.pairs[b][a] = self.together(a, b)
        return out

    def _kept_apart(self, ends, starts) -> bool:
        score = self.score
        for x, x_end in ends:
            x_start = score.get(x, 1.0) if len(x) > 1 else 1.0
            for y, y_end in starts:
                y_start = score.get(y, 1.0) if len(y) > 1 else 1.0
                # Both stand at the border at some time, as scores fall with time.
                if min(x_start, y_start) > max(x_end, y_end):
                    s = score.get(x + y)
                    # Of equal merges the left one comes first: x's own, then this, then y's.
                    if s is not None and s > x_end and s >= y_end:
                        return False
        return True

    def emit(self, code: int) -> list[int]:
        if code >= 0:
            return [code]
        if self.fallback:
            return [self.byte[b] for b in chr(-1 - code).encode("utf-8", "replace")]
        return [self.unknown]

    def search(self, text: str) -> list[int]:
        """Codes of the pieces of a normalised text, committed as early as they are certain."""
        trie, bpe, scores, longest = self.trie, self.kind == "bpe", self.scores, self.longest
        done, due = 0, 4 * longest
        out: list[int] = []
        # Of the places from ``done`` on: the piece that ends there on the best path and
        # where it begins, and the best sum.
        last, back, total = [START], [0], [0.0]
        for here, letter in enumerate(text):
            place = here - done
            kids, code, pairs = trie.get(letter, NOTHING)
            if code is None:
                code = -1 - ord(letter)  # outside the vocabulary
                pairs = self.pairs.setdefault(code, {})
            piece, at, best = NEVER, place, None
            while True:
                if bpe:
                    fits = pairs.get(last[place])
                    if fits or (fits is None and self._learn(last[place], code)):
                        piece, at = code, place
                        break
                else:
                    score = total[place] + (scores[code] if code >= 0 else self.worst)
                    if best is None or score >= best:
                        piece, at, best = code, place, score
                # The next longer piece that ends here.
                code = None
                while code is None and place and kids:
                    place -= 1
                    kids, code, pairs = kids.get(text[place + done], NOTHING)
                if code is None:
                    break
            last.append(piece)
            back.append(at)
            if not bpe:
                total.append(best)
            if len(last) > due:
                meet = self._meeting(last, back, longest)
                out += self._path(last, back, meet)
                done += meet
                last, total = last[meet:], total[meet:]
                back = [b - meet for b in back[meet:]]
                due = max(4 * longest, len(last) + 2 * longest)
        return out + self._path(last, back, len(last) - 1)

    @staticmethod
    def _meeting(last: list, back: list[int], longest: int) -> int:
        """The nearest boundary on the paths back from all places that a later piece can
        begin at."""
        live = {place for place in range(max(len(last) - longest, 0), len(last)) if last[place] != NEVER}
        while len(live) > 1:
            place = max(live)
            live.discard(place)
            live.add(back[place])
        return live.pop()

    @staticmethod
    def _path(last: list, back: list[int], end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(last[end])
            end = back[end]
        return out[::-1]

    def _encode(self, text: str) -> bytes:
        codes = self.search(text)
        if min(codes, default=0) < 0:
            codes = [i for code in codes for i in self.emit(code)]
        return array("i", codes).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text, as packed 32-bit numbers."""
        return self.encode_normalised(self.normalise(text))

    def encode_normalised(self, text: str) -> bytes:
        if not self.cuts:
            return self._encode(text)
        if text[:1] == SPACE and text[-1] != SPACE and SPACE * 2 not in text:
            return b"".join(map(self.words.__getitem__, text[1:].split(SPACE)))
        return b"".join(map(self.known.__getitem__, STRETCH.findall(text)))

    def decode(self, ids) -> bytes:
        """UTF-8 of a sequence of ids, without the blank that encoding puts first."""
        out = b"".join(map(self.raw.__getitem__, ids))
        return out[1:] if out[:1] == b" " else out


STRETCH = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+", re.S)


def vocabulary(path: str, kind: str) -> Vocabulary:
    """One per Python worker, which Spark uses for many tasks."""
    return once_per_worker("pieces", (path, kind), lambda: Vocabulary(path, kind))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def with_ids(
    docs: DataFrame,
    model: str | None = None,
    kind: str = "bpe",
    text: str = "text",
    out: str = "ids",
    keep: list[str] | None = None,
    check: bool = False,
) -> DataFrame:
    """Add the ids of a text, and with ``check`` what decoding them gives.

    ``model`` is a path that every executor has. A null or empty text has no ids.
    Characters outside the vocabulary become byte pieces, or the unknown id where the
    model has none. With ``check`` there are two more columns: ``decoded_sha256``, of the
    decoded bytes, and ``round_trip``, whether they are the model's normalised text.
    An input column named like an output is replaced.
    """
    model = model or default_model()
    fields = [(out, "array<int>", pa.list_(pa.int32()))]
    if check:
        fields += [("decoded_sha256", "string", pa.string()), ("round_trip", "boolean", pa.bool_())]

    def start():
        words = vocabulary(model, kind)

        def step(texts):
            plain = [words.normalise(t.as_py().decode("utf-8", "replace")) for t in texts]
            packed = [words.encode_normalised(p) for p in plain]
            cut = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
            flat = np.frombuffer(b"".join(packed), "<i4")
            columns = [pa.ListArray.from_arrays(pa.array(cut), pa.array(flat))]
            if check:
                back = [words.decode(np.frombuffer(p, "<i4").tolist()) for p in packed]
                want = [p.replace(SPACE, " ").encode("utf-8", "replace") for p in plain]
                columns.append([hashlib.sha256(b).hexdigest() for b in back])
                columns.append([b == (w[1:] if w[:1] == b" " else w) for b, w in zip(back, want, strict=True)])
            return columns

        return step

    return map_texts(docs, start, fields, text, keep)


def with_text(
    rows: DataFrame, model: str | None = None, kind: str = "bpe", ids: str = "ids", out: str = "decoded", keep: list[str] | None = None
) -> DataFrame:
    """Add the text that ids stand for; null or no ids give the empty text.

    Bytes that are no UTF-8 are replaced.
    """
    model = model or default_model()
    keep = [c for c in (rows.columns if keep is None else keep) if c.lower() != out.lower()]

    def run(batches):
        words = vocabulary(model, kind)
        for batch in batches:
            texts = [words.decode(i or []).decode("utf-8", "replace") for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(texts, pa.string())], names=[*keep, out]
            )

    schema = ", ".join([f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep] + [f"`{out}` string"])
    return rows.select(*dict.fromkeys([*keep, ids])).mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    found = with_ids(docs, keep=["doc_id"], check=True)
    return found.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids", "decoded_sha256", "round_trip")
