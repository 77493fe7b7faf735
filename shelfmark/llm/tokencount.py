"""Token counts by finite-state transducers compiled from a byte-level BPE tokenizer.

Two deterministic transducers stand in for the tokenizer. The first reads characters
and says where a pre-token begins. It runs on all chunks of a batch at once: each chunk
is first read from every state, which gives a map from states to states; the maps are
composed by a parallel prefix scan; then every chunk is read again from the state that
it is really entered in. The second reads the bytes of a pre-token. Its states hold the
tokens that may still be going on, and each transition is annotated with the number of
tokens that the byte adds to (or, where tokens merge, takes from) the count. States are
compiled when they are first entered and kept by the worker.

Texts are counted where they lie; there is no shuffle.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from shelfmark.llm.common import map_texts
from shelfmark.operators.once import once_per_worker

#: Unicode's white space.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Classes of characters, told apart with a look at what follows: the end of a text, letters,
# numbers, others; white space inside or at the end of a text's run, a blank or other white
# space right before something else; an apostrophe that begins 's 't 'm 'd or 're 've 'll.
END, LETTER, NUMBER, OTHER, RUN, BLANK, BREAK, SHORT, LONG = range(9)
# States: nothing open; inside a run of a kind; after a blank that belongs to what
# follows; two or one more letters of a contraction to come.
OPEN, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_WHITE, AFTER_BLANK, TWO_MORE, ONE_MORE = range(8)
STATES, CLASSES = 8, 9


def _boundary_table() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a pre-token begins, by state * CLASSES + class."""
    fresh = {
        END: OPEN, LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, RUN: IN_WHITE,
        BLANK: AFTER_BLANK, BREAK: OPEN, SHORT: ONE_MORE, LONG: TWO_MORE,
    }
    goes_on = {
        OPEN: {}, IN_LETTERS: {LETTER: IN_LETTERS}, IN_NUMBERS: {NUMBER: IN_NUMBERS},
        IN_OTHERS: dict.fromkeys((OTHER, SHORT, LONG), IN_OTHERS), IN_WHITE: {RUN: IN_WHITE},
        AFTER_BLANK: {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, **dict.fromkeys((OTHER, SHORT, LONG), IN_OTHERS)},
        TWO_MORE: {LETTER: ONE_MORE}, ONE_MORE: {LETTER: OPEN},
    }
    state = np.zeros(STATES * CLASSES, np.uint8)
    begins = np.zeros(STATES * CLASSES, bool)
    for s in range(STATES):
        for c in range(CLASSES):
            state[s * CLASSES + c] = goes_on[s].get(c, fresh[c])
            begins[s * CLASSES + c] = c not in goes_on[s] and c != END
    return state, begins


NEXT, BEGINS = _boundary_table()


def kinds() -> np.ndarray:
    """LETTER, NUMBER, OTHER or RUN (for any white space) of each code point.

    Python's tables may be older than the library's, so the library is asked about what
    they hold to be unassigned: a run of such points between a letter and a sign is one
    pre-token with the sign unless one of them is a letter or a number.
    """
    names = [unicodedata.category(chr(i)) for i in range(0x110000)]
    first = np.array([ord(name[0]) for name in names], np.uint8)
    out = np.full(0x110000, OTHER, np.uint8)
    out[first == ord("L")] = LETTER
    out[first == ord("N")] = NUMBER
    library = pre_tokenizers.ByteLevel(add_prefix_space=False)

    def joined(text: str) -> bool:
        return len(library.pre_tokenize_str(text)) == 1

    unassigned = [i for i, name in enumerate(names) if name == "Cn"]
    for start in range(0, len(unassigned), 256):
        run = unassigned[start : start + 256]
        parts = library.pre_tokenize_str("a" + "".join(map(chr, run)) + "!")
        if [span for _, span in parts] != [(0, 1), (1, len(run) + 2)]:
            for point in run:
                out[point] = LETTER if joined("a" + chr(point)) else NUMBER if joined("1" + chr(point)) else OTHER
    out[WHITE] = RUN
    return out


def classes(code: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Classes of code points; ``ends`` are the places of the marks between texts."""
    out = once_per_worker("kinds", "", kinds)[code]
    out[ends] = END
    after = np.append(out[1:], END)
    white = out == RUN
    before_other = white & (after != RUN) & (after != END)
    out[before_other] = np.where(code[before_other] == 32, BLANK, BREAK)
    at = np.flatnonzero(code == 39)
    at = at[out[at] == OTHER]
    if len(at):
        padded = np.concatenate([code, [0, 0]])
        one, two = padded[at + 1], padded[at + 2]
        is_end = np.zeros(len(padded), bool)
        is_end[ends] = is_end[len(code) :] = True
        single = np.isin(one, [ord(c) for c in "stmd"]) & ~is_end[at + 1]
        pair = np.isin(one * 0x110000 + two, [ord(a) * 0x110000 + ord(b) for a, b in ("re", "ve", "ll")])
        pair &= ~is_end[at + 1] & ~is_end[at + 2]
        out[at[single]] = SHORT
        out[at[pair]] = LONG
    return out


def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All maps of states to states that some string of classes gives.

    Returns the maps, the map after one more class by map * CLASSES + class, the
    composition by first * maps + second, and the map that changes nothing.
    """
    letters = [tuple(NEXT[np.arange(STATES) * CLASSES + c].tolist()) for c in range(CLASSES)]
    found = {tuple(range(STATES)): 0}
    queue = list(found)
    for m in queue:
        for after in letters:
            new = tuple(after[s] for s in m)
            if new not in found:
                found[new] = len(found)
                queue.append(new)
    maps = np.array(list(found), np.uint8)
    grown = np.array([found[tuple(after[s] for s in m)] for m in found for after in letters], np.uint16)
    composed = np.array([found[tuple(b[s] for s in a)] for a in found for b in found], np.uint16)
    return maps, grown, composed, np.zeros(1, np.uint16)


def boundaries(symbols: np.ndarray, width: int = 256) -> np.ndarray:
    """Where pre-tokens begin, by composing the state maps of chunks."""
    maps, grown, composed, same = once_per_worker("monoid", "", monoid)
    n = len(symbols)
    chunks = max(1, -(-n // width))
    grid = np.full(chunks * width, END, np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(chunks, width).T)
    # What a chunk makes of each state, as the number of its map.
    chunk = np.repeat(same.astype(np.intp), chunks)
    for row in grid:
        chunk *= CLASSES
        chunk += row
        chunk = grown[chunk].astype(np.intp)
    # Prefix scan: after the step of length d, a map covers the 2d chunks up to its own.
    step = 1
    while step < chunks:
        later = composed[chunk[:-step] * len(maps) + chunk[step:]]
        chunk = np.concatenate([chunk[:step], later])
        step *= 2
    state = np.concatenate([[OPEN], maps[chunk[:-1], OPEN]]).astype(np.intp)
    out = np.empty((width, chunks), bool)
    for i, row in enumerate(grid):
        state *= CLASSES
        state += row
        out[i] = BEGINS[state]
        state = NEXT[state].astype(np.intp)
    return out.T.reshape(-1)[:n]


def letter_bytes() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes with: printable ones as
    themselves, the others in order from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter:
    """Counts the tokens of pre-tokens by a transducer that grows where it is walked."""

    def __init__(self, path: str, most_states: int = 200_000, most_words: int = 300_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        plain = before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        if model["type"] != "BPE" or not plain or spec["normalizer"] or model["dropout"] or model.get("ignore_merges"):
            raise ValueError(f"{path} is no plain byte-level BPE tokenizer")
        byte = letter_bytes()
        raw = lambda token: bytes(byte[c] for c in token)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.rank: dict[tuple[bytes, bytes], int] = {}
        for i, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[raw(a), raw(b)] = i
        self.trie: list[dict[int, int]] = [{}]
        self.token: list[bytes | None] = [None]
        for text in {bytes([b]) for b in range(256)} | {a + b for a, b in self.rank}:
            node = 0
            for b in text:
                if b not in self.trie[node]:
                    self.trie[node][b] = len(self.trie)
                    self.trie.append({})
                    self.token.append(None)
                node = self.trie[node][b]
            self.token[node] = text
        self.beside: dict[tuple[bytes, bytes], bool] = {}
        self.most_states, self.most_words = most_states, most_words
        self.words: dict[bytes, int] = {}
        self._clear()

    def _clear(self) -> None:
        # A state: for each place that a token may go on from, how far it has come in the
        # trie, the token before that place, and the count there less the count here.
        first = ((0, b"", 0),)
        self.number = {first: 0}
        self.states = [first]
        self.moves: list[dict[int, tuple[int, int]]] = [{}]

    def merged(self, text: bytes) -> list[bytes]:
        """What the merges make of a short text, the lowest rank first."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            ranks = [self.rank.get(p, 1 << 30) for p in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == 1 << 30:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def together(self, a: bytes, b: bytes) -> bool:
        """Two tokens side by side are what the merges make of their bytes. A text's
        tokens are the one sequence in which this holds for all neighbours."""
        out = self.beside.get((a, b))
        if out is None:
            if len(self.beside) >= self.most_words:
                self.beside.clear()
            out = self.beside[a, b] = self.merged(a + b) == ([a, b] if a else [b])
        return out

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        alive, token, adds = [], None, 0
        for node, before, back in self.states[state]:
            node = self.trie[node].get(byte)
            if node is None:
                continue
            alive.append((node, before, back))
            if token is None and self.token[node] is not None and self.together(before, self.token[node]):
                token, adds = self.token[node], back + 1
        entry = tuple([(n, t, c - adds) for n, t, c in alive if self.trie[n]] + [(0, token, 0)])
        to = self.number.get(entry)
        if to is None:
            to = self.number[entry] = len(self.states)
            self.states.append(entry)
            self.moves.append({})
        self.moves[state][byte] = move = (to, adds)
        return move

    def count(self, word: bytes) -> int:
        """Tokens of a pre-token."""
        if len(self.states) >= self.most_states:
            self._clear()
        moves, state, total = self.moves, 0, 0
        for byte in word:
            move = moves[state].get(byte)
            state, adds = move if move is not None else self._compile(state, byte)
            total += adds
        return total

    def word(self, word: bytes) -> int:
        n = self.words.get(word)
        if n is None:
            n = self.count(word)
            if len(word) <= 40:
                if len(self.words) >= self.most_words:
                    self.words.clear()
                self.words[word] = n
        return n

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text. The strings of special tokens are tokens of their own."""
        pieces, owner = [], []
        extra = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            split = [text]
            for special in self.special:
                if special in text:
                    split = [p for s in split for p in s.split(special)]
            extra[i] = len(split) - 1
            pieces += split
            owner += [i] * len(split)
        line = "\0".join(pieces) + "\0"
        code = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.int64)
        ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
        begins = np.flatnonzero(boundaries(classes(code, ends)))
        # A pre-token lasts up to the next one or to the end of its text.
        of = np.searchsorted(ends, begins)
        stops = np.minimum(np.append(begins[1:], len(code)), ends[of])
        size = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        place = np.concatenate([[0], np.cumsum(size)])
        raw = line.encode()
        starts, stops = place[begins].tolist(), place[stops].tolist()
        found = list(map(self.words.get, map(raw.__getitem__, map(slice, starts, stops))))
        if None in found:
            for k, n in enumerate(found):
                if n is None:
                    found[k] = self.word(raw[starts[k] : stops[k]])
        return extra + np.bincount(np.asarray(owner)[of], np.array(found, np.int64), len(texts)).astype(np.int64)


def counter(path: str) -> Counter:
    """One per Python worker, which Spark uses for many tasks."""
    return once_per_worker("counter", path, lambda: Counter(path))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def with_token_counts(
    docs: DataFrame, tokenizer: str | None = None, text: str = "text", out: str = "n_tokens", keep: list[str] | None = None
) -> DataFrame:
    """Add the number of tokens of a text; 0 for a null or an empty one.

    ``tokenizer`` is the path of a byte-level BPE tokenizer file that every executor has.
    Nothing is added before or after a text. Repeated texts are counted each. An input
    column named like the output is replaced.
    """
    path = tokenizer or default_tokenizer()

    def start():
        machine = counter(path)
        return lambda texts: [machine.counts([t.as_py().decode("utf-8", "replace") for t in texts])]

    return map_texts(docs, start, [(out, "bigint", pa.int64())], text, keep)


def digest(docs: DataFrame, limit: int = 1024) -> DataFrame:
    sized = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    found = with_token_counts(sized, keep=["doc_id", "n_bytes"])
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
