"""Exact byte-pair encoding of words by dynamic programming over their prefixes, and decoding.

The vocabulary gives each merge a rank: the order of its result among all tokens. In the encoding of a word
the last token of every prefix is unique: it is the only token that ends there and is compatible with the
last token of the prefix before it. Two tokens are compatible when no merge would have joined the pieces on
both sides of their border while these existed. An automaton over all tokens names those that end at each
position; the last tokens found are the back pointers from which the word's ids are read.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsight.llm.text import prepare, whole_text

#: The word pattern of the vocabulary file; white space is dropped. Fixed value.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Separators to str.split() that are no white space to the pattern.
_NOT_SPACE = regex.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"\s+")
_NEVER = 1 << 60
#: Entries that a worker keeps for sure, of about 250 bytes; it never has more than twice as many.
CACHED = 330_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in vocabulary files of this kind."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and added tokens of a vocabulary file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.names = {i: s for s, i in self.ids.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: s for s, i in self.added.items()}
        self.added_pattern = regex.compile("|".join(regex.escape(s) for s in sorted(self.added, key=len, reverse=True)))
        symbols = byte_symbols()
        self.inner = [self.ids[s] for s in symbols]
        self.final = [self.ids[s + suffix] for s in symbols]
        self.parts: dict[int, tuple[int, int]] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        self.rank: dict[int, int] = dict.fromkeys([*self.inner, *self.final], -1)
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair, joined = (self.ids[left], self.ids[right]), self.ids[left + right]
            self.pairs[pair] = rank
            if joined not in self.parts and joined not in self.rank:
                self.parts[joined], self.rank[joined] = pair, rank
        self._compatible: dict[int, bool] = {}
        self._build([*self.inner, *self.final])

    def _build(self, symbols: list[int]) -> None:
        """The automaton over all tokens that encode to themselves: steps, and the tokens that end in a state."""
        spelt = {i: (i,) for i in symbols}
        self.step: list[dict[int, int]] = [{}]
        own: list[tuple[int, int] | None] = [None]
        for token in [*symbols, *self.parts]:
            if token in self.parts:
                left, right = self.parts[token]
                spelt[token] = spelt[left] + spelt[right]
            if token in self.parts and not self._whole(token):
                continue
            state = 0
            for symbol in spelt[token]:
                after = self.step[state].get(symbol)
                if after is None:
                    after = self.step[state][symbol] = len(self.step)
                    self.step.append({})
                    own.append(None)
                state = after
            own[state] = token, len(spelt[token])
        self.shorter = [0] * len(self.step)
        self.ending: list[tuple] = [()] * len(self.step)
        queue = [0]
        for state in queue:
            for symbol, after in self.step[state].items():
                queue.append(after)
                if state:
                    self.shorter[after] = self._next(self.shorter[state], symbol)
                longest = (own[after],) if own[after] else ()
                self.ending[after] = longest + self.ending[self.shorter[after]]
        # queue order is breadth first, so a state's shorter suffix is complete before the state

    def _next(self, state: int, symbol: int) -> int:
        while state and symbol not in self.step[state]:
            state = self.shorter[state]
        return self.step[state].get(symbol, 0)

    def _whole(self, token: int) -> bool:
        """Whether nothing joins across the border of a token's two parts before they are joined."""
        left, right = self.parts[token]
        return self._border_holds(left, right, self.rank[token])

    def compatible(self, left: int, right: int) -> bool:
        """Whether the border between two tokens outlives all merges of the pieces beside it."""
        if len(self._compatible) > 2_000_000:
            self._compatible.clear()
        fits = self._compatible[left << 20 | right] = self._border_holds(left, right)
        return fits

    def _border_holds(self, x: int, y: int, until: int = _NEVER) -> bool:
        # x is the piece left of the border until the merge of rank x_end takes it in, y the one right of it
        x_end = y_end = until
        joins = self.pairs.get((x, y)) if until == _NEVER else None
        while True:
            # of equal merges the leftmost comes first: one that takes in x is further left, one for y is not
            if joins is not None and joins < x_end and joins <= y_end:
                return False
            x_made, y_made = self.rank[x], self.rank[y]
            if x_made < 0 and y_made < 0:
                return True
            if x_made > y_made:
                x_end, x = x_made, self.parts[x][1]
            else:
                y_end, y = y_made, self.parts[y][0]
            joins = self.pairs.get((x, y))

    def word(self, word: str) -> list[int]:
        """The ids of one word, that is one match of the word pattern."""
        raw = word.encode()
        inner, step, ending, known = self.inner, self.step, self.ending, self._compatible.get
        symbols = [inner[b] for b in raw]
        symbols[-1] = self.final[raw[-1]]
        last: list[tuple[int, int]] = [(-1, 0)]
        state = at = 0
        for symbol in symbols:
            at += 1
            after = step[state].get(symbol)
            state = self._next(state, symbol) if after is None else after
            for match in ending[state]:
                token, length = match
                if length == at:
                    break
                before = last[at - length][0]
                fits = known(before << 20 | token)
                if fits or (fits is None and self.compatible(before, token)):
                    break
            last.append(match)
        out = []
        while at:
            token, length = last[at]
            out.append(token)
            at -= length
        out.reverse()
        return out


class Encoder:
    """Encodes texts; what stands between white space is encoded once and kept while there is room."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self._chunks = Kept(self._chunk, CACHED)
        self._names = Kept(self.decode, CACHED)

    def encode(self, text: str) -> list[bytes]:
        """The ids as little-endian 32-bit integers, in parts."""
        chunks = [c for c in _SPACE.split(text) if c] if _NOT_SPACE.search(text) else text.split()
        self._chunks.make_room()
        return list(map(self._chunks.__getitem__, chunks))

    def decode_parts(self, parts: list[bytes]) -> str:
        self._names.make_room()
        return " ".join(map(self._names.__getitem__, filter(None, parts)))

    def decode(self, ids: bytes) -> str:
        """The tokens of ids with a space between them, as a file without decoder asks for."""
        names = self.vocabulary.names
        return " ".join([names[i] for i in array("I", ids)])

    def _chunk(self, chunk: str) -> bytes:
        if "<" in chunk and self.vocabulary.added_pattern.search(chunk):
            out, at = [], 0
            for m in self.vocabulary.added_pattern.finditer(chunk):
                out += [self._plain(chunk[at : m.start()]), array("I", [self.vocabulary.added[m[0]]]).tobytes()]
                at = m.end()
            return b"".join([*out, self._plain(chunk[at:])])
        return self._plain(chunk)

    def _plain(self, chunk: str) -> bytes:
        if not chunk.isascii():
            # letters are lowered one by one: no final form of sigma
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        low = chunk.lower()
        if low.isalpha():
            return self._word(low, chunk)
        words = [low[:-1], low[-1]] if low[:-1].isalpha() and low[-1] in ".," else WORDS.findall(low)
        return b"".join([self._word(w, chunk) for w in words])

    def _word(self, word: str, chunk: str) -> bytes:
        """The ids of one word of a chunk; words are kept as chunks of their own, as far as they would be the same."""
        same = word.isascii() or (unicodedata.is_normalized("NFC", word) and word.lower() == word)
        if word == chunk or not same:
            return array("I", self.vocabulary.word(word)).tobytes()
        return self._chunks[word]


class Kept(dict):
    """A dictionary that computes what it lacks. When it is full, what was not used since it last was is dropped."""

    def __init__(self, make: Callable, bound: int):
        super().__init__()
        self.make, self.bound, self.older = make, bound, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def make_room(self) -> None:
        if len(self) > self.bound:
            self.older = dict(self)
            self.clear()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, made once in each worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) of every row: ids as little-endian unsigned 32-bit integers, and their decoding.

    Whole texts are encoded, without begin or end tokens; added tokens that stand in a text are recognised.
    A null text is empty: no ids, an empty decoding. Each row stands for itself, so repeated rows, null ids
    and any other columns do not matter; nothing is shuffled.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            step = 256
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                found = [e.encode(t) for t in part.column(1).to_pylist()]
                ids = pa.array([b"".join(f) for f in found], pa.binary())
                decoded = pa.array([e.decode_parts(f) for f in found], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), ids, decoded], names=["id", "ids", "decoded"])

    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema["id"].dataType),
            T.StructField("ids", T.BinaryType()),
            T.StructField("decoded", T.StringType()),
        ]
    )
    return rows.mapInArrow(run, schema)
