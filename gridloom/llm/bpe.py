"""Byte-level BPE by a finite-state transducer that is determinised as it is needed.

A sequence of tokens is the encoding of a string if and only if each two neighbours encode to
themselves; so each prefix of a string has one last token, and the encoding of a longer prefix
extends that of a shorter one by one token. A state of the transducer holds the places at which the
encoding of what follows may still be cut: for each the token that ends there and the node of
the vocabulary's trie that has been reached from it. Reading a byte moves the nodes, drops dead
places, adds the one new place, and gives the token that ends there. What comes before the
last token on which all open places agree is settled and emitted; since a place stays open for no longer than the longest token,
the lookahead is bounded. States and arcs are made when first met, and dropped all together when there are too many.

Decoding is streamed: the arcs of a UTF-8 state machine are compiled for whole tokens, so that a
character split over tokens comes out once its last byte is there; malformed bytes become
U+FFFD, as Python's ``errors="replace"`` has it.

Defined cases: a null text is encoded as an empty one: no ids, the digest of nothing; repeated rows are
encoded each on its own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import carried, kind_of, map_texts, restored, table

MAX_STATES, MAX_WORDS, LONG_WORD, FLUSH = 250_000, 200_000, 16, 1 << 12


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.step: dict[int, int] = {}  # node * 256 + byte: node
        self.token: dict[int, int] = {}  # node: token that ends there
        self.depth = [0]
        inner = set()
        for word, token in ranks.items():
            node = 0
            for byte in word:
                key = node * 256 + byte
                inner.add(node)
                if key not in self.step:
                    self.step[key] = len(self.depth)
                    self.depth.append(self.depth[node] + 1)
                node = self.step[key]
            self.token[node] = token
        self.leaves = {node for node in self.token if node not in inner}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.splits: dict[int, tuple[int, int] | None] = {}
        self.size = {i: len(b) for i, b in self.bytes_of.items()}
        #: Tokens that no merges lead to; as a whole string they count all the same.
        self.odd = {b for i, b in self.bytes_of.items() if len(b) > 1 and self.split(i) is None}
        self.clear()

    def clear(self) -> None:
        self.states: dict[tuple, dict] = {}
        self.start = self.state(((-1, 0),))

    def state(self, places: tuple) -> dict:
        """A state is the mapping of its arcs: byte to (state, token); at -1 it has its places."""
        found = self.states.get(places)
        if found is None:
            found = self.states[places] = {-1: places}
        return found

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens of the last merge that makes a token; a single byte has none."""
        if token not in self.splits:
            word = self.bytes_of[token]
            self.splits[token] = next(
                ((self.ranks[word[:i]], self.ranks[word[i:]]) for i in range(1, len(word))
                 if word[:i] in self.ranks and word[i:] in self.ranks and self.apart(self.ranks[word[:i]], self.ranks[word[i:]], token)),
                None,
            )
        return self.splits[token]

    def apart(self, a: int, b: int, before: int) -> bool:
        """Whether the merges below rank ``before`` leave a and b, side by side, as these two tokens.

        Undoes the merges on both sides of the border from the last to the first, and asks each time
        whether a merge across the border would have come earlier. Of equal ranks the left one comes first."""
        if a >= before or b >= before:
            return False
        limit = before
        while True:
            across = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
            if across is not None and across < limit:
                return False
            left, right = self.split(a), self.split(b)
            if right is not None and (left is None or b >= a):
                limit, b = b + 1, right[0]
            elif left is not None:
                limit, a = a, left[1]
            else:
                return True

    def fits(self, a: int, b: int) -> bool:
        """Whether token b may follow token a; a is -1 at the start."""
        if a < 0:
            return len(self.bytes_of[b]) == 1 or self.split(b) is not None
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            known = self.pairs[a, b] = self.apart(a, b, 1 << 40)
        return known

    def arc(self, s: dict, byte: int) -> tuple[dict, int]:
        places, new, step, token = [], -1, self.step, self.token
        for place in s[-1]:
            child = step.get(place[1] * 256 + byte)
            if child is not None:
                if new < 0 and (t := token.get(child)) is not None and self.fits(place[0], t):
                    new = t
                if child not in self.leaves:
                    places.append((place[0], child))
        places.append((new, 0))
        found = s[byte] = self.state(tuple(places)), new
        return found

    def encode(self, word: bytes) -> list[int]:
        """The tokens of a string, in one pass."""
        if word in self.odd:
            return [self.ranks[word]]
        if len(self.states) > MAX_STATES:
            self.clear()
        s, out = self.start, []
        for i in range(0, len(word), FLUSH):
            ends = self.settle(s, ends, out) if i else []
            push = ends.append
            for byte in word[i : i + FLUSH]:
                s, t = s.get(byte) or self.arc(s, byte)
                push(t)
        return out + self.back(ends, len(ends)) if out else self.back(ends, len(ends))

    def back(self, ends: list[int], n: int) -> list[int]:
        """The tokens of the first n bytes, from the token that ends at each."""
        out, size = [], self.size
        while n > 0:
            t = ends[n - 1]
            out.append(t)
            n -= size[t]
        out.reverse()
        return out

    def settle(self, s: dict, ends: list[int], out: list[int]) -> list[int]:
        """Emit what all open places agree on; returns the rest of ``ends``."""
        paths = [self.back(ends, len(ends) - self.depth[node]) for _, node in s[-1]]
        k, done = 0, 0
        while k < min(map(len, paths)) and all(p[k] == paths[0][k] for p in paths):
            done += self.size[paths[0][k]]
            k += 1
        out += paths[0][:k]
        return ends[done:]


class Utf8:
    """An incremental UTF-8 decoder over tokens. Its state: the bytes of a character that has begun."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.arcs: dict[tuple[bytes, int], tuple[bytes, str]] = {}
        whole = {i: self.read(b"", b) for i, b in bytes_of.items()}
        self.plain = {i: text for i, (held, text) in whole.items() if not held}

    @staticmethod
    def bounds(held: bytes) -> tuple[int, int, int]:
        """How many more bytes a begun character needs, and the range of the next one."""
        first = held[0]
        size = 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        low, high = 0x80, 0xBF
        if len(held) == 1:
            low = {0xE0: 0xA0, 0xF0: 0x90}.get(first, low)
            high = {0xED: 0x9F, 0xF4: 0x8F}.get(first, high)
        return size - len(held), low, high

    def read(self, held: bytes, data: bytes) -> tuple[bytes, str]:
        out = []
        for byte in data:
            if held:
                need, low, high = self.bounds(held)
                if low <= byte <= high:
                    held += bytes((byte,))
                    if need == 1:
                        out.append(held.decode())
                        held = b""
                    continue
                out.append("�")
                held = b""
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xF4:
                held = bytes((byte,))
            else:
                out.append("�")
        return held, "".join(out)

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """The text of the tokens, piece by piece."""
        ids = list(ids)
        pieces = list(map(self.plain.get, ids))  # arcs from the empty state back to itself
        if None not in pieces:
            yield from pieces
            return
        held, arcs = b"", self.arcs
        for token, piece in zip(ids, pieces, strict=True):
            if held or piece is None:
                arc = arcs.get((held, token))
                if arc is None:
                    arc = arcs[held, token] = self.read(held, self.bytes_of[token])
                held, piece = arc
            yield piece
        if held:
            yield "�"


#: Up to this character a text is split by Python's own matcher, which takes half the time; others by the pattern as it is.
NEAR = 0x24F


def near_pattern() -> re.Pattern:
    """``public_tokenizers.PATTERN`` for texts of characters up to ``NEAR``: its classes written out by their categories."""
    kept = lambda test: "".join(re.escape(chr(c)) for c in range(NEAR + 1) if test(chr(c)))
    letter, number = (kept(lambda c, k=k: unicodedata.category(c)[0] == k) for k in "LN")
    space = kept(lambda c: regex.fullmatch(r"\s", c))
    return re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


class Codec:
    """Text to ids and back: the pattern's matches are encoded each on its own."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fst, self.split = Transducer(ranks), regex.compile(pattern).findall
        self.near = near_pattern() if pattern == public_tokenizers.PATTERN else None
        self.far = re.compile(f"[^\0-{chr(NEAR)}]").search
        self.known: dict[str, list[int]] = {}  # words met lately, and those met before them
        self.older: dict[str, list[int]] = {}
        self.utf8 = Utf8(self.fst.bytes_of)
        self.numbers = {i: str(i) for i in self.fst.ranks.values()}

    def encode(self, text: str) -> list[int]:
        words = self.near.findall(text) if self.near and not self.far(text) else self.split(text)
        found = list(map(self.known.get, words))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = self._met(words[i])
        return list(chain.from_iterable(found))

    def _met(self, word: str) -> list[int]:
        """The ids of a word that was not among those met lately when its text began."""
        ids = self.known.get(word)
        if ids is None:
            ids = self.older.get(word) or self.fst.encode(word.encode("utf-8", "surrogatepass"))
            if len(word) <= LONG_WORD:
                if len(self.known) >= MAX_WORDS:
                    self.older, self.known = self.known, {}
                self.known[word] = ids
        return ids

    def digits(self, ids: Iterable[int]) -> str:
        """Decimal ids, parted by spaces."""
        return " ".join(map(self.numbers.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        ids = list(ids)
        pieces = list(map(self.utf8.plain.get, ids))
        return "".join(self.utf8.decode(ids) if None in pieces else pieces)


@functools.lru_cache(2)
def codec(path: str, pattern: str = public_tokenizers.PATTERN) -> Codec:
    """One for each Python worker."""
    return Codec(path, pattern)


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Rows (key, ids array<int>)."""
    path = path or vocabulary()

    def made() -> Callable[[str | None], list[tuple]]:
        own = codec(path)
        return lambda x: [(own.encode(x or ""),)]

    return map_texts(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", made, "ids array<int>", 1000).withColumnRenamed("key", key)


def decode(tokens: DataFrame, key: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """Rows (key, text string); null ids as none. An id that is not of the vocabulary is an error."""
    path = path or vocabulary()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path)
        for b in batches:
            yield pd.DataFrame({"key": b["key"], "text": [own.decode(() if x is None else x) for x in b["ids"]]})

    own, kind = carried(tokens, key)
    return restored(tokens.select(own.alias("key"), F.col(ids).alias("ids")).mapInPandas(run, f"key {kind}, text string"), "key", kind_of(tokens, key), key)


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Rows (key, n_tokens, ids_sha256, decoded_sha256): encoded, and decoded from the ids, in one pass."""
    path = path or vocabulary()
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def made() -> Callable[[str | None], list[tuple]]:
        own = codec(path)

        def trip(text: str | None) -> list[tuple]:
            ids = own.encode(text or "")
            return [(len(ids), sha(own.digits(ids).encode()), sha(own.decode(ids).encode("utf-8")))]

        return trip

    return map_texts(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", made, "n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
