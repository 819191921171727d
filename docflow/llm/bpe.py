"""Byte-level BPE encoding and decoding.

Two tiers resolve a pre-token. A minimal perfect hash over the vocabulary finds it whole; if it
isn't there, its bytes are linked to a list whose neighbours a heap merges by rank. The hash also
answers what rank two neighbours have together. Recent pre-tokens keep their ids in a bounded memo.

Cases: a null text counts as empty and has no ids; the result has one row for each row given,
repeated rows included; an empty table gives an empty one; other columns are left out, so their
names can't clash. Words of any length are merged in n log n steps.
"""

from __future__ import annotations

import base64
import string
import struct
from array import array
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from docflow.llm.common import Memo, map_rows

#: Pre-tokens of most public byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO = 320_000       # words whose ids a worker remembers
RECENT = 150_000     # byte strings whose ranks a worker remembers
MARKS = string.punctuation.replace("'", "")  # behind a word, a run of these is one pre-token
LONGEST = 64         # characters of a word that is worth remembering
MOST_IDS = 1_000_000  # ids of a vocabulary that may be broadcast

_MASK = (1 << 64) - 1
_STEP, _MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


def _slot(h: int, displacement: int, n: int) -> int:
    x = ((h ^ (displacement * _STEP)) * _MIX) & _MASK
    return ((x ^ (x >> 29)) >> 7) % n


class PerfectHash:
    """Minimal perfect hash by displacement: n keys on n slots, one probe for a lookup.

    Keys fall into buckets, and each bucket, the fullest first, gets the first displacement that
    sends all its keys to free slots. A bucket of one key stores the slot itself, as a negative.
    """

    def __init__(self, keys: list[bytes]) -> None:
        self.n = len(keys)
        self.buckets = max(1, self.n // 3)
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        if len(set(hashes)) < self.n:
            raise ValueError("two keys of the vocabulary are equal or have the same hash")
        groups: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, h in enumerate(hashes):
            groups[(h >> 32) % self.buckets].append(i)
        self.displacement = array("q", bytes(8 * self.buckets))
        self.key_at = array("l", [-1]) * self.n
        free = 0
        for b in sorted(range(self.buckets), key=lambda b: -len(groups[b])):
            members = groups[b]
            if not members:
                break
            if len(members) == 1:
                while self.key_at[free] >= 0:
                    free += 1
                self.displacement[b] = -free - 1
                self.key_at[free] = members[0]
                continue
            d = 0
            while True:
                slots = {_slot(hashes[i], d, self.n) for i in members}
                if len(slots) == len(members) and all(self.key_at[s] < 0 for s in slots):
                    break
                d += 1
            self.displacement[b] = d
            for i in members:
                self.key_at[_slot(hashes[i], d, self.n)] = i

    def index(self, key: bytes) -> int:
        """Number of the only key that this may be; whoever asks compares the two."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.displacement[(h >> 32) % self.buckets]
        return self.key_at[-d - 1 if d < 0 else _slot(h, d, self.n)]


class Vocabulary:
    """Byte strings with their ranks, which are their ids."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.keys = list(ranks)
        self.ids = array("q", ranks.values())
        self.hash = PerfectHash(self.keys)
        self.longest = max(map(len, self.keys), default=0)
        self.by_id = {i: k for k, i in ranks.items()}
        self.byte_ids = [ranks.get(bytes([b]), -1) for b in range(256)]
        self.recent = Memo(self._find, RECENT, lambda key: True)  # none is longer than a token

    def rank(self, key: bytes) -> int:
        """The id of a byte string, or -1."""
        return self.recent[key] if len(key) <= self.longest else -1

    def _find(self, key: bytes) -> int:
        if not self.keys:
            return -1
        i = self.hash.index(key)
        return self.ids[i] if self.keys[i] == key else -1

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "recent"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self.recent = Memo(self._find, RECENT, lambda key: True)  # none is longer than a token

    def merge(self, token: bytes) -> list[int]:
        """Ids of a token that isn't in the vocabulary: lowest rank first, then leftmost."""
        n = len(token)
        rank = self.recent.__getitem__ if n <= self.longest else self.rank
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(token[i : i + 2])) >= 0]
        heapify(heap)
        ids = [self.byte_ids[b] for b in token]  # of the part that begins at i; None: none does
        end = list(range(1, n + 1))              # where that part ends
        before = list(range(-1, n))              # where the part before it begins
        while heap:
            r, i, stop = heappop(heap)
            middle = end[i]
            # Stale if either part has been merged since with what is next to it.
            if ids[i] is None or middle >= stop or end[middle] != stop:
                continue
            ids[i], ids[middle], end[i], before[stop] = r, None, stop, i
            if stop < n and (r := rank(token[i : end[stop]])) >= 0:
                heappush(heap, (r, i, end[stop]))
            if i and (r := rank(token[before[i] : stop])) >= 0:
                heappush(heap, (r, before[i], stop))
        out = [x for x in ids if x is not None]
        if min(out) < 0:
            raise ValueError("the vocabulary lacks single bytes of the text")
        return out

    def encode(self, token: bytes) -> list[int]:
        whole = self.rank(token)
        return [whole] if whole >= 0 else self.merge(token)


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line for each token, its bytes in base 64 and its rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(k): int(v) for k, v in (line.split() for line in file if line.strip())}


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Read where the session runs; tasks get it by broadcast, so executors need no file."""
    ranks = read_ranks(path)
    if len(ranks) > MOST_IDS:
        raise ValueError(f"{len(ranks)} tokens are more than may be broadcast ({MOST_IDS})")
    return Vocabulary(ranks)


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Texts to ids, packed as little-endian unsigned 32-bit integers."""

    #: No pre-token of PATTERN goes on over a space that a character other than white space follows.
    cut = regex.compile(r" (?=\S)")

    def __init__(self, vocab: Vocabulary, pattern: str = PATTERN, most: int = MEMO) -> None:
        self.vocab, self.pattern = vocab, regex.compile(pattern)
        self.can_cut = pattern == PATTERN
        self.tokens = Memo(self._token, most // 5, lambda token: len(token) <= LONGEST)
        self.after_space = Memo(self._behind_space, most, lambda piece: len(piece) <= LONGEST and piece.isalpha())

    def _token(self, token: str) -> bytes:
        return packed(self.vocab.encode(token.encode()))

    def _behind_space(self, piece: str) -> bytes:
        if piece.isalpha():
            return self._token(" " + piece)
        head = piece.rstrip(MARKS)
        if head.isalpha():  # what follows it is one pre-token
            return self.after_space[head] + self.tokens[piece[len(head) :]]
        first, *others = self.pattern.findall(" " + piece)
        if first[1:].isalpha():
            return self.after_space[first[1:]] + b"".join(map(self.tokens.__getitem__, others))
        return b"".join(map(self.tokens.__getitem__, [first, *others]))

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self.tokens.__getitem__, self.pattern.findall(text)))

    def __call__(self, text: str) -> bytes:
        if not self.can_cut:
            return self._pieces(text)
        first, *others = self.cut.split(text)
        return self._pieces(first) + b"".join(map(self.after_space.__getitem__, others))


ENCODED = "token_ids"
DECODED = "decoded"


def encode(df: DataFrame, path: str, keys: list[str], text: str = "text",
           pattern: str = PATTERN) -> DataFrame:
    """`keys`, `token_ids` (packed as little-endian unsigned 32-bit integers) and `n_tokens`."""
    vocab = df.sparkSession.sparkContext.broadcast(vocabulary(path))
    schema = StructType([*(df.schema[k] for k in keys), StructField(ENCODED, BinaryType()),
                         StructField("n_tokens", LongType())])

    def make():
        encoder = _encoder(vocab, pattern)

        def one(row: tuple) -> tuple:
            ids = encoder(row[-1] or "")
            return (*row[:-1], ids, len(ids) // 4)

        return one

    return map_rows(df.select(*keys, F.col(text)), make, schema, lambda row: len(row[-2]) + 64)


def decode(df: DataFrame, path: str, keys: list[str], ids: str = ENCODED) -> DataFrame:
    """`keys` and `decoded`, the bytes of packed ids; null ids have no bytes."""
    vocab = df.sparkSession.sparkContext.broadcast(vocabulary(path))
    schema = StructType([*(df.schema[k] for k in keys), StructField(DECODED, BinaryType())])

    def make():
        _encoders.clear()  # a worker remembers words only while it encodes
        by_id = vocab.value.by_id.__getitem__

        def one(row: tuple) -> tuple:
            return (*row[:-1], b"".join(map(by_id, np.frombuffer(row[-1] or b"", "<u4").tolist())))

        return one

    return map_rows(df.select(*keys, F.col(ids)), make, schema, lambda row: len(row[-1]) + 64)


_encoders: dict = {}


def _encoder(vocab, pattern: str) -> Encoder:
    """A worker that goes on to another task keeps what it remembers."""
    key = (vocab.id, pattern) if hasattr(vocab, "id") else (id(vocab), pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocab.value, pattern)
    return _encoders[key]
