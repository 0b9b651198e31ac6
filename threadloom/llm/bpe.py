"""Byte-level BPE over a public vocabulary.

Method: a text is split by the vocabulary's pattern; in each part a segment tree over the ranks of adjacent pairs holds
at its root the leftmost pair of lowest rank. That pair is merged, three leaves change in O(log n), and so on until the
root holds no mergeable pair. A part of n bytes takes O(n log n), so one unbroken text of any length is no worst case.
Parts repeat, so a worker keeps the ids of short ones, up to a fixed number.

Defined cases: null and empty texts have no ids; text that spells a special token is ordinary text; invalid UTF-8 is
replaced before encoding.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the public split pattern that belongs to the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TOKENIZER_DIR = os.environ.get("THREADLOOM_TOKENIZERS", "/opt/tokenizers")
#: Parts kept by a worker: at most this many, each of at most this many bytes.
KEPT_PARTS, KEPT_BYTES = 1 << 17, 64
_NONE = 1 << 62


class Bpe:
    """ranks: token bytes to id; an id is also the rank of the merge that makes the token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.lengths = np.zeros(max(ranks.values(), default=-1) + 1, dtype=np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)
        self._split = regex.compile(PATTERN)
        self._kept: dict[str, tuple[int, ...]] = {}

    @classmethod
    def from_rank_file(cls, data: bytes) -> Bpe:
        pairs = (line.split() for line in data.splitlines() if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs})

    def merge(self, part: bytes) -> list[int]:
        """Ids of one part."""
        ranks, n = self.ranks, len(part)
        if n == 1:
            return [ranks[part]]
        symbol = [part[i : i + 1] for i in range(n)]
        following = list(range(1, n + 1))
        preceding = list(range(-1, n - 1))
        leaves = 1
        while leaves < n - 1:
            leaves *= 2
        # A node holds rank * n + position, so the least is the leftmost pair of the lowest rank.
        tree = [_NONE] * (2 * leaves)
        for i in range(n - 1):
            rank = ranks.get(part[i : i + 2])
            if rank is not None:
                tree[leaves + i] = rank * n + i
        for node in range(leaves - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b

        def put(i: int, value: int) -> None:
            node = leaves + i
            tree[node] = value
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                least = a if a < b else b
                if tree[node] == least:
                    break
                tree[node] = least
                node >>= 1

        while tree[1] != _NONE:
            i = tree[1] % n
            j = following[i]
            symbol[i] += symbol[j]
            after = following[j]
            following[i] = after
            symbol[j] = b""
            if j < n - 1:
                put(j, _NONE)
            rank = None
            if after < n:
                preceding[after] = i
                rank = ranks.get(symbol[i] + symbol[after])
            put(i, _NONE if rank is None else rank * n + i)
            before = preceding[i]
            if before >= 0:
                rank = ranks.get(symbol[before] + symbol[i])
                put(before, _NONE if rank is None else rank * n + before)
        return [ranks[s] for s in symbol if s]

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        if not text:
            return ids
        kept = self._kept
        for part in self._split.findall(text):
            found = kept.get(part)
            if found is None:
                data = part.encode()
                found = tuple(self.merge(data))
                if len(data) <= KEPT_BYTES:
                    if len(kept) >= KEPT_PARTS:
                        kept.clear()
                    kept[part] = found
            ids.extend(found)
        return ids


_TOKENIZERS: dict[bytes, Bpe] = {}


def tokenizer(data: bytes) -> Bpe:
    """The tokenizer of a rank file's content, made once a worker."""
    if data not in _TOKENIZERS:
        _TOKENIZERS[data] = Bpe.from_rank_file(data)
    return _TOKENIZERS[data]


def rank_file(spark: SparkSession, path: str | None = None) -> Broadcast:
    """A rank file's content for all executors: a vocabulary of fixed size (under 1 MB), not data."""
    with open(path or os.path.join(TOKENIZER_DIR, "byte_bpe_50k.tiktoken"), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def token_ids(text: Column, ranks: Broadcast) -> Column:
    """array<int> of token ids; null and empty texts give an empty array."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = tokenizer(ranks.value)
        for texts in batches:
            yield pd.Series([bpe.encode(t) for t in texts], index=texts.index, dtype=object)

    return encode(F.make_valid_utf8(text))


def token_count(text: Column, ranks: Broadcast) -> Column:
    """Number of tokens; null and empty texts have 0."""

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = tokenizer(ranks.value)
        for texts in batches:
            yield pd.Series([len(bpe.encode(t)) for t in texts], index=texts.index, dtype="int32")

    return count(F.make_valid_utf8(text))
