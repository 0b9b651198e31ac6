"""Splitting of oversized texts at natural boundaries.

Method: the prefix sums of token lengths give each token's offset; the offsets at which a line or a sentence ends are a
sorted array of boundaries. A piece ends at the last boundary under the limit (binary search); where there is none it
ends between words, and where there is no such place either, after the last whole character under the limit. The next
piece starts ``overlap`` tokens earlier, moved forward to a boundary if one lies in that stretch.

Every piece is encoded again by itself and, should a cut inside a part have raised its count, ended one boundary
earlier, so no piece exceeds the limit. Without their overlaps the pieces spell the text. Whole texts are read; a text
needs memory in proportion to its own length only.

Defined cases: null, empty and short texts are not oversized and have no pieces.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.bpe import Bpe, token_count, tokenizer

#: A line's end, or a sentence mark with its closing quotes and brackets that white space follows (none need after
#: full-width marks).
_NATURAL = regex.compile(r"""\n+|[.!?…]+["'”’»)\]]*(?=\s)|[。！？]+[」』）]*""")
_BETWEEN_WORDS = regex.compile(r"\s+")


def pieces(text: str, bpe: Bpe, limit: int, overlap: int) -> list[tuple[int, int, int, int, str]]:
    """(start, end, tokens, boundary, text) of each piece in characters; none if the text is within the limit.

    boundary is 0 for the text's end, 1 for a natural boundary, 2 for one between words, 3 for a hard cut.
    """
    ids = bpe.encode(text)
    if len(ids) <= limit:
        return []
    ends = np.cumsum(bpe.lengths[ids])  # bytes after each token
    width = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    width = 1 + (width >= 0x80) + (width >= 0x800) + (width >= 0x10000)
    chars = np.cumsum(width)  # bytes after each character
    at = np.searchsorted(chars, ends)
    whole = chars[np.minimum(at, len(chars) - 1)] == ends  # the token ends with a character
    offset = {0: 0} | {int(a) + 1: i + 1 for i, (a, w) in enumerate(zip(at, whole)) if w}  # characters to tokens
    char_of = {i: c for c, i in offset.items()}
    hard = sorted(char_of)
    natural = sorted({offset[m.end()] for m in _NATURAL.finditer(text) if m.end() in offset})
    words = sorted({offset[c] for m in _BETWEEN_WORDS.finditer(text) for c in m.span() if c in offset})
    tiers = (natural, words, hard)
    out, start, n = [], 0, len(ids)
    while True:
        end, tier, top = n, 0, start + limit
        while True:
            if n <= top:
                end, tier = n, 0
            else:
                for tier, places in enumerate(tiers, 1):
                    i = bisect_right(places, top) - 1
                    if i >= 0 and places[i] > start + (overlap if tier < 3 else 0):
                        end = places[i]
                        break
                else:
                    end, tier = hard[bisect_right(hard, start)], 3
            piece = text[char_of[start] : char_of[end]]
            count = len(bpe.encode(piece))
            if count <= limit or end <= start + 1 or top <= start + 1:
                break
            top = min(top, end) - 1
        out.append((char_of[start], char_of[end], count, tier, piece))
        if end >= n:
            return out
        back = max(end - overlap, start + 1)
        for places in tiers:
            i = bisect_left(places, back)
            if i < len(places) and places[i] < end:
                start = places[i]
                break
        else:
            start = end


def oversized(df: DataFrame, key: str, text: str, ranks: Broadcast, limit: int = 800) -> DataFrame:
    """(key, tokens) of each text of more than ``limit`` tokens.

    A token has at least one byte, so texts of at most ``limit`` bytes are ruled out without being encoded.
    """
    valid = F.make_valid_utf8(F.col(text))  # what replaces invalid bytes can be longer than they
    long_enough = df.where(F.octet_length(valid) > limit).select(key, text)
    return long_enough.select(key, token_count(F.col(text), ranks).alias("tokens")).where(F.col("tokens") > limit)


def split_oversized(
    df: DataFrame, key: str, text: str, ranks: Broadcast, limit: int = 800, overlap: int = 40
) -> DataFrame:
    """(key, piece, start_char, end_char, tokens, boundary, text) of the pieces of every oversized text."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be less than limit")
    kind = dict(df.dtypes)[key]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = tokenizer(ranks.value)
        names = [key, "piece", "start_char", "end_char", "tokens", "boundary", "text"]
        for batch in batches:
            rows = [
                (k, i, *p)
                for k, t in zip(batch[key], batch["_text"])
                for i, p in enumerate(pieces(t, bpe, limit, overlap))
            ]
            yield pd.DataFrame(rows, columns=names)

    valid = F.make_valid_utf8(F.col(text))
    source = df.where(F.octet_length(valid) > limit).select(key, valid.alias("_text"))
    return source.mapInPandas(
        cut, f"`{key}` {kind}, piece int, start_char int, end_char int, tokens int, boundary int, text string"
    )
