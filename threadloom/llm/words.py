"""Words compared without case, accents and punctuation."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict

WORD = re.compile(r"[^\W_]+")
#: Every combining mark of the basic plane (one table look-up a character).
_MARKS = re.compile("[" + "".join(chr(c) for c in range(0x300, 0x10000) if unicodedata.combining(chr(c))) + "]+")


def fold(text: str | None) -> str:
    """Case folded, without combining marks; null is empty."""
    if not text:
        return ""
    if text.isascii():
        return text.lower()
    return _MARKS.sub("", unicodedata.normalize("NFD", text)).casefold()


#: Turns ASCII letters to lower case and what is neither letter nor digit to spaces; other characters stay.
_PLAIN = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in (ord(chr(i).lower()) if i < 0x80 else i for i in range(256)))
#: Folded words of pieces of text that aren't ASCII, up to a fixed number.
_FOLDED: dict[str, tuple[str, ...]] = {}
KEPT = 1 << 17


def _pieces(text: str | None) -> list[str]:
    """A text's ASCII words in lower case, and what stands between them as it is."""
    return text.encode("utf-8", "replace").translate(_PLAIN).decode().split() if text else []


def _folded(piece: str) -> tuple[str, ...]:
    found = _FOLDED.get(piece)
    if found is None:
        if len(_FOLDED) >= KEPT:
            _FOLDED.clear()
        found = _FOLDED[piece] = tuple(WORD.findall(fold(piece)))
    return found


def words(text: str | None) -> list[str]:
    """Runs of letters and digits, folded. ASCII is cut as bytes; other pieces seen before cost a look-up."""
    found = _pieces(text)
    if not text or text.isascii():
        return found
    return [x for w in found for x in ((w,) if w.isascii() else _folded(w))]


def counts(text: str | None) -> Counter[str]:
    """How often a text has each of its words."""
    found = Counter(_pieces(text))
    if text and not text.isascii():
        for piece in [w for w in found if not w.isascii()]:
            n = found.pop(piece)
            for w in _folded(piece):
                found[w] += n
    return found


def lcs(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, bit-parallel: O(len(a) * len(b) / 64)."""
    if len(a) < len(b):
        a, b = b, a
    at: dict[str, int] = defaultdict(int)
    for j, w in enumerate(b):
        at[w] |= 1 << j
    full = (1 << len(b)) - 1
    v = full
    for w in a:
        m = at.get(w)
        if m:
            x = v & m
            v = ((v + x) | (v - x)) & full
    return len(b) - v.bit_count()
