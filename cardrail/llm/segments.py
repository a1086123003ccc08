"""Texts as rows of segments that are handled once each: different segments are numbered, results are dealt back."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from itertools import chain

import numpy as np

LATIN = [chr(i) for i in range(256)]


def latin_findall(pattern: str) -> Callable[[str], list[str]]:
    """``findall`` of a Unicode pattern for Latin-1 texts, with its classes of letters, numbers and space spelled out."""
    kinds = {rf"\p{{{k}}}": [c for c in LATIN if unicodedata.category(c)[0] == k] for k in "LN"}
    # white space by the Unicode property, which leaves out the separators U+001C to U+001F
    kinds[r"\s"] = [c for c in LATIN if c.isspace() and not "\x1c" <= c <= "\x1f"]
    spelled = {name: "".join(map(re.escape, characters)) for name, characters in kinds.items()}
    inside = re.compile("|".join(map(re.escape, spelled)))

    def spell(found: re.Match) -> str:
        part = found[0]
        if part.startswith("["):
            return inside.sub(lambda m: spelled[m[0]], part)
        return f"[^{spelled[chr(92) + 's']}]" if part == r"\S" else f"[{spelled[part]}]"

    return re.compile(re.sub(r"\[[^\]]*\]|\\p\{\w\}|\\s|\\S", spell, pattern)).findall


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def numbered(lists: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different segments of some lists, the number of each occurrence, and the end of each list among them."""
    flat = list(chain.from_iterable(lists))
    different = list(set(flat))
    number = dict(zip(different, range(len(different)), strict=True))
    codes = np.fromiter(map(number.__getitem__, flat), "i8", len(flat))
    return different, codes, np.cumsum([len(x) for x in lists], dtype="i8")


class Rows:
    """Rows of whole numbers of any length, in one array."""

    def __init__(self, values: np.ndarray, lengths: np.ndarray):
        self.values, self.lengths = values, lengths
        self.starts = np.cumsum(lengths) - lengths

    @classmethod
    def of(cls, lists: list[list[int]]) -> "Rows":
        lengths = np.fromiter(map(len, lists), "i8", len(lists))
        return cls(np.fromiter(chain.from_iterable(lists), "i8", int(lengths.sum())), lengths)

    def take(self, codes: np.ndarray) -> "Rows":
        """The rows of these numbers, one after the other."""
        lengths = self.lengths[codes]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[codes] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        return Rows(self.values[at], lengths)


def cut(values: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """``values`` in parts that end at ``ends``."""
    return np.split(values, ends[:-1]) if len(ends) else []
