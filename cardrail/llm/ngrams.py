"""Hashes of words and of runs of words, the same in every worker."""

from __future__ import annotations

import numpy as np

from cardrail.llm.common import held_in_worker

REMEMBERED_WORDS = 400_000

_MIX_1, _MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of unsigned 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(33))) * _MIX_1
    x = (x ^ (x >> np.uint64(33))) * _MIX_2
    return x ^ (x >> np.uint64(33))


class Words:
    """The 64-bit hashes of a text's words: what stands between white space, in lower case."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def hashes(self, text: str | None) -> np.ndarray:
        from xxhash import xxh3_64_intdigest

        words = (text or "").lower().split()
        if len(self.known) > REMEMBERED_WORDS:
            self.known = {}
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), "u8", len(words))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number and of its inverse, modulo 2**64; kept and grown as needed."""
    if len(_power[0]) < n:
        inverse = np.uint64(pow(int(_STEP), -1, 1 << 64))
        for i, base in enumerate((_STEP, inverse)):
            _power[i] = np.cumprod(np.r_[np.uint64(1), np.full(2 * n, base, "u8")], dtype="u8")
    return _power[0][:n], _power[1][:n]


_power: list[np.ndarray] = [np.ones(1, "u8"), np.ones(1, "u8")]


def runs(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of every run of ``n`` words, by its place; none in a shorter text.

    A run is a polynomial in its words' hashes, taken from sums over the text's start, so that ``n`` costs nothing.
    """
    if len(words) < n:
        return np.zeros(0, "u8")
    up, down = _powers(len(words))
    sums = np.zeros(len(words) + 1, "u8")
    np.cumsum(words * up, out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * down[: len(words) - n + 1])


def words_in_worker() -> Words:
    """The word hashes remembered by this Python worker."""
    return held_in_worker("words", Words)
