"""Hashing of many short strings at once."""

from __future__ import annotations

import numpy as np

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def letters(words: list[str], before: str = "", after: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words one after the other, each between two border strings; the words' lengths with
    their borders, and where each begins."""
    code = np.frombuffer("".join([before + w + after for w in words]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(U)
    n = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + len(before) + len(after)
    return code, n, np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)


def spelled(code: np.ndarray, n: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A hash of each (non-empty) word's letters and their places."""
    place = (np.arange(len(code)) - np.repeat(begin, n)).astype(U)
    return mix(np.add.reduceat(mix((code + U(1)) * U(0x9E3779B97F4A7C15) + place), begin))
