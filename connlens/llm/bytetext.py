"""Array-wise words and hashes over the UTF-8 bytes of many texts at once (used inside tasks)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Base of the polynomial hash, and its inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and INVERSE**i modulo 2**64 for i < n, at least."""
    global _powers
    if len(_powers[0]) < n:
        with np.errstate(over="ignore"):
            _powers = tuple(np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, x, np.uint64)))) for x in (BASE, INVERSE))
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed one-to-one image of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes, a newline after each, and where each text begins (one more entry: the end)."""
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    return data, np.concatenate(([0], np.cumsum(np.fromiter((len(b) + 1 for b in raw), np.int64, len(raw)))))


@dataclass
class Words:
    start: np.ndarray  # byte positions
    end: np.ndarray
    text: np.ndarray  # number of the text


def words(data: np.ndarray, begin: np.ndarray, inside: np.ndarray) -> Words:
    """The maximal runs of bytes whose entry in the table ``inside`` is true (a newline's must be false)."""
    edges = np.diff(np.concatenate(([0], inside[data].view(np.int8), [0])))
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return Words(start, end, np.searchsorted(begin, start, side="right") - 1)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span (a polynomial over them, mixed); a prefix sum gives all of them."""
    up, down = powers(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)])))
        return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
