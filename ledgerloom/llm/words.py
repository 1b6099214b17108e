"""Words of many texts at once, as hashes in NumPy arrays.

A word's hash is a difference of polynomial prefix sums modulo 2 ** 64 over the joined texts,
so a batch costs a few array operations for each byte and none for each word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Bytes of text that are hashed together; a longer text is hashed in parts cut between words.
PART_BYTES = 1 << 20
#: ASCII letters to lower case and ASCII white space to blanks.
FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
#: Odd numbers; the second one serves to check equality.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
MASK = (1 << 64) - 1


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that looks random (the finaliser of splitmix64)."""
    x = x + np.uint64((seed * BASES[0] + 0x632BE59BD9B4E019) & MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    row = np.ones(1, np.uint64)
    while len(row) <= size:
        row = np.concatenate([row, row * np.uint64(pow(base, len(row), 1 << 64))])
    return row[: size + 1]


def places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of folded text."""
    edges = np.flatnonzero(np.diff(np.concatenate([[True], np.frombuffer(data, np.uint8) == 32, [True]])))
    return edges[0::2], edges[1::2]


def hashes(data: bytes, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Of the words of folded text, which is longer than ``PART_BYTES`` only where one word is."""
    size = max(PART_BYTES, len(data))
    up, down = _powers(BASES[which], size), _powers(pow(BASES[which], -1, 1 << 64), size)
    a = np.frombuffer(data, np.uint8).astype(np.uint64)
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a + np.uint64(1)) * up[: len(a)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F), which)


def groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Neighbours whose bytes with a blank after each are at most ``PART_BYTES``; a longer text is alone."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) + 1 > PART_BYTES:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield held


def parts(text: bytes) -> Iterator[bytes]:
    """A long folded text in parts cut at blanks; a word longer than a part makes its part longer."""
    at = 0
    while len(text) - at > PART_BYTES:
        cut = text.rfind(b" ", at + 1, at + PART_BYTES)
        cut = text.find(b" ", at + PART_BYTES) if cut < 0 else cut
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]
