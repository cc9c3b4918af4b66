"""Hashed byte n-grams, vectorized: one array operation for each n, no loop over characters."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Odd multipliers of the rolling hash (the golden ratio's bits) and of the length n.
MIX, SIZE = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


def hashed(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket below ``2 ** bits`` of the n bytes from each place of ``data`` (uint8) that has n of them."""
    count = max(0, len(data) - n + 1)
    h = np.full(count, (n * int(SIZE)) & 0xFFFFFFFF, np.uint32)
    for k in range(n):
        h = (h ^ data[k:k + count]) * MIX
        h ^= h >> np.uint32(15)
    return h >> np.uint32(32 - bits)


def packed(texts: Iterable[bytes], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
    """Texts laid end to end in arrays of about ``limit`` bytes: ``(bytes, starts, index of the text at each start)``.

    A text longer than ``limit`` comes in several parts with the same index, so nothing is left out
    and no array outgrows the limit by more than that.
    """
    parts: list[bytes] = []
    index: list[int] = []
    held = 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t)), limit):
            part = t[at:at + limit]
            if parts and held + len(part) > limit:
                yield _joined(parts, index)
                parts, index, held = [], [], 0
            parts.append(part)
            index.append(i)
            held += len(part)
    if parts:
        yield _joined(parts, index)


def _joined(parts: list[bytes], index: list[int]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    sizes = np.array([len(p) for p in parts])
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes, index
