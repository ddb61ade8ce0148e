"""Word and shingle hashes of many texts at once, inside a task.

Words are runs of bytes other than white space (``0x20``, ``0x09`` to ``0x0D``), with A-Z in lower
case. A word's hash comes out of two running sums over all bytes, so no word is ever a Python
object. Hashes have 64 bits; two different words or shingles of a corpus share one with a
probability of about the square of their number over 2**65.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

SLICE_BYTES = 1 << 18
SHINGLE_WORDS = 5

_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_LOWER = _LOWER.astype(np.uint8)
_RANDOM = np.random.default_rng(20240229)  # any fixed seed: all tasks must agree
_BYTE = _RANDOM.integers(0, 1 << 64, 256, dtype=np.uint64)[_LOWER]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_FOLD = np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = (np.full(n, base, np.uint64) for base in (_BASE, _INVERSE))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _hashes(data: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word in some bytes."""
    space = between[data]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _powers(max(SLICE_BYTES, 1 << (len(data) - 1).bit_length() if len(data) else 0))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * up[: len(data)])])
    words = (sums[ends] - sums[starts]) * down[starts]
    return starts, mixed(words + (ends - starts).astype(np.uint64) * _FOLD)


def word_hashes(
    texts: Iterable[str | None], between: np.ndarray = _SPACE
) -> Iterator[np.ndarray]:
    """The hashes of each text's words, in order; a null text has none.

    ``between`` tells for each byte whether it stands between words, as a line end must.
    """
    for batch in _slices(texts):
        if len(batch) == 1:
            yield _long(batch[0], between)
            continue
        lengths = np.array([len(x) + 1 for x in batch])
        data = np.frombuffer(b"\n".join(batch) + b"\n", np.uint8)
        starts, hashes = _hashes(data, between)
        bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
        for first, last in zip(bounds, bounds[1:], strict=False):
            yield hashes[first:last]


def _slices(texts: Iterable[str | None]) -> Iterator[list[bytes]]:
    batch: list[bytes] = []
    size = 0
    for text in texts:
        data = (text or "").encode()
        if batch and size + len(data) >= SLICE_BYTES:  # with a line end each, that many at most
            yield batch
            batch, size = [], 0
        batch.append(data)
        size += len(data) + 1
    if batch:
        yield batch


def _long(data: bytes, between: np.ndarray) -> np.ndarray:
    """A text of any length, in slices that end between words."""
    codes = np.frombuffer(data, np.uint8)
    spaces = np.flatnonzero(between[codes])
    parts, at = [np.empty(0, np.uint64)], 0
    while at < len(codes):
        end = len(codes)
        if end - at > SLICE_BYTES:
            k = np.searchsorted(spaces, at + SLICE_BYTES)
            end = int(spaces[k]) if k < len(spaces) else end
        parts.append(_hashes(codes[at:end], between)[1])
        at = end
    return np.concatenate(parts)


def shingle_set(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingles of ``size`` words, sorted.

    Fewer words make one shingle of all of them; no words make none.
    """
    if len(words) == 0:
        return words
    size = min(size, len(words))
    folded = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        folded = folded * _FOLD + words[k : len(words) - size + 1 + k]
    return np.unique(mixed(folded))
