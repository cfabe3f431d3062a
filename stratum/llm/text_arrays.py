"""Words and shingles of many texts at once, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True

#: Texts are put together up to so many bytes; a longer text stands alone.
CHUNK = 1 << 20

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(CHUNK, 1 << max(n - 1, 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        both = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            both.append(np.multiply.accumulate(powers))
        _POWERS[size] = both[0], both[1]
    return _POWERS[size][0][:n], _POWERS[size][1][:n]


def column_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of bounded size, with the number of the first."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= CHUNK):
            size += len(texts[to])
            to += 1
        yield at, texts[at:to]
        at = to


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and where each text's words start (and the last ends)."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    space = np.ones(len(data) + 2, bool)
    space[1:-1] = _SPACE[data]
    begin = np.flatnonzero(space[:-1] & ~space[1:])
    end = np.flatnonzero(~space[:-1] & space[1:])
    powers, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    text_ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    bounds = np.concatenate([[0], np.searchsorted(begin, text_ends)])
    return mixed((sums[end] - sums[begin]) * inverse[begin]), bounds


def shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different shingles of each text: number of the text, hash, and how often it occurs there.

    A text with fewer words than ``width`` has one shingle of all of them, one without words has none.
    """
    words, bounds = word_hashes(texts)
    counts = np.diff(bounds)
    runs = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(texts)), runs)
    first = np.repeat(bounds[:-1] - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())
    last = np.repeat(bounds[1:], runs)
    h = np.zeros(len(first), np.uint64)
    for i in range(width):
        at = first + i
        value = np.where(at < last, words[np.minimum(at, max(len(words) - 1, 0))], np.uint64(i + 1)) if len(words) else h
        h = mixed(h * np.uint64(_BASE) + value)
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    heads = np.flatnonzero(new)
    return owner[heads], h[heads], np.diff(np.append(heads, len(h)))
