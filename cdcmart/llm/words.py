"""Words of UTF-8 texts as arrays: where they stand, and a 64-bit hash of each.

A word is a run of ASCII digits, ASCII letters (A-Z count as a-z) and all characters beyond ASCII.
Everything is decided byte by byte, since each byte of a character beyond ASCII is itself beyond it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

# Bytes hashed at once; what bounds the temporary arrays.
_SLICE = 1 << 18

_bytes = np.arange(256)
IS_WORD = ((_bytes >= 0x30) & (_bytes <= 0x39)) | (_bytes >= 0x80)
IS_WORD |= ((_bytes | 0x20) >= 0x61) & ((_bytes | 0x20) <= 0x7A) & (_bytes < 0x80)
LOWER = np.where((_bytes >= 0x41) & (_bytes <= 0x5A), _bytes + 0x20, _bytes).astype(np.uint8)

_random = np.random.default_rng(20240229)
_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, _SLICE + 1), _powers(_UNBASE, _SLICE + 1)


@dataclass
class Words:
    """The words of a run of documents: ``bounds[i]:bounds[i + 1]`` are those of document ``i``."""

    data: np.ndarray  # lower-cased bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray


def _hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words of ``data``, slice after slice; a slice ends where a word begins."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + _SLICE, side="right")))
        size = int(ends[j - 1]) - base
        up, down = (_UP, _DOWN) if size <= _SLICE else (_powers(_BASE, size + 1), _powers(_UNBASE, size + 1))
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_VALUE[data[base : base + size]] * up[:size], out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)
        i = j
    return mixed(out)


def words_of(texts: list[bytes | None], limit: int = 1 << 20) -> Iterator[tuple[int, int, Words]]:
    """Words of ``texts[i:j]`` for runs of about ``limit`` bytes; a longer text makes a run of its own. Null has none."""
    i = 0
    while i < len(texts):
        size, j = 0, i
        while j < len(texts) and (j == i or size + len(texts[j] or b"") <= limit):
            size += len(texts[j] or b"") + 1
            j += 1
        run = [t or b"" for t in texts[i:j]]
        data = LOWER[np.frombuffer(b"\n".join(run), np.uint8)]
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = IS_WORD[data]
        turns = np.flatnonzero(np.diff(inside))
        starts, ends = turns[0::2], turns[1::2]
        after = np.cumsum([len(t) + 1 for t in run])
        bounds = np.concatenate([[0], np.searchsorted(starts, after)])
        yield i, j, Words(data, starts, ends, _hashed(data, starts, ends), bounds)
        i = j
