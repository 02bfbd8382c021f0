"""Words of many texts at once: places and 64-bit hashes, as numpy arrays.

A word is a run of bytes that are not ASCII white space (0x20, 0x09 to 0x0D). The hash
of a word is a polynomial over random values of its bytes, taken from running sums,
so no Python code runs per word. Equal words have equal hashes in every task.
"""

from __future__ import annotations

import numpy as np

# The multiplier of a place, and the seed of the values of the bytes.
BASE = 0x9E3779B97F4A7C15
SEED = 20240607
BLOCK = 1 << 18


def _mix(x):
    """Spread the bits of 64-bit numbers (an in-place splitmix step)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int):
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def byte_values(fold_case: bool = False):
    values = np.random.Generator(np.random.PCG64(SEED)).integers(1, 2**64 - 1, 256, dtype=np.uint64, endpoint=True)
    if fold_case:
        values[65:91] = values[97:123]
    return values


def space_table():
    out = np.zeros(256, bool)
    out[[32, 9, 10, 11, 12, 13]] = True
    return out


def term_table():
    """For terms rather than words: all ASCII bytes but letters and digits separate."""
    out = np.ones(256, bool)
    out[48:58] = out[65:91] = out[97:123] = out[128:] = False
    return out


class Words:
    """Finds the words of flat text. Keeps its tables, so make one per task."""

    def __init__(self, separators=None, fold_case: bool = False):
        self.separators = space_table() if separators is None else separators
        self.values = byte_values(fold_case)
        self.up = _powers(BASE, BLOCK + 1)
        self.down = _powers(pow(BASE, -1, 2**64), BLOCK + 1)

    def spans(self, data, offsets):
        """``(starts, ends, first)``: places of all words in ``data``; word ``first[d]`` is document d's first."""
        low, high = int(offsets[0]), int(offsets[-1])
        inside = np.zeros(high - low + 2, np.int8)
        inside[1:-1] = ~self.separators[data[low:high]]
        change = np.diff(inside)
        starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        cuts = offsets[1:-1] - low
        cuts = cuts[(cuts > 0) & (cuts < high - low)]
        if len(cuts):
            cuts = np.unique(cuts)
            cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]  # a word runs over the border of two texts
            starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
        return starts + low, ends + low, np.searchsorted(starts, offsets - low)

    def hashes(self, data, starts, ends):
        """64-bit hash of ``data[start:end]`` for each span; spans are sorted and do not overlap."""
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            origin = int(starts[i])
            j = max(int(np.searchsorted(ends, origin + BLOCK, side="right")), i + 1)
            size = int(ends[j - 1]) - origin
            if size >= len(self.up):
                self.up, self.down = _powers(BASE, size + 1), _powers(pow(BASE, -1, 2**64), size + 1)
            sums = np.empty(size + 1, np.uint64)
            sums[0] = 0
            np.cumsum(self.values[data[origin : origin + size]] * self.up[:size], out=sums[1:])
            s, e = starts[i:j] - origin, ends[i:j] - origin
            out[i:j] = _mix((sums[e] - sums[s]) * self.down[s])
            i = j
        return out


def grams(hashes, size: int, salt: int = 1):
    """Hash of each run of ``size`` hashes; the last ``size - 1`` places have none."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    step = pow(BASE, 3, 2**64)
    factor = (2 * salt + 1) * BASE % 2**64
    for k in range(size):
        out += hashes[k : k + n] * np.uint64(factor)
        factor = factor * step % 2**64
    return _mix(out)


def owners(first):
    """Index of the document of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def normalised(text: bytes) -> bytes:
    """Each run of ASCII white space as one space."""
    if not text:
        return text
    body = b" ".join(text.split())
    if not body:
        return b" "
    return (b" " if text[:1].isspace() else b"") + body + (b" " if text[-1:].isspace() else b"")
