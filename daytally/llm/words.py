"""Words and their hashes, for a batch of texts at once."""

import numpy as np
import pyarrow as pa

from daytally.llm.shared import text_bytes

_SPACES = [0x20, *range(0x09, 0x0E)]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[_SPACES] = True
# Only ASCII letters and digits, and all bytes beyond ASCII, belong to a word.
IS_MARK = np.ones(256, bool)
IS_MARK[0x80:] = False
for _range in ("09", "AZ", "az"):
    IS_MARK[ord(_range[0]):ord(_range[1]) + 1] = False

_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPAN = 1 << 16
_POWERS = np.cumprod(np.full(_SPAN, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
# Bytes hashed at once.
_PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Lower-cased words of a text column: ``start`` and ``end`` in ``data``, ``row`` of each, 64-bit ``hash``,
    and ``first``, the number of the first word of each row (one more than rows)."""

    def __init__(self, column: pa.Array, separators: np.ndarray = IS_SPACE):
        raw, self.offsets = text_bytes(column)
        self.data = LOWER[raw]
        gap = separators[self.data]
        self.rows = len(self.offsets) - 1
        begins = ~gap
        begins[1:] &= gap[:-1]
        inner = self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]
        begins[inner] = ~gap[inner]
        stops = ~gap
        stops[:-1] &= gap[1:]
        stops[inner[1:] - 1] = ~gap[inner[1:] - 1]
        if len(gap):
            stops[-1] = not gap[-1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.row = np.repeat(np.arange(self.rows), np.diff(self.first))
        self.hash = self._hashes(gap)

    def _hashes(self, gap: np.ndarray) -> np.ndarray:
        """A polynomial over the bytes of each word, piece by piece."""
        out = np.zeros(len(self.start), np.uint64)
        cuts = np.unique(np.searchsorted(self.start, np.arange(0, len(gap) + _PIECE, _PIECE)))
        for low, high in zip(cuts[:-1], cuts[1:]):
            start = self.start[low:high]
            base, stop = start[0], self.end[high - 1]
            step = np.arange(stop - base) - np.repeat(start - base, np.diff(np.append(start, stop)))
            value = _VALUES[self.data[base:stop]] * _POWERS[step & (_SPAN - 1)]
            value[gap[base:stop]] = 0
            out[low:high] = np.add.reduceat(value, start - base)
        return mix(out + (self.end - self.start).astype(np.uint64))

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and row of every run of ``width`` words; a row with fewer words gives one of all of them."""
        if not len(self.hash):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        n = len(self.hash)
        whole = np.zeros(n, np.uint64)
        for k in range(width):
            whole[:n - k] = mix(whole[:n - k] + self.hash[k:] * np.uint64(2 * k + 1))
        last = np.arange(n) + width <= self.first[self.row + 1]
        value, row = whole[last], self.row[last]
        count = np.diff(self.first)
        short = np.flatnonzero((count > 0) & (count < width))
        if not len(short):
            return value, row
        part = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            more = count[short] > k
            part[more] = mix(part[more] + self.hash[self.first[short[more]] + k] * np.uint64(2 * k + 1))
        part = mix(part + count[short].astype(np.uint64))
        value, row = np.concatenate([value, part]), np.concatenate([row, short])
        order = np.argsort(row, kind="stable")
        return value[order], row[order]


def distinct_per_row(value: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, sorted, and where each row starts (one more than rows)."""
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[keep], row[keep]
    return value, np.searchsorted(row, np.arange(rows + 1))
