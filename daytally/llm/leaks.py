"""Benchmark passages in documents, found by SimHash over item-sized windows.

Texts are read as lower-cased words of letters and digits. An item of n words is compared with every window of n
words (a shorter document is one window). A window gets a 128-bit SimHash of its words, weighted by how often
they occur. The items' fingerprints are indexed by eight blocks of 16 bits: two fingerprints at most ``RADIUS`` bits
apart differ in at most three bits of some block, so looking up every block with up to two bits flipped, in an index
that holds every block with up to one bit flipped, meets each item within the radius. What is met and within the
radius is verified: the shingles of window and item, weighted by how often they occur, must overlap in at least
``percent`` percent. A similar window may lie beyond the radius, if one word is repeated in it, so windows are also met
directly, by the rarest shingles of an item: as many as a similar window can lack, and one more, of which it must have
one. Windows that cannot be that similar, because too few of their shingles occur in the items of
their size, are not fingerprinted; that test loses nothing.

Items travel to the tasks in portions of bounded size, one pass over the documents for each portion.

Rows and edge cases: one row comes out per document and item it holds, with its best window, the first if several
are as good; a document without any gives none. Rows of the documents are independent, so a repeated id may repeat
a row. Null text counts as empty and holds nothing; an item without words is found nowhere. Texts of fewer words than a
shingle make one shingle of all of them. An item's id may be null or repeat. Other columns are not read.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.shared import chunks, text_of
from daytally.llm.words import IS_MARK, Words, mix

WIDTH = 5
PERCENT = 80
BLOCKS = 8
RADIUS = 31
# A portion of the items: about 10 MB.
PORTION_WORDS = 500_000
PORTION_ITEMS = 20_000
# Windows handled at once.
_SLAB = 4096
# Meetings of windows with rare shingles handled at once, unless one window alone has more.
_MET = 1 << 20
_SALTS = (np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0x2545F4914F6CDD1D))


def _flips(most: int) -> np.ndarray:
    return np.array([sum(1 << b for b in bits) for n in range(most + 1) for bits in combinations(range(16), n)], np.uint32)


_INDEXED, _ASKED = _flips(1), _flips(2)


def runs(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words, wherever it begins."""
    n = len(words) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(width):
        out = mix(out + words[k:k + len(out)] * np.uint64(2 * k + 1))
    return out


def shingles(words: np.ndarray) -> np.ndarray:
    return runs(words, min(WIDTH, len(words))) if len(words) else words


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted, non-empty ``known``."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def fingerprints(words: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Blocks of the SimHash of each window: a bit is set if it is in most of the window's words."""
    bits = np.unpackbits(np.stack([mix(words ^ salt) for salt in _SALTS], 1).view(np.uint8), axis=1)
    ones = np.zeros((len(words) + 1, bits.shape[1]), np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=ones[1:])
    most = 2 * (ones[start + length] - ones[start]) > length[:, None]
    return np.packbits(most, axis=1).view(np.uint16)


def similar(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Overlap and union of two bags of shingles."""
    every, first = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = np.bincount(first[:len(a)], minlength=len(every)), np.bincount(first[len(a):], minlength=len(every))
    return int(np.minimum(x, y).sum()), int(np.maximum(x, y).sum())


class Index:
    """Items of a portion: their words, their shingles, and their fingerprints by block."""

    def __init__(self, items: list[tuple], percent: int):
        self.percent = percent
        self.ids = [i for i, _ in items]
        self.words = [np.frombuffer(w, np.uint64) for _, w in items]
        size = np.array([len(w) for w in self.words])
        self.sizes = [int(n) for n in np.unique(size) if n]
        # Shingles of the items of each size, and of all sizes with the same width of shingle.
        self.own = {n: np.unique(np.concatenate([shingles(w) for w in self.words if len(w) == n])) for n in self.sizes}
        self.known = {width: np.unique(np.concatenate([v for n, v in self.own.items() if min(WIDTH, n) == width]))
                      for width in {min(WIDTH, n) for n in self.sizes}}
        self.rare = {n: self._rarest(n) for n in self.sizes}
        self.prints = np.stack([fingerprints(w, np.zeros(1, int), np.array([len(w)]))[0] for w in self.words])
        self.tables = []
        for block in range(BLOCKS):
            key = (size[:, None] << 16 | (self.prints[:, block].astype(np.uint32)[:, None] ^ _INDEXED)).reshape(-1)
            order = np.argsort(key, kind="stable")
            self.tables.append((key[order], order // len(_INDEXED)))

    def need(self, size: int) -> int:
        """Shingles that a window and an item of ``size`` words must have in common."""
        return -(-self.percent * (size - min(WIDTH, size) + 1) // 100)

    def _rarest(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Shingles of the items of ``size`` words, sorted, and their items: of each item one more than may be lacking."""
        items = [k for k, w in enumerate(self.words) if len(w) == size]
        each = [np.unique(shingles(self.words[k]), return_counts=True) for k in items]
        every, often = np.unique(np.concatenate([value for value, _ in each]), return_counts=True)
        keys, of = [], []
        for k, (value, times) in zip(items, each):
            order = np.argsort(often[np.searchsorted(every, value)], kind="stable")
            slack = size - min(WIDTH, size) + 1 - self.need(size)
            # A shingle that repeats may be lacking as often.
            count = int(np.searchsorted(np.cumsum(times[order]), slack + 1)) + 1
            keys.append(value[order[:count]])
            of.append(np.full(len(keys[-1]), k, np.int32))
        keys, of = np.concatenate(keys), np.concatenate(of)
        order = np.argsort(keys, kind="stable")
        return keys[order], of[order]

    def direct(self, size: int, words: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Numbers of windows and items that share one of the item's rarest shingles, as one number each."""
        width = min(WIDTH, size)
        (keys, item), value = self.rare[size], runs(words, width)
        low = np.searchsorted(keys, value)
        many = np.searchsorted(keys, value, side="right") - low
        total = np.concatenate([[0], np.cumsum(many)])
        met = item[np.repeat(low - total[:-1], many) + np.arange(total[-1])]
        first, count = total[start], total[start + length - width + 1] - total[start]
        out, done = [np.zeros(0, np.int64)], np.concatenate([[0], np.cumsum(count)])
        a = 0
        while a < len(start):
            b = max(a + 1, int(np.searchsorted(done, done[a] + _MET, side="right")) - 1)
            at = np.repeat(first[a:b] - done[a:b], count[a:b]) + np.arange(done[a], done[b])
            out.append(np.unique(np.repeat(np.arange(a, b), count[a:b]) * len(self.ids) + met[at]))
            a = b
        return np.concatenate(out)

    def lookup(self, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and items of ``size`` words at most ``RADIUS`` bits apart."""
        met = []
        for block, (keys, item) in enumerate(self.tables):
            asked = (size << 16 | (prints[:, block].astype(np.uint32)[:, None] ^ _ASKED)).reshape(-1)
            low, high = np.searchsorted(keys, asked), np.searchsorted(keys, asked, side="right")
            many = high - low
            at = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            met.append(np.repeat(np.arange(len(asked)) // len(_ASKED), many) * len(self.ids) + item[at])
        pair = np.unique(np.concatenate(met))
        window, item = pair // len(self.ids), pair % len(self.ids)
        far = np.unpackbits((prints[window] ^ self.prints[item]).view(np.uint8), axis=1).sum(1)
        return window[far <= RADIUS], item[far <= RADIUS]

    def windows(self, words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Size, starts and lengths of the windows whose shingles occur often enough in the items of that size."""
        known = {}
        for width, values in self.known.items():
            found = runs(words.hash, width)
            mask = np.zeros(1 << 16, bool)
            mask[values >> np.uint64(48)] = True
            hit = np.flatnonzero(mask[found >> np.uint64(48)])
            hit = hit[among(found[hit], values)]
            # A run must not leave its document.
            hit = hit[hit + width <= words.first[words.row[hit] + 1]]
            known[width] = hit, found[hit]
        for size in self.sizes:
            width = min(WIDTH, size)
            hit, value = known[width]
            hit = hit[among(value, self.own[size])]
            if not len(hit):
                continue
            need = self.need(size)
            slack = size - width + 1 - need
            # Such a window has a known shingle among its first ones.
            low, high = words.first[words.row[hit]], words.first[words.row[hit] + 1]
            start = np.maximum(np.minimum(hit[:, None] - np.arange(slack + 1), (high - size)[:, None]), low[:, None])
            start = np.unique(start)
            length = np.minimum(size, words.first[words.row[start] + 1] - start)
            many = np.searchsorted(hit, start + np.maximum(length - width + 1, 0)) - np.searchsorted(hit, start)
            good = (length >= width) & (many >= need)
            if good.any():
                yield size, start[good], length[good]

    def find(self, words: Words) -> list[tuple]:
        """Row, item, overlap, union, first word and number of words of the best window of each row and item."""
        best = {}
        for size, start, length in self.windows(words):
            for low in range(0, len(start), _SLAB):
                s, n = start[low:low + _SLAB], length[low:low + _SLAB]
                for part in np.unique(s // _SLAB):
                    use = s // _SLAB == part
                    base = int(s[use].min())
                    span = words.hash[base:int((s[use] + n[use]).max())]
                    window, item = self.lookup(size, fingerprints(span, s[use] - base, n[use]))
                    pair = np.union1d(window * len(self.ids) + item, self.direct(size, span, s[use] - base, n[use]))
                    for w, i in zip((pair // len(self.ids)).tolist(), (pair % len(self.ids)).tolist()):
                        a, b = int(s[use][w]), int(n[use][w])
                        over, union = similar(shingles(words.hash[a:a + b]), shingles(self.words[i]))
                        if 100 * over >= self.percent * union:
                            key = int(words.row[a]), i
                            old = best.get(key)
                            if old is None or (over * old[1], -a) > (old[0] * union, -old[2]):
                                best[key] = over, union, a, b
        return [(row, item, *what) for (row, item), what in sorted(best.items())]


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        words = Words(batch.column("text"), IS_MARK)
        each = [words.hash[a:b].tobytes() for a, b in zip(words.first[:-1], words.first[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(each, pa.binary())], ["id", "words"])


def _scan(sent, percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(sent.value, percent)
        for batch in chunks(batches):
            words = Words(batch.column("text"), IS_MARK)
            found = index.find(words)
            if found:
                row, item, over, union, start, length = zip(*found)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(pa.array(row)), pa.array([index.ids[i] for i in item], pa.int64()),
                    pa.array(np.array(over) / np.array(union)),
                    pa.array(np.array(start) - words.first[np.array(row)], pa.int64()), pa.array(length, pa.int64()),
                ], ["doc_id", "item_id", "similarity", "start_word", "n_words"])

    return work


def leaks(docs: DataFrame, items: DataFrame, percent: int = PERCENT, id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """``doc_id, item_id, similarity, start_word, n_words`` of the passages of ``items (item_id, text)`` in ``docs``."""
    if percent < PERCENT:
        raise ValueError("the radius covers similarities of 80 percent and more")
    texts = items.select(F.col("item_id").cast("long").alias("id"), text_of().alias("text"))
    words = texts.mapInArrow(_item_words, "id long, words binary").filter(F.octet_length("words") > 0)
    size = words.agg(F.count("*").alias("n"), F.sum(F.octet_length("words")).alias("b")).first()
    portions = max(1, -(-size.n // PORTION_ITEMS), -(-(size.b or 0) // (8 * PORTION_WORDS)))
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text_of(text_column).alias("text"))
    schema = "doc_id long, item_id long, similarity double, start_word long, n_words long"
    found = None
    for portion in range(portions):
        part = words.filter(F.pmod(F.xxhash64("words"), F.lit(portions)) == portion)
        part = sorted(((r.id, bytes(r.words)) for r in part.collect()), key=lambda x: (x[0] is not None, x))
        if part:
            sent = docs.sparkSession.sparkContext.broadcast(part)
            hits = rows.mapInArrow(_scan(sent, percent), schema)
            found = hits if found is None else found.unionByName(hits)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found
