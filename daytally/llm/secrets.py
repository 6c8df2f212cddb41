"""Secrets in texts: fixed patterns, and strings that look drawn at random.

Two character Markov models, one of random strings and one of ordinary identifiers, are trained from labelled
samples. Random: what the fixed patterns find in the corpus, and strings drawn with a fixed seed from the usual
alphabets. Ordinary: every other run of identifier characters of all documents, and identifiers put together of
common words. A candidate is a long run of such
characters; it is a secret if the log-likelihood ratio of the models is high enough, as a whole and per character. Of a
run that isn't, its parts are candidates: the pieces between separators, and the segments whose characters exceed the
ratio asked for by most.
The models are counts of neighbouring characters, so their size is fixed whatever the corpus.

Rows and edge cases: one row comes out per row that goes in. Null text counts as empty and has no spans. Rows are
independent of each other but for the models, so ids may be null or repeat. What a pattern's span covers is left to the
pattern, and cut out of a run. Numbers are no secrets; letters alone must be more certain. Equal starts are told apart by kind, in the order assign, access, hex, random. Without
documents the models know the drawn strings only. Other columns are not read.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.shared import chunks, text_bytes, text_of
from daytally.llm.spans import byte_class, code_points, maximal_runs, row_of

KINDS = ("assign", "access", "hex", "random")
# The patterns asked for. Letters of the first group stand in either case.
_NAME = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word).replace("_", "_?")
                 for word in ("password", "passwd", "secret", "token", "api_key"))
_ASSIGN = re.compile(rf"""(?:{_NAME})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""".encode())
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32

_DIGITS, _LOW, _UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTERS = _LOW + _UP
_MEMBERS = _LETTERS + _DIGITS + "+/_-"
_IS_MEMBER, _IS_HEX, _IS_ACCESS = byte_class(_MEMBERS), byte_class(_DIGITS + "abcdef"), byte_class(_UP + _DIGITS)
_IS_DIGIT, _IS_LETTER = byte_class(_DIGITS), byte_class(_LETTERS)
# The symbol of each byte; the last one stands for either end of a string.
SYMBOLS = len(_MEMBERS) + 1
_END = SYMBOLS - 1
_SYMBOL = np.full(256, _END, np.int64)
_SYMBOL[np.frombuffer(_MEMBERS.encode(), np.uint8)] = np.arange(_END)

CANDIDATE_LEAST = 16
# Least log-likelihood ratio of a secret, in nats: as a whole, and for each character.
LEAST_TOTAL, LEAST_EACH = 15.0, 0.7
# The same for each character of a string of letters alone.
LETTERS_EACH = 1.0
# Separators between the pieces of a run, from few to all.
_SEPARATORS = tuple(byte_class(x) for x in ("/", "/_", "/_+-"))
# Labelled strings drawn for each alphabet, and for each way to write an identifier.
DRAWN = 500
# Words of which ordinary identifiers are put together.
_WORDS = """
    account action address agent array batch body buffer build cache client cluster code column command config connection
    container content context count create current data database date default delete device document download driver
    element email engine entry error event example exception execute factory field file filter format frame function
    global group handler header host image index info input instance internal item iterator layer length library license
    list local lock manager max memory message method model module name network node number object offset option order
    output package page param parser path payload plugin point process project provider python query queue record region
    register report request response result retry return row schema script search section select sequence server service
    session setting shard site size source start state status storage stream string system table target task template
    test text thread time total transaction type update upload user util value vector version view window worker write
""".split()
# Alphabets in which random strings are written.
_ALPHABETS = (_DIGITS + "abcdef", _DIGITS + _LOW, _UP + "234567", _LETTERS + _DIGITS, _LETTERS + _DIGITS + "+/",
              _LETTERS + _DIGITS + "_-")


class Batch:
    """The bytes of some texts, with the pattern spans and the candidates, as byte places and kinds."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = text_bytes(column)
        self.spans = [(*s, 0) for s in self._assigned()] + [(*s, 1) for s in self._access()]
        self.spans += [(a, b, 2) for a, b in zip(*maximal_runs(_IS_HEX[self.data], self.offsets, HEX_LEAST))]
        self.covered = np.zeros(len(self.data) + 1, bool)
        for a, b, _ in self.spans:
            self.covered[a:b] = True

    def _assigned(self) -> Iterator[tuple[int, int]]:
        signs = np.flatnonzero((self.data == ord("=")) | (self.data == ord(":")))
        for row in np.unique(row_of(signs, self.offsets)):
            low = self.offsets[row]
            for m in _ASSIGN.finditer(self.data[low:self.offsets[row + 1]].tobytes()):
                if m.end(1) - m.start(1) >= ASSIGN_LEAST:
                    yield int(low) + m.start(), int(low) + m.end()

    def _access(self) -> Iterator[tuple[int, int]]:
        for a, b in zip(*maximal_runs(_IS_ACCESS[self.data], self.offsets, ACCESS_LEAST)):
            at = self.data[a:b].tobytes().find(b"AKIA")
            if at >= 0 and b - a - at >= ACCESS_LEAST:
                yield int(a) + at, int(b)

    def pairs(self, cut: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs of identifier characters (start, end), neighbouring symbols, and where each run's pairs begin.

        With ``cut``, what pattern spans cover belongs to no run.
        """
        member = _IS_MEMBER[self.data]
        start, end = maximal_runs(member & ~self.covered[:-1] if cut else member, self.offsets)
        symbol = _SYMBOL[self.data]
        # Each run of n characters has n + 1 pairs, its ends included.
        first = np.cumsum(end - start + 1) - (end - start + 1)
        place = np.arange((end - start + 1).sum()) - np.repeat(first, end - start + 1) + np.repeat(start, end - start + 1)
        before = np.where(place == np.repeat(start, end - start + 1), _END, symbol[place - 1])
        after = np.where(place == np.repeat(end, end - start + 1), _END, symbol[np.minimum(place, len(symbol) - 1)])
        return start, end, before * SYMBOLS + after, first


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of neighbouring symbols in ordinary (0) and random (1) strings, once per task."""
    total = np.zeros((2, SYMBOLS * SYMBOLS), np.int64)
    for batch in chunks(batches):
        b = Batch(batch.column("text"))
        start, end, pair, first = b.pairs()
        if len(start):
            inside = np.concatenate([[0], np.cumsum(b.covered)])
            taken = inside[end] - inside[start]
            for label, runs in ((0, taken == 0), (1, (taken == end - start) & (end - start >= CANDIDATE_LEAST))):
                total[label] += np.bincount(pair[np.repeat(runs, end - start + 1)], minlength=total.shape[1])
    label, pair = np.nonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(label.astype(np.int32)), pa.array(pair.astype(np.int32)), pa.array(total[label, pair])],
        ["label", "pair", "n"])


def _pair_counts(strings: list[str]) -> np.ndarray:
    total = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    for text in strings:
        s = np.concatenate([[_END], _SYMBOL[np.frombuffer(text.encode(), np.uint8)], [_END]])
        np.add.at(total, s[:-1] * SYMBOLS + s[1:], 1)
    return total


def random_strings(seed: int = 3) -> list[str]:
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list(a), rng.integers(20, 65))) for a in _ALPHABETS for _ in range(DRAWN)]


def identifiers(seed: int = 4) -> list[str]:
    """Words in camel case, with underscores, hyphens or slashes, some with a number at the end."""
    rng, out = np.random.default_rng(seed), []
    for join, shape in (("", str.title), ("_", str.lower), ("_", str.upper), ("-", str.lower), ("/", str.lower), ("", str.lower)):
        for _ in range(DRAWN):
            words = [shape(w) for w in rng.choice(_WORDS, rng.integers(2, 6))]
            if shape is str.title and rng.random() < 0.5:
                words[0] = words[0].lower()
            if rng.random() < 0.4:
                words.append(str(rng.integers(0, 10 ** rng.integers(1, 5))))
            out.append(join.join(words))
    return out


def train(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """For each pair of symbols, by how much the random model's log probability exceeds the ordinary one's."""
    counted = docs.select(text_of(text_column).alias("text")).mapInArrow(_training, "label int, pair int, n long")
    # At most two counts for each pair of symbols.
    rows = counted.groupBy("label", "pair").agg(F.sum("n").alias("n")).collect()
    total = np.zeros((2, SYMBOLS * SYMBOLS))
    for r in rows:
        total[r.label, r.pair] = r.n
    # What the corpus holds counts no more than what is drawn.
    for label, own in enumerate((_pair_counts(identifiers()), _pair_counts(random_strings()))):
        total[label] = own + total[label] * min(1.0, own.sum() / max(total[label].sum(), 1))
    p = (total + 0.5).reshape(2, SYMBOLS, SYMBOLS)
    p = np.log(p / p.sum(2, keepdims=True))
    return (p[1] - p[0]).reshape(-1)


def _likely(piece: np.ndarray, score: float) -> bool:
    """Whether a piece with a log-likelihood ratio is a secret."""
    # Numbers are no secrets, however they read.
    if len(piece) < CANDIDATE_LEAST or not _IS_LETTER[piece].any():
        return False
    each = LEAST_EACH if _IS_DIGIT[piece].any() else LETTERS_EACH
    return score >= max(LEAST_TOTAL, each * len(piece))


def _hopeful(value: np.ndarray, first: np.ndarray, size: np.ndarray, least: float) -> np.ndarray:
    """Which runs of values, from ``first`` on, have a segment whose sum is at least this."""
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    total = np.concatenate([[0.0], np.cumsum(value[place + np.repeat(first, size)])])
    begin = np.cumsum(size) - size
    # Each run from zero, and below all runs before it.
    before, after = total[:-1] - np.repeat(total[begin], size), total[1:] - np.repeat(total[begin], size)
    down = np.repeat(np.arange(len(size)) * (np.ptp(np.append(before, after)) + 1), size)
    rise = after - (np.minimum.accumulate(before - down) + down)
    return np.maximum.reduceat(rise, begin) >= least - 1e-3


def _segments(value: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, one past the last, sum), by Ruzzo and Tompa."""
    # Of each segment: its ends, and the sums before it and up to its end.
    kept: list[tuple[int, int, float, float]] = []
    # Of each segment, the last one before it that begins lower.
    lower: list[int] = []
    total = 0.0
    for k, v in enumerate(value):
        if v > 0:
            a, left = k, total
            j = len(kept) - 1
            while True:
                while j >= 0 and kept[j][2] >= left:
                    j = lower[j]
                if j < 0 or kept[j][3] >= total + v:
                    break
                a, left = kept[j][0], kept[j][2]
                del kept[j:], lower[j:]
                j = len(kept) - 1
            lower.append(j)
            kept.append((a, k + 1, left, total + v))
        total += v
    return [(a, b, right - left) for a, b, left, right in kept]


def _parts(data: np.ndarray, ratio: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of a run that are secrets: pieces between separators first, then segments, none over another."""
    symbol, taken = _SYMBOL[data], np.zeros(len(data), bool)
    for separators in _SEPARATORS:
        for a, z in zip(*maximal_runs(~separators[data], np.array([0, len(data)]), CANDIDATE_LEAST)):
            own = np.concatenate([[_END], symbol[a:z], [_END]])
            if not taken[a:z].any() and _likely(data[a:z], ratio[own[:-1] * SYMBOLS + own[1:]].sum()):
                taken[a:z] = True
                yield int(a), int(z)
    inner = ratio[symbol[:-1] * SYMBOLS + symbol[1:]]
    for a, z in zip(*maximal_runs(~taken, np.array([0, len(data)]), CANDIDATE_LEAST)):
        for b, y, over in _segments((inner[a:z - 1] - LEAST_EACH).tolist()):
            # A segment of so many pairs has one character more.
            low, high = int(a) + b, int(a) + y + 1
            if _likely(data[low:high], over + LEAST_EACH * (y - b)) and not taken[low:high].any():
                taken[low:high] = True
                yield low, high


def _scan(sent):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = sent.value
        nothing = hashlib.sha256(b"").hexdigest()
        square = ratio.reshape(SYMBOLS, SYMBOLS)
        ends = max(0.0, square[_END].max()) + max(0.0, square[:, _END].max())
        for batch in chunks(batches):
            b = Batch(batch.column("text"))
            spans = list(b.spans)
            start, end, pair, first = b.pairs(cut=True)
            long = np.flatnonzero(end - start >= CANDIDATE_LEAST)
            if len(long):
                value = ratio[pair]
                score = np.add.reduceat(value, first)
                # No part of a run can do better than its best segment and two ends.
                some = _hopeful(value, first[long] + 1, (end - start)[long] - 1, LEAST_TOTAL - ends)
                some |= score[long] >= LEAST_TOTAL
                for k in long[some].tolist():
                    a, z = int(start[k]), int(end[k])
                    if _likely(b.data[a:z], score[k]):
                        spans.append((a, z, 3))
                    else:
                        spans += [(a + c, a + d, 3) for c, d in _parts(b.data[a:z], ratio)]
            count = np.zeros((len(KINDS), batch.num_rows), np.int64)
            base, every = [nothing] * batch.num_rows, [""] * batch.num_rows
            by_row = {}
            for (a, z, kind), row in zip(spans, row_of(np.array([s[0] for s in spans], np.int64), b.offsets).tolist()):
                by_row.setdefault(row, []).append((a, kind, z))
            for row, found in by_row.items():
                low = b.offsets[row]
                place = code_points(b.data[low:b.offsets[row + 1]])
                named = []
                for a, kind, z in sorted(found):
                    count[kind, row] += 1
                    named.append((kind, f"{KINDS[kind]}:{place[a - low]}:{place[z - low]}"))
                base[row] = hashlib.sha256(",".join(n for k, n in named if k < 3).encode()).hexdigest()
                every[row] = ",".join(n for _, n in named)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *map(pa.array, count[:3]), pa.array(base), pa.array(every), pa.array(count[3])],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])

    return work


def secrets(docs: DataFrame, ratio: np.ndarray | None = None, id_column: str = "doc_id",
            text_column: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random`` for each row of ``docs``.

    ``spans`` names every span as kind:start:end, in code points, the end not included. ``ratio`` is what
    ``train`` returns; without it the models are trained on ``docs``.
    """
    ratio = train(docs, text_column) if ratio is None else ratio
    sent = docs.sparkSession.sparkContext.broadcast(ratio)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text_of(text_column).alias("text"))
    schema = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")
    return rows.mapInArrow(_scan(sent), schema)
