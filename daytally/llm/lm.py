"""Language-model scores of texts by a bigram model in Elias-Fano tries.

Each text is its lower-cased words and one end. The probability of a token t after c is
(n(c, t) + m P(t)) / (n(c) + m), where P(t) = (n(t) + 0.5) / (N + 0.5 (V + 1)) and m is the same for every context.
These sum to one over the vocabulary and one unknown word.

The model grows with the corpus, so it is never sent around. Every token of every document goes once to the shard of its
word, with its context, packed together with the other tokens of some megabytes of text that go there; there
the counts of the training documents become a trie, and the tokens of all documents are looked up in it. What comes
back is one number per document and shard. The numerator needs n(c, t) and n(t), the denominator of a token's successor needs n(t) alone,
so each token's part of the score is known in its own shard and a document's score is a sum. A frequent word would
make its shard too large: its tokens are spread over all shards by their context, and its count is sent around; the
frequent words are bounded in number, because each holds a stated share of all tokens. Which words are frequent decides
only where tokens go, not what they score. A pair of words that is common in a pack is sent to its shard once, with the
number of its training tokens, and looked up once; how often each document holds it goes with the pack to any shard and on
to where the pack's sums are added up. So no shard gets more of one pair than a bounded number of tokens a pack.

A trie has two levels, both Elias-Fano coded, in a memory-mapped file for as long as the shard is worked on: the words,
and under each word its contexts, whose high bits are the pointers from word to contexts. Counts of words are
a monotone sequence of their sums; numerators are quantised logarithms. A query finds its word as a successor in the
first level, and its context as a successor within the range that the pointers give.

Rows and edge cases: one row comes out per row that goes in. Null text counts as empty; an empty text is one end. Rows
are scored each by itself, so ids may repeat. A null id counts as empty text for the fold,
and stays null. Without training documents every count is 0 and P(t) is the same for all. Words are told apart by 64-bit
hashes, contexts of one word by 32 bits. Other columns are not read.
"""

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.shared import chunks, group_starts, held_out, stored, task_count, text_of, whole_groups
from daytally.llm.words import Words, mix

FOLDS = 5
# Frequent words are at most this many.
FREQUENT = 1 << 16
# Weight of P(t), after every context.
RARE_WEIGHT = 50.0
# Tokens of a shard, tokens looked up at once, and bytes of text whose tokens are packed together.
SHARD_TOKENS = 3_000_000
SLICE = 1 << 19
PACK_BYTES = 8 << 20
# Of one pair, a pack sends single tokens only up to this share of a shard, over all packs.
PAIR_SHARE = 0.25
# Numbers from here on stand for a pack's common pairs, not for documents.
PAIR = 1 << 31
# Steps of a quantised logarithm in one decade, and the least one kept.
STEPS, FLOOR = 2048, -14.0
END, START = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_NO_ID = np.iinfo(np.int64).min


class EliasFano:
    """A sorted sequence of 64-bit numbers: low bytes as they are, high parts in unary, mapped from a file."""

    def __init__(self, values: np.ndarray, low_bytes: int, file):
        self.count, self.low_bytes = len(values), low_bytes
        low = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :low_bytes]
        high = values >> np.uint64(8 * low_bytes) if low_bytes < 8 else np.zeros(len(values), np.uint64)
        self.top = int(high[-1]) + 1 if len(values) else 0
        unary = np.zeros(self.top + len(values), np.uint8)
        unary[high.astype(np.int64) + np.arange(len(values))] = 1
        self._low = self._mapped(file, np.ascontiguousarray(low))
        self._unary = self._mapped(file, np.packbits(unary))

    @staticmethod
    def _mapped(file, array: np.ndarray) -> np.ndarray:
        if not array.size:
            return array
        at = file.seek(0, 2)
        file.write(array.tobytes())
        file.flush()
        return np.memmap(file, array.dtype, "r", at, array.shape)

    def ranges(self) -> np.ndarray:
        """Where the numbers with each high part begin: the place of every zero less the zeros before it."""
        zeros = np.flatnonzero(np.unpackbits(self._unary, count=self.top + self.count) == 0)
        return np.concatenate([[0], zeros - np.arange(len(zeros))])

    def low(self, index: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(index), 8), np.uint8)
        wide[:, :self.low_bytes] = self._low[index]
        return wide.view("<u8")[:, 0]

    def values(self) -> np.ndarray:
        high = np.repeat(np.arange(self.top, dtype=np.uint64), np.diff(self.ranges()))
        return high << np.uint64(8 * self.low_bytes) | self.low(np.arange(self.count))

    def find(self, high: np.ndarray, low: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Place of each number, -1 if it isn't there: the successor of ``low`` in the range of ``high``.

        ``first`` is what :meth:`ranges` returns.
        """
        inside = high < self.top
        part = np.where(inside, high, 0).astype(np.int64)
        a, end = (np.where(inside, first[part + k], 0) for k in (0, 1)) if self.top else (np.zeros(len(high), np.int64),) * 2
        b, open_ = end.copy(), np.flatnonzero(a < end)
        while len(open_):
            middle = (a[open_] + b[open_]) // 2
            less = self.low(middle) < low[open_]
            a[open_[less]], b[open_[~less]] = middle[less] + 1, middle[~less]
            open_ = open_[a[open_] < b[open_]]
        place = np.full(len(high), -1)
        there = np.flatnonzero(a < end)
        same = there[self.low(a[there]) == low[there]]
        place[same] = a[same]
        return place


def low_bytes_for(count: int, bits: int) -> int:
    """Whole bytes of low bits for ``count`` numbers of ``bits`` bits."""
    return min(7, max(0, -(-(bits - max(count, 1).bit_length()) // 8)))


@dataclass
class Totals:
    """What every shard needs to know: N, V, training documents, and the frequent words with their counts."""

    tokens: int
    distinct: int
    docs: int
    frequent: np.ndarray
    counts: np.ndarray

    @property
    def scale(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)

    def count_of(self, word: np.ndarray) -> np.ndarray:
        """Counts of frequent words; -1 for all others."""
        if not len(self.frequent):
            return np.full(len(word), -1)
        at = np.minimum(np.searchsorted(self.frequent, word), len(self.frequent) - 1)
        return np.where(self.frequent[at] == word, self.counts[at], -1)


def grade(count: np.ndarray) -> np.ndarray:
    """The class of a context's weight: one for all, whether or not its count was sent around."""
    return np.zeros(len(count), np.uint8)


def weight_of(grade: np.ndarray) -> np.ndarray:
    return np.full(len(grade), RARE_WEIGHT)


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, the end of each text included, their row, and where each row begins."""
    w = Words(column)
    row = np.arange(w.rows)
    token = np.empty(len(w.hash) + w.rows, np.uint64)
    token[np.arange(len(w.hash)) + w.row] = w.hash
    token[w.first[1:] + row] = END
    return token, np.repeat(row, np.diff(w.first) + 1), w.first[:-1] + row


def _counted(parts: int):
    """Counts of the training tokens of a task, packed by part of the hash range."""
    def packets(tokens: list[np.ndarray]) -> pa.RecordBatch:
        word, count = np.unique(np.concatenate(tokens), return_counts=True)
        part = (mix(word) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        cut = np.searchsorted(part[order], np.arange(parts + 1))
        word, count = word[order], count[order].astype(np.uint32)
        each = [(p, word[a:b].tobytes(), count[a:b].tobytes()) for p, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*each), (pa.int32(), pa.binary(), pa.binary()))], ["part", "word", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in chunks(batches):
            token, row, _ = tokens_of(batch.column("text"))
            taught = ~batch.column("held_out").to_numpy(zero_copy_only=False)
            held.append(token[taught[row]])
            size += len(held[-1])
            if size >= SHARD_TOKENS:
                yield packets(held)
                held, size = [], 0
        if size:
            yield packets(held)

    return work


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """All bytes of a binary column, read as numbers."""
    parts = [np.zeros(0, dtype)]
    for chunk in column.chunks:
        ends = np.frombuffer(chunk.buffers()[1], np.int32, len(chunk) + 1, 4 * chunk.offset)
        if ends[-1] > ends[0]:
            parts.append(np.frombuffer(chunk.buffers()[2], dtype, (ends[-1] - ends[0]) // np.dtype(dtype).itemsize, ends[0]))
    return np.concatenate(parts)


def _summed():
    """Of each part: the number of tokens and of words (with word null), and the words that may be frequent."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["part"]):
            starts = group_starts(table, ["part"])
            for a, b in zip(starts, np.append(starts[1:], table.num_rows)):
                group = table.slice(a, b - a)
                word, place = np.unique(_joined(group.column("word"), np.uint64), return_inverse=True)
                count = np.bincount(place, _joined(group.column("n"), np.uint32)).astype(np.int64)
                # A share of all tokens is no less a share of the part. The end counts documents.
                often = (count * FREQUENT >= count.sum()) | (word == END)
                word, total = word[often].view(np.int64), len(word)
                yield pa.RecordBatch.from_arrays([
                    pa.array([None, *word.tolist()], pa.int64()), pa.array([int(count.sum()), *count[often].tolist()]),
                    pa.array([total] + [0] * len(word), pa.int64())], ["word", "n", "distinct"])

    return work


def totals(rows: DataFrame) -> Totals:
    """Counts over the training documents among ``rows (held_out, text)``."""
    parts = min(task_count(rows.sparkSession), FREQUENT)
    packed = rows.mapInArrow(_counted(parts), "part int, word binary, n binary")
    placed = packed.repartitionById(parts, F.col("part")).sortWithinPartitions("part")
    found = stored(placed.mapInArrow(_summed(), "word long, n long, distinct long"))
    none = F.col("word").isNull()
    whole = found.filter(none).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("d")).first()
    # The share is one of all tokens, so it doesn't depend on how words were dealt to parts.
    often = found.filter(~none & ((F.col("n") >= F.lit(-(-whole.n // FREQUENT))) | (F.col("word") == int(END))))
    words = sorted((r.word % 2**64, r.n) for r in often.collect())
    return Totals(
        whole.n, whole.d,
        next((n for word, n in words if word == int(END)), 0),
        np.array([w for w, _ in words], np.uint64), np.array([n for _, n in words], np.int64))


# What a packet holds: words with how often each occurs; for each token its context, whether it is taught, and its
# document; for each common pair, which counts as a token of a document of its own, its training tokens. One packet of
# a pack also holds the id, fold and number of tokens of all its documents, and the pairs' tokens in each.
_PACKET = {
    "words": np.uint64, "times": np.uint32, "contexts": np.uint32, "taught": np.uint8, "docs": np.uint32,
    "lessons": np.uint32, "ids": np.int64, "held": np.bool_, "tokens": np.uint32,
    "pair": np.uint32, "pair_docs": np.uint32, "pair_times": np.uint32,
}
# What a shard answers: for each document of the packet its parts of the sums; the rest as it came.
_ANSWER = {"docs": np.uint32, "score": np.float32, "base": np.float64, "known": np.uint32}
_PASSED = ("ids", "held", "tokens", "pair", "pair_docs", "pair_times")


def _common(pair: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """For each token, the number of its pair if more than ``limit`` tokens have it, else -1; a token of each such pair."""
    number = np.full(len(pair), -1)
    bucket = (pair >> np.uint64(48)).astype(np.int64)
    near = np.flatnonzero((np.bincount(bucket, minlength=1 << 16) > limit)[bucket])
    _, one, back, times = np.unique(pair[near], return_index=True, return_inverse=True, return_counts=True)
    often = times > limit
    number[near] = np.where(often, np.cumsum(often) - 1, -1)[back]
    return number, near[one[often]]


def _packed(sent, shards: int):
    """All tokens, packed by shard."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task = sent.value, TaskContext.get().partitionId()
        for number, batch in enumerate(chunks(batches, limit=PACK_BYTES)):
            token, row, first = tokens_of(batch.column("text"))
            often = known.count_of(token)
            before = np.concatenate([[START], token[:-1]])
            before[first] = START
            pair = mix(token ^ mix(before))
            shard = np.where(often > 0, pair, mix(token)) % np.uint64(shards)
            ids = batch.column("id").fill_null(_NO_ID).to_numpy()
            held = batch.column("held_out").to_numpy(zero_copy_only=False)
            size = np.diff(np.append(first, len(token)))
            # A pack is known by its task, its number and its content.
            mark = int(np.bitwise_xor.reduce(mix(token + mix(ids[row].view(np.uint64) + row.astype(np.uint64))))) >> 1
            # Common pairs: their training tokens, and their tokens in each document.
            which, one = _common(pair, int(max(1, PAIR_SHARE * SHARD_TOKENS * len(token) / max(known.tokens, 1))))
            common, single = np.flatnonzero(which >= 0), np.flatnonzero(which < 0)
            lessons = np.bincount(which[common][~held[row[common]]], minlength=len(one))
            each, times_each = np.unique(which[common] << 32 | row[common], return_counts=True)
            passed = (ids, held, size, each >> 32, each & 0xFFFFFFFF, times_each)
            # What is sent: single tokens, then one of each common pair.
            of = np.concatenate([single, one])
            token, before, shard, doc = token[of], before[of], shard[of], np.concatenate([row[single], PAIR + np.arange(len(one))])
            taught = np.concatenate([~held[row[single]], lessons > 0])
            order = np.lexsort((token, shard))
            cut = np.searchsorted(shard[order], np.arange(shards + 1, dtype=np.uint64))
            out = {name: [] for name in ("shard", *_PACKET)}
            some = np.flatnonzero(np.diff(cut))
            # What passes through goes with any packet.
            carrier = some[mark % len(some)]
            for s in some.tolist():
                own = order[cut[s]:cut[s + 1]]
                word, times = np.unique(token[own], return_counts=True)
                values = (word, times, before[own] >> np.uint64(32), np.packbits(taught[own]), doc[own],
                          lessons[own[own >= len(single)] - len(single)],
                          *(passed if s == carrier else (v[:0] for v in passed)))
                out["shard"].append(s)
                for (name, kind), value in zip(_PACKET.items(), values):
                    out[name].append(value.astype(kind).tobytes())
            count = len(out["shard"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(count, task << 32 | number)), pa.array(np.full(count, mark)), pa.array(out["shard"], pa.int32()),
                 *(pa.array(out[n], pa.binary()) for n in _PACKET)], ["pack", "mark", "shard", *_PACKET])

    return work


class Trie:
    """The training tokens of one shard: word (a hash), context (32 bits of one) and grade of the context."""

    def __init__(self, word: np.ndarray, times: np.ndarray, context: np.ndarray, grades: np.ndarray, known: Totals, file,
                 lessons: np.ndarray | None = None):
        # ``word`` and ``times``: words of the shard and their tokens, which follow in the same order. Each token
        # stands for as many as ``lessons`` says, or for one.
        unique, rank = np.unique(word, return_inverse=True)
        lessons = np.ones(len(context), np.uint32) if lessons is None else lessons
        own = np.bincount(np.repeat(rank, times), lessons, len(unique)).astype(np.int64)
        key = np.repeat(rank.astype(np.uint64) << np.uint64(32), times)
        key |= context
        order = np.argsort(key).astype(np.int32)
        key, graded, lessons = key[order], grades[order], lessons[order]
        del order
        begin = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
        pairs = np.add.reduceat(lessons, begin, dtype=np.int64) if len(begin) else begin
        key, graded = key[begin], graded[begin]
        sent = known.count_of(unique)
        count = np.where(sent > 0, sent, own)
        chance = (count + 0.5) / known.scale
        at = (key >> np.uint64(32)).astype(np.int64)
        value = np.log10(pairs + weight_of(graded) * chance[at])
        self.low = low_bytes_for(len(unique), 64)
        self.words = EliasFano(unique, self.low, file)
        self.contexts = EliasFano(key, 4, file)
        self.sums = EliasFano(np.cumsum(count).astype(np.uint64), low_bytes_for(len(unique), int(count.sum()).bit_length()), file)
        quantised = np.rint((np.maximum(value, FLOOR) - FLOOR) * STEPS).astype(np.uint16)
        self.numerator = EliasFano._mapped(file, quantised)

    def word_place(self, word: np.ndarray) -> np.ndarray:
        shift = np.uint64(8 * self.low)
        return self.words.find(word >> shift, word & ((np.uint64(1) << shift) - np.uint64(1)), self.words.ranges())

    def counts(self) -> np.ndarray:
        return np.diff(np.concatenate([[0], self.sums.values().astype(np.int64)]))

    def numerators(self, place: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Quantised logarithm for a word's place and a context; NaN if they don't occur together."""
        out, first = np.full(len(place), np.nan), self.contexts.ranges()
        for a in range(0, len(place), SLICE):
            known = a + np.flatnonzero(place[a:a + SLICE] >= 0)
            found = self.contexts.find(place[known].astype(np.uint64), context[known].astype(np.uint64), first)
            there = found >= 0
            out[known[there]] = self.numerator[found[there]] / STEPS + FLOOR
        return out


def _lengths(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.array([len(x.as_py()) for x in column]) // np.dtype(dtype).itemsize


def _score_shard(group: pa.Table, known: Totals) -> pa.RecordBatch:
    word, times, context, doc = (_joined(group.column(n), _PACKET[n]) for n in ("words", "times", "contexts", "docs"))
    size = _lengths(group.column("docs"), np.uint32)
    taught = np.concatenate([
        np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=n) for x, n in zip(group.column("taught"), size)]).astype(bool)
    of = np.repeat(np.arange(len(word), dtype=np.int32), times)
    lessons = np.bincount(of[taught], minlength=len(word))
    weight = np.ones(len(doc), np.uint32)
    weight[doc >= PAIR] = _joined(group.column("lessons"), np.uint32)
    with tempfile.TemporaryFile() as file:
        used = lessons > 0
        trie = Trie(word[used], lessons[used], context[taught], grade(context[taught]), known, file, weight[taught])
        unique, back = np.unique(word, return_inverse=True)
        place, back = trie.word_place(unique).astype(np.int32), back.astype(np.int32)
        sent, own = known.count_of(unique), trie.counts()
        count = np.where(sent > 0, sent, np.where(place >= 0, own[place] if len(own) else 0, 0))
        of = back[of]
        numerator = trie.numerators(place[of], context)
    # What a word adds wherever it stands.
    half = np.log10(count + 0.5)
    after = np.log10(count + RARE_WEIGHT)
    after[unique == END] = 0
    unseen = half + float(np.log10(RARE_WEIGHT) - np.log10(known.scale))
    numerator = np.where(np.isnan(numerator), unseen[of], numerator)
    numerator -= after[of]
    out = {name: [] for name in _ANSWER}
    for z, n in zip(np.cumsum(size), size):
        part = slice(z - n, z)
        docs, at = np.unique(doc[part], return_inverse=True)
        values = (docs, np.bincount(at, numerator[part]), np.bincount(at, half[of[part]]), np.bincount(at, count[of[part]] > 0))
        for (name, kind), value in zip(_ANSWER.items(), values):
            out[name].append(value.astype(kind).tobytes())
    columns = {n: group.column(n) for n in ("pack", "mark", *_PASSED)} | {n: pa.array(v, pa.binary()) for n, v in out.items()}
    return pa.table(columns).combine_chunks().to_batches()[0]


def _scored(sent):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["shard"]):
            starts = group_starts(table, ["shard"])
            for a, b in zip(starts, np.append(starts[1:], table.num_rows)):
                yield _score_shard(table.slice(a, b - a), sent.value)

    return work


def _summed_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each pack, with the sums over all shards."""
    for table in whole_groups(batches, ["pack", "mark"]):
        starts = group_starts(table, ["pack", "mark"])
        for a, b in zip(starts, np.append(starts[1:], table.num_rows)):
            group = table.slice(a, b - a)
            docs, score, base, known = (_joined(group.column(n), t) for n, t in _ANSWER.items())
            ids, held, tokens, pair, pair_docs, pair_times = (_joined(group.column(n), _PACKET[n]) for n in _PASSED)
            single = docs < PAIR
            place = np.zeros(len(docs) - np.count_nonzero(single), np.int64)
            place[docs[~single] - PAIR] = np.flatnonzero(~single)
            # What a common pair adds counts for each of its tokens.
            sums = [np.bincount(docs[single], v[single], len(ids)) + np.bincount(pair_docs, v[place[pair]] * pair_times, len(ids))
                    for v in (known.astype(np.int64), base, score.astype(np.float64))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(held), pa.array(tokens.astype(np.int64)),
                 pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])],
                ["id", "held_out", "tokens", "known", "base", "score"])


def scores(docs: DataFrame, folds: int = FOLDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``docs``.

    Documents whose fold is 1 are held out; the model is learned from all others.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"), held_out(F.col(id_column), folds).alias("held_out"),
        text_of(text_column).alias("text"))
    known = totals(rows)
    sent = spark.sparkContext.broadcast(known)
    shards = max(1, -(-known.tokens // SHARD_TOKENS))
    binary = ", ".join(f"{n} binary" for n in _PACKET)
    packed = rows.mapInArrow(_packed(sent, shards), f"pack long, mark long, shard int, {binary}")
    parts = min(shards, task_count(spark))
    placed = packed.repartitionById(parts, F.col("shard") % parts).sortWithinPartitions("shard")
    binary = ", ".join(f"{n} binary" for n in (*_PASSED, *_ANSWER))
    answered = placed.mapInArrow(_scored(sent), f"pack long, mark long, {binary}")
    gathered = answered.repartition(task_count(spark), "pack", "mark").sortWithinPartitions("pack", "mark")
    each = gathered.mapInArrow(
        _summed_up, "id long, held_out boolean, tokens long, known long, base double, score double")
    start = float(np.log10(known.docs + RARE_WEIGHT))
    return each.select(
        F.when(F.col("id") != int(_NO_ID), F.col("id")).alias("doc_id"), "held_out",
        F.col("tokens").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("tokens") * float(np.log10(known.scale))).alias("base_score"),
        (F.col("score") - start).alias("score"))
