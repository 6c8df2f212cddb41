"""Quality classifier: supervised embeddings of subwords.

Words and runs of characters are hashed to vectors that are learned together with a softmax over the two classes;
a document is the average of its vectors. Training is stochastic gradient descent in numpy over a bounded sample
of labelled documents, reduced to hashed counts by the executors. Because the softmax is taken of a linear map of
the average, scoring needs one number per hash bucket, so a document costs one look-up per word and run.

Rows and edge cases: one row comes out per row that goes in. Null text counts as empty; an empty text has the
score of the learned bias alone. Labels of an id that is labelled more than once count by their smallest value;
null labels don't count. Of rows that repeat a labelled id, the text with the smallest hash is learned from; all are scored. Without labels, or with one class only, the score is the share of that class, 0.5 at none.
A null id is never a training row. Other columns are not read; labels, languages, sources and ids are no input
of a score.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.llm.shared import chunks, held_out, stored, text_bytes, text_of
from daytally.llm.words import IS_SPACE, mix

# The bounds of the training sample: documents with the smallest hashes of their ids, and bytes of their hashed
# counts, of which the documents that come first in that order are taken.
TRAIN_DOCS = 4000
TRAIN_BYTES = 256 << 20
BITS = 16
DIMENSIONS = 16
EPOCHS = 12
RATE = 0.5
# Lengths of the character runs, in bytes.
RUNS = (2, 3, 4)
_SALT = {n: np.uint64(n * 0x9E3779B97F4A7C15 % 2**64) for n in (1, *RUNS)}
# The feature of a word that repeats the word before it, whatever the word.
REPEAT = 0


@dataclass
class Model:
    """A number per bucket: what its vector adds to the log odds of class 1 when averaged; and the bias."""

    weight: np.ndarray
    bias: float


def buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every word, repeated word and character run of the texts."""
    data, offsets = text_bytes(column)
    n = len(data)
    row = np.repeat(np.arange(len(column), dtype=np.int32), np.diff(offsets))
    code, out_bucket, out_row = data.astype(np.uint64), [], []
    whole = code.copy()
    shift = np.uint64(64 - BITS)
    for length in range(2, max(RUNS) + 1):
        whole = whole[:-1] | (code[length - 1:] << np.uint64(8 * (length - 1))) if n >= length else whole[:0]
        if length in RUNS and len(whole):
            inside = row[:len(whole)] == row[length - 1:]
            out_bucket.append(((mix(whole[inside] + _SALT[length])) >> shift).astype(np.int32))
            out_row.append(row[:len(whole)][inside])
    # Words as they are written, by the sum of their bytes each turned by its place.
    gap = IS_SPACE[data]
    begins = ~gap
    first = np.zeros(n, bool)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    begins[1:] &= gap[:-1] | first[1:]
    start = np.flatnonzero(begins)
    if len(start):
        place = np.arange(n) - np.repeat(np.append(0, start), np.diff(np.concatenate([[0], start, [n]])))
        value = mix(code + (place.astype(np.uint64) << np.uint64(8)))
        value[gap] = 0
        word = np.add.reduceat(value, start)
        again = np.flatnonzero((word[1:] == word[:-1]) & (row[start[1:]] == row[start[:-1]])) + 1
        out_bucket += [(mix(word + _SALT[1]) >> shift).astype(np.int32), np.full(len(again), REPEAT, np.int32)]
        out_row += [row[start], row[start[again]]]
    if not out_bucket:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(out_bucket), np.concatenate(out_row)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        bucket, row = buckets(batch.column("text"))
        key, count = np.unique(row.astype(np.int64) << BITS | bucket, return_counts=True)
        cut = np.searchsorted(key, np.arange(batch.num_rows + 1) << BITS)
        bucket = (key & ((1 << BITS) - 1)).astype(np.uint16)
        yield pa.RecordBatch.from_arrays([
            batch.column("label"), batch.column("place"),
            pa.array([bucket[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
            pa.array([count[a:b].astype(np.float32).tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
        ], ["label", "place", "bucket", "count"])


def _sample(docs: DataFrame, labels: DataFrame, target: str, train_docs: int, train_bytes: int) -> list:
    """Hashed counts of the bounded training sample."""
    known = labels.filter(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 3))
    known = known.groupBy("doc_id").agg(F.min(target).cast("int").alias("label"))
    known = known.withColumn("place", F.xxhash64("doc_id", F.lit(6))).orderBy("place", "doc_id").limit(train_docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    # The sample has train_docs rows at most, so it may be broadcast. An id that repeats is one document.
    chosen = texts.join(F.broadcast(known), "doc_id").groupBy("label", "place", "doc_id")
    chosen = chosen.agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("label", "place", "text")
    counted = stored(chosen.mapInArrow(_counts, "label int, place long, bucket binary, count binary"))
    # One small row for each of them, to see how many fit the bytes.
    size = counted.select("place", (F.octet_length("bucket") + F.octet_length("count")).alias("size"))
    total, last = 0, None
    for row in sorted(size.collect()):
        total += row["size"]
        if total > train_bytes and last is not None:
            break
        last = row["place"]
    return counted.filter(F.col("place") <= F.lit(last)).collect()


def fit(rows: list, epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """Stochastic gradient descent over ``(label, place, bucket, count)`` rows, in an order fixed by ``place``."""
    label = np.array([r["label"] for r in rows], float)
    if not len(label) or label.min() == label.max():
        share = np.clip(label.mean() if len(label) else 0.5, 1e-6, 1 - 1e-6)
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))))
    rows = sorted(rows, key=lambda r: (r["place"], r["bucket"]))
    label = np.array([r["label"] for r in rows])
    docs = []
    for r in rows:
        count = np.frombuffer(r["count"], np.float32)
        docs.append((np.frombuffer(r["bucket"], np.uint16), count / max(count.sum(), 1)))
    rng = np.random.default_rng(6)
    vectors = rng.uniform(-1, 1, (1 << BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    output, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    steps = epochs * len(docs)
    for epoch in range(epochs):
        for k, d in enumerate(rng.permutation(len(docs))):
            step = rate * (1 - (epoch * len(docs) + k) / steps)
            bucket, part = docs[d]
            hidden = part @ vectors[bucket]
            logit = hidden @ output + bias
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[label[d]] -= 1
            back = output @ p
            output -= step * np.outer(hidden, p)
            bias -= step * 0.1 * p
            # Each vector moves by its share of the document, at least as much as if twenty shared it.
            vectors[bucket] -= step * np.outer(np.minimum(part * 20, 1), back)
    edge = output[:, 1] - output[:, 0]
    return Model((vectors @ edge).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", train_docs: int = TRAIN_DOCS,
          train_bytes: int = TRAIN_BYTES) -> Model:
    return fit(_sample(docs, labels, target, train_docs, train_bytes))


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    bucket, row = buckets(texts)
    total = np.bincount(row, model.weight[bucket], len(texts))
    mean = total / np.maximum(np.bincount(row, minlength=len(texts)), 1)
    return 1 / (1 + np.exp(-(mean + model.bias)))


def accepted(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is at least 0.5."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text_column):
            good = _scores(sent.value, batch.column(text_column)) >= 0.5
            if good.any():
                yield batch.filter(pa.array(good))

    return docs.mapInArrow(work, docs.schema)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` for each row of ``docs``; the model has a fixed size, so it goes to every task."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            p = _scores(sent.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    rows = docs.select(F.col(id_column).cast("long").alias("id"), text_of(text_column).alias("text"))
    return rows.mapInArrow(work, "doc_id long, score double, predicted int")


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``; labels of held-out documents are never learned from."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id"), 3).alias("held_out"), "score", "predicted")
