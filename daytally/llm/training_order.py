"""Token files in training order.

Texts become token ids, cut into sequences of a fixed number of tokens; each text ends with the end-of-text token. The
sequences are numbered, and a keyed Feistel permutation of the numbers gives every sequence its slot in the training
order: numbers are pairs of digits to the base of the rounded-up square root, and a number that falls outside the
range walks along its cycle until it is inside. Consecutive slots form shards. A task gathers one shard, sorts it by
slot and writes it as one file of records of equal length, so slot s is found in shard s // slots at
(s % slots) * stride, and a reader resumes anywhere by arithmetic. Shards are written in waves, so that only a part
of the tokens is in flight at a time; a wave whose shards are all there is not written again.

A record: slot, document, sequence number and number of tokens (big-endian; 8, 8, 4 and 4 bytes), the tokens (little-
endian, 2 bytes each; the rest is zero), and a line feed, which ends it.

Rows and edge cases: every row of the documents is written. Null text counts as empty; an empty text is one sequence
that holds the end alone. Rows are independent of each other, so ids may repeat; a null id is written as the
smallest long and read back as null. The numbers are fixed when the sequences are stored, in the order of the
input's files; the same key and the same stored sequences give the same order. Without documents there is no shard.
Other columns are not read.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.llm.bpe import TOKENIZER, load
from daytally.llm.shared import chunks, stored, text_of
from daytally.llm.words import mix

KEY = 2026
TOKENS = 512
SHARD_SLOTS = 32_768
WAVES = 4
ROUNDS = 6
END_TOKEN = "<|endoftext|>"
_HEADER = np.dtype([("slot", ">i8"), ("doc", ">i8"), ("seq", ">i4"), ("n", ">i4")])
_NO_ID = np.iinfo(np.int64).min


def permuted(number: np.ndarray, count: int, key: int) -> np.ndarray:
    """The place of each number below ``count`` under the permutation that ``key`` picks."""
    base = np.uint64(max(1, int(np.ceil(np.sqrt(count)))))
    while int(base) ** 2 < count:
        base += np.uint64(1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + mix(np.array([key % 2**64], np.uint64)))
    out = np.asarray(number, np.uint64).copy()
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] // base, out[walking] % base
        for k in keys:
            left, right = right, (left + mix(right ^ k) % base) % base
        out[walking] = left * base + right
        walking = walking[out[walking] >= count]
    return out.astype(np.int64)


@dataclass(frozen=True)
class Layout:
    """All that a reader needs to know of a set of shards."""

    folder: str
    sequences: int
    tokens: int
    slots: int

    @property
    def stride(self) -> int:
        return _HEADER.itemsize + 2 * self.tokens + 1

    @property
    def shards(self) -> int:
        return -(-self.sequences // self.slots)

    def place(self, slot: int) -> tuple[int, int]:
        """Shard and byte of a slot."""
        return slot // self.slots, slot % self.slots * self.stride


def _cut(path: str, tokens: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        end = np.array([bpe.encoding.encode_single_token(END_TOKEN)], np.uint16)
        if bpe.encoding.n_vocab > 1 << 16:
            raise ValueError("token ids must fit in two bytes")
        for batch in chunks(batches):
            doc, seq, data = [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                ids = np.concatenate([bpe.encode(text).astype("<u2"), end])
                for n, a in enumerate(range(0, len(ids), tokens)):
                    doc.append(k)
                    seq.append(n)
                    data.append(ids[a:a + tokens].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(doc, pa.int64())), pa.array(seq, pa.int32()), pa.array(data, pa.binary())],
                ["doc_id", "seq_no", "tokens"])

    return work


def sequences(docs: DataFrame, path: str | None = None, tokens: int = TOKENS, id_column: str = "doc_id",
              text_column: str = "text") -> DataFrame:
    """``number, doc_id, seq_no, tokens``, stored: the numbers are the writing task's and the place in it."""
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text_of(text_column).alias("text"))
    cut = rows.mapInArrow(_cut(path or public_tokenizers.path(TOKENIZER), tokens), "doc_id long, seq_no int, tokens binary")
    return stored(cut.withColumn("number", F.monotonically_increasing_id()))


def _slots(batch: pa.RecordBatch, sent, layout: Layout, key: int) -> np.ndarray:
    """Slots of stored sequences: their number in the order of tasks and places, permuted."""
    task, base = sent.value
    number = batch.column("number").to_numpy()
    return permuted(base[np.searchsorted(task, number >> 33)] + (number & ((1 << 33) - 1)), layout.sequences, key)


def _records(sent, layout: Layout, key: int, low: int, high: int):
    """Records of the slots from ``low`` up to ``high``, from stored sequences."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = _slots(batch, sent, layout, key)
            mine = np.flatnonzero((slot >= low) & (slot < high))
            if not len(mine):
                continue
            part, slot = batch.take(pa.array(mine)), slot[mine]
            data = part.column("tokens")
            size = np.diff(np.frombuffer(data.buffers()[1], np.int32, len(data) + 1, 4 * data.offset))
            head = np.zeros(len(mine), _HEADER)
            head["slot"], head["n"] = slot, size // 2
            head["doc"] = part.column("doc_id").fill_null(_NO_ID).to_numpy()
            head["seq"] = part.column("seq_no").to_numpy()
            record = np.zeros((len(mine), layout.stride), np.uint8)
            record[:, :_HEADER.itemsize] = head.view(np.uint8).reshape(len(mine), -1)
            record[:, -1] = 0x0A
            for k, value in enumerate(data.to_pylist()):
                record[k, _HEADER.itemsize:_HEADER.itemsize + len(value)] = np.frombuffer(value, np.uint8)
            flat = pa.py_buffer(record.tobytes())
            binary = pa.FixedSizeBinaryArray.from_buffers(pa.binary(layout.stride), len(mine), [None, flat])
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot // layout.slots), pa.array(slot), binary.cast(pa.binary())], ["shard", "slot", "record"])

    return work


def _present(spark: SparkSession, layout: Layout) -> set[int]:
    """Shards that are there in full."""
    path = spark._jvm.org.apache.hadoop.fs.Path(layout.folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return set()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "part-*").load(layout.folder).select("path", "length").collect()
    out = set()
    for f in files:
        shard = int(f.path.rpartition("shard=")[2].partition("/")[0])
        if f.length == min(layout.slots, layout.sequences - shard * layout.slots) * layout.stride:
            out.add(shard)
    return out


def wave_of(layout: Layout, waves: int, wave: int) -> range:
    """Shards of a wave."""
    return range(layout.shards * wave // waves, layout.shards * (wave + 1) // waves)


def _numbering(numbered: DataFrame, folder: str, tokens: int, slots: int) -> tuple:
    """The layout, and where each storing task's numbers begin: one row for each of these tasks."""
    tasks = numbered.groupBy(F.shiftright("number", 33).alias("task")).agg(F.count("*").alias("n")).orderBy("task").collect()
    task, count = np.array([r.task for r in tasks], np.int64), np.array([r.n for r in tasks], np.int64)
    sent = numbered.sparkSession.sparkContext.broadcast((task, np.cumsum(count) - count))
    return Layout(folder, int(count.sum()), tokens, slots), sent


def write(numbered: DataFrame, folder: str, key: int = KEY, tokens: int = TOKENS, slots: int = SHARD_SLOTS,
          waves: int = WAVES) -> Layout:
    """Write the shards of stored sequences to ``folder``; waves that are there in full are left as they are."""
    spark = numbered.sparkSession
    layout, sent = _numbering(numbered, folder, tokens, slots)
    for k in range(waves):
        wave, there = wave_of(layout, waves, k), _present(spark, layout)
        if there.issuperset(wave):
            continue
        if there.intersection(wave):
            raise ValueError(f"wave {k} is there in part; its shards must go first")
        first, last = wave[0], wave[-1]
        rows = numbered.mapInArrow(
            _records(sent, layout, key, first * slots, (last + 1) * slots), "shard long, slot long, record binary")
        placed = rows.repartitionById(last - first + 1, (F.col("shard") - first).cast("int"))
        # The text writer puts a line feed after each value: the record's last byte.
        value = F.expr(f"cast(substring(record, 1, {layout.stride - 1}) as string)").alias("value")
        (placed.sortWithinPartitions("shard", "slot").select("shard", value)
         .write.mode("append").partitionBy("shard").text(folder))
    missing = set(range(layout.shards)) - _present(spark, layout)
    if missing:
        raise RuntimeError(f"shards of another size than their slots: {sorted(missing)[:10]}")
    return layout


def index(numbered: DataFrame, layout: Layout, key: int = KEY) -> DataFrame:
    """``slot, shard, byte, doc_id, seq_no, n_tokens``: where each stored sequence is written."""
    _, sent = _numbering(numbered, layout.folder, layout.tokens, layout.slots)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = _slots(batch, sent, layout, key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array(slot // layout.slots), pa.array(slot % layout.slots * layout.stride),
                 *(batch.column(n) for n in ("doc_id", "seq_no", "n_tokens"))],
                ["slot", "shard", "byte", "doc_id", "seq_no", "n_tokens"])

    size = (F.octet_length("tokens") / 2).cast("int").alias("n_tokens")
    return numbered.select("number", "doc_id", "seq_no", size).mapInArrow(
        work, "slot long, shard long, byte long, doc_id long, seq_no int, n_tokens int")


def read(spark: SparkSession, layout: Layout, first: int = 0, stop: int | None = None) -> DataFrame:
    """``slot, doc_id, seq_no, n_tokens, tokens`` of the slots from ``first`` up to ``stop``, from the files.

    Spark's reader of records of equal length splits the files between records.
    """
    schema = "slot long, doc_id long, seq_no int, n_tokens int, tokens binary"
    stop = layout.sequences if stop is None else stop
    if first >= min(stop, layout.sequences):
        return spark.createDataFrame([], schema)
    shards = range(first // layout.slots, -(-stop // layout.slots))
    path = f"{layout.folder}/shard=*" if len(shards) == layout.shards else f"{layout.folder}/shard={{{','.join(map(str, shards))}}}"
    size = _HEADER.itemsize

    def parsed(record: bytes) -> tuple:
        slot, doc, seq, n = np.frombuffer(record, _HEADER, 1)[0].item()
        return slot, None if doc == _NO_ID else doc, seq, n, bytes(record[size:size + 2 * n])

    records = spark.sparkContext.binaryRecords(f"{path}/part-*", layout.stride)
    return spark.createDataFrame(records.map(parsed), schema).filter(F.col("slot").between(first, stop - 1))
