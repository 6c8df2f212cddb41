"""What several operators use: tables written to the shared folder, bounded text batches, components of a graph."""

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.operators.sizes import broadcast_if_small
from daytally.session import shared_folder

# Bytes of text that a task works on at once, unless one text alone is longer.
CHUNK_BYTES = 2 << 20
# A side of a join is broadcast up to this size.
BROADCAST_BYTES = 16 << 20
# Edges that a task of a graph's round writes, unless a shuffle has too few partitions for that.
EDGES_PER_TASK = 20_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, *partition_by: str, tasks: int | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: it survives lost executors and is computed once.

    ``tasks`` write it, where the number of rows is known to be too small for a file from every partition of a shuffle.
    """
    path = f"{shared_folder(df.sparkSession)}/daytally-{uuid.uuid4().hex}"
    df = df if tasks is None else df.coalesce(tasks)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it measures at most ``BROADCAST_BYTES``; else the join stays with Spark."""
    return broadcast_if_small(df, BROADCAST_BYTES)


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(doc_id: Column, folds: int) -> Column:
    """The fold rule: crc32 of the id as text leaves 1. A null id counts as empty text."""
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 1, F.lit(False))


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text, one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row starts (one more than rows); null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset:]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As few edges ``a, b`` as join what the given ones join: of every node to the smallest that a task's edges reach."""
    held: list[pa.Table] = []

    def stars() -> pa.RecordBatch:
        table = pa.concat_tables(held)
        ends = [table.column(name).to_numpy() for name in ("a", "b")]
        node, place = np.unique(np.concatenate(ends), return_inverse=True)
        label = minimum_labels(len(node), *np.split(place, 2))
        moved = np.flatnonzero(label != np.arange(len(node)))
        return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[label[moved]])], ["a", "b"])

    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(map(len, held)) > 4 * EDGES_PER_TASK:
            yield stars()
            held.clear()
    if held:
        yield stars()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; the component is the smallest node reachable.

    Every task first joins what its own edges join, which for the edges of one task is the result. For more, the
    large-star and small-star steps alternate until nothing changes; each node holds one row per
    neighbour and the minimum is an aggregate, so a hub never meets in one task. Every round is stored, by as many tasks
    as its edges are worth: a round never has more edges than the one before.
    """
    pairs = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    pairs = pairs.filter("a <> b")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())

    tasks = -(-pairs.count() // EDGES_PER_TASK)
    if not tasks:
        return nodes.withColumn("component", F.col("node"))
    alone = tasks == 1
    pairs = stored(pairs.coalesce(tasks).mapInArrow(_contracted, "a long, b long"))
    state = None if alone else mark(pairs)
    while not alone:
        tasks = -(-state[0] // EDGES_PER_TASK)
        # Large star: every neighbour larger than the node goes to the smallest neighbour.
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Stored, here and below, so that both sides of the join are shuffled for it and Spark can split a hub's neighbours.
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), tasks=tasks)
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: the node and its smaller neighbours go to the smallest of them.
        large = large.filter("a <> b").distinct()
        low = stored(large.groupBy("a").agg(F.min("b").alias("m")), tasks=tasks)
        joined = large.join(low, "a")
        smaller = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = stored(smaller.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), tasks=tasks)
        before, pairs = state, new
        state = mark(pairs)
        if state == before:
            break
    found = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    return found.coalesce(tasks)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold only whole groups, from batches sorted by ``keys``."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        start = group_starts(table, keys)[-1]
        # The first rows may go on with the group that is held.
        if start or held and any(held[-1].column(key)[-1] != table.column(key)[0] for key in keys):
            whole = [*held, table.slice(0, start)]
            if any(part.num_rows for part in whole):
                yield pa.concat_tables(whole).combine_chunks()
            held = []
        held.append(table.slice(start))
    if held:
        yield pa.concat_tables(held).combine_chunks()


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which a new group begins."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        value = table.column(key).to_numpy()
        new[1:] |= value[1:] != value[:-1]
    return np.flatnonzero(new)


def minimum_labels(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For the graph with edges ``a[i], b[i]`` over ``count`` nodes: the smallest node of each node's component."""
    label = np.arange(count)
    while len(a):
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return label


def task_count(spark: SparkSession) -> int:
    """Partitions for a shuffle whose rows are dealt out by hand."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
