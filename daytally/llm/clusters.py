"""Centroid clustering with heap-ordered bounds.

For each vector the gap between its distance to the nearest centroid and to the second nearest is known when it is scanned. A
centroid's move lessens the gaps of its vectors by no more than its own way and the longest way of another one. So a
cluster keeps one number, the drift its vectors have met so far, and a vector's key is its gap plus the drift at the time
of its scan: it keeps its cluster for certain until the drift passes the key. No bound of a vector is ever
updated.

The heap of a cluster is a stored table ordered by cluster and key. What a round pops are the keys that the drift has
passed since the round before: a range of each cluster, which Spark finds by the statistics of row groups. Popped
vectors are scanned exactly against all centroids and stored as the next table, with their new keys. A row of any
table counts as long as the drift has not passed its key, so tables are written once and never changed. Sums of
clusters change by the popped vectors alone.

Coordinates, sums, centroids and squared distances are whole numbers and exact. Roots of distances are rounded, so a gap
is lessened by ``MARGIN`` of what it is made of, and equal distances always expire: ties are decided by the exact scan, for
the smaller number.

Rows and edge cases: vectors that are null, hold null or non-finite entries, or have another width than asked for are
dropped. Entries beyond ``LIMIT`` after scaling count as that limit, so that squared distances fit a long. Copies of a vector
are rows like others. A null id hashes as the empty text; rows with one id are ordered by their entries. With fewer
vectors than centroids there are as many centroids as vectors; of equal centroids the smaller number takes all vectors.
An empty table gives an empty result. Other columns are not read.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.shared import stored
from daytally.llm.vectors import is_sound, list_column, matrix, scaled, slabs, summed

WIDTH = 64
FACTOR = 64
LIMIT = 2**27
CLUSTERS = 16
ROUNDS = 3
MARGIN = 1e-9

_STATE = "vec_id long, x array<long>, was int, cluster int, key double"


def rows_of(vectors: DataFrame, width: int = WIDTH, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id, x`` for each vector that takes part."""
    vector = F.col(vector_column)
    return vectors.filter((F.size(vector) == width) & is_sound(vector)).select(
        F.col(id_column).cast("long").alias("vec_id"), scaled(vector, FACTOR, LIMIT).alias("x"))


def first_centroids(rows: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in the order of these."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = rows.orderBy(F.sha2(name, 256), "x").limit(clusters).collect()
    return np.array([r["x"] for r in chosen], dtype=np.int64)


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centroids, exact."""
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def _scan(rows: DataFrame, centroids: np.ndarray, drift: np.ndarray) -> DataFrame:
    """``rows`` with their nearest centroid, the cluster they had (``was``) and their key, in the order of a heap."""
    width = centroids.shape[1]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            squares = _distances(matrix(batch.column(1), width), centroids)
            cluster = squares.argmin(axis=1)
            roots = np.sqrt(np.partition(squares, 1, axis=1)[:, :2].astype(np.float64)) if len(centroids) > 1 else None
            if roots is None:
                key = np.full(len(cluster), np.inf)
            else:
                key = drift[cluster] + roots[:, 1] - roots[:, 0] - MARGIN * (1 + roots[:, 0] + roots[:, 1] + drift[cluster])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(cluster.astype(np.int32)), pa.array(key)],
                ["vec_id", "x", "was", "cluster", "key"])

    return rows.select("vec_id", "x", "was").mapInArrow(scan, _STATE).sortWithinPartitions("cluster", "key")


def _sums(scanned: DataFrame, clusters: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """By how much each cluster's count and sums change by these rows; a row without a former cluster only comes in."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((clusters, width + 1), dtype=np.int64)
        for batch in slabs(batches):
            x = matrix(batch.column(0), width)
            x = np.column_stack([x, np.ones(len(x), dtype=np.int64)])
            was = batch.column(1).fill_null(-1).to_numpy(zero_copy_only=False)
            now = batch.column(2).to_numpy(zero_copy_only=False)
            for c in range(clusters):
                total[c] += x[(now == c) & (was != c)].sum(axis=0) - x[(was == c) & (now != c)].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(clusters, dtype=np.int32)), list_column(total)], ["cluster", "sums"])

    found = np.zeros((clusters, width + 1), dtype=object)
    parts = scanned.select("x", "was", "cluster").mapInArrow(part, "cluster int, sums array<long>")
    for r in summed(parts, ["cluster"], "sums").collect():
        found[r["cluster"], r["at"]] = int(r["v"])
    return found[:, :width], found[:, width]


def _between(before: np.ndarray | None, now: np.ndarray) -> object:
    """Rows of each cluster whose key the drift passed since ``before``, or has not passed if there is none."""
    found = F.lit(False)
    for c, drift in enumerate(now.tolist()):
        inside = (F.col("key") > F.lit(drift)) if before is None else (
            (F.col("key") > F.lit(float(before[c]))) & (F.col("key") <= F.lit(drift)))
        found = found | ((F.col("cluster") == F.lit(c)) & inside)
    return found


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    return whole


def assigned(rows: DataFrame, centroids: np.ndarray, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray, list[int]]:
    """``vec_id, x, cluster`` after the rounds, the last centroids, and the number of rows that each round scanned."""
    clusters, width = centroids.shape
    drift = np.zeros(clusters)
    heaps = [stored(_scan(rows.withColumn("was", F.lit(None).cast("int")), centroids, drift))]
    sums, counts = np.zeros((clusters, width), dtype=object), np.zeros(clusters, dtype=object)
    scans = [heaps[0].count()]
    for _ in range(rounds):
        more_sums, more_counts = _sums(heaps[-1], clusters, width)
        sums, counts = sums + more_sums, counts + more_counts
        moved = np.array([[int(v) // int(n) for v in s] if n else c.tolist() for s, n, c in zip(sums, counts, centroids, strict=True)], dtype=np.int64)
        ways = np.sqrt(((moved - centroids) ** 2).sum(axis=1).astype(np.float64)) * (1 + MARGIN)
        others = np.array([np.delete(ways, c).max(initial=0.0) for c in range(clusters)])
        before, drift, centroids = drift, (drift + ways + others) * (1 + MARGIN), moved
        # A row that a table still holds has a key beyond the drift of its time, so it is popped once, or never.
        popped = _union([h.filter(_between(before if k < len(heaps) - 1 else np.full(clusters, -np.inf), drift))
                         for k, h in enumerate(heaps)])
        heaps.append(stored(_scan(popped.select("vec_id", "x", F.col("cluster").alias("was")), centroids, drift)))
        scans.append(heaps[-1].count())
    last = len(heaps) - 1
    alive = [h if k == last else h.filter(_between(None, drift)) for k, h in enumerate(heaps)]
    return _union([h.select("vec_id", "x", "cluster") for h in alive]), centroids, scans


OUTPUT = "vec_id long, cluster int, distance long"


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = "1", width: int = WIDTH,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for each vector that takes part."""
    rows = rows_of(vectors, width, id_column, vector_column)
    centroids = first_centroids(rows, clusters, seed)
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], OUTPUT + ", cluster_inertia long, inertia long, centroid_sha256 string")
    found, centroids, _ = assigned(rows, centroids, rounds)

    def distance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            at = batch.column(2).to_numpy(zero_copy_only=False)
            off = matrix(batch.column(1), width) - centroids[at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array((off * off).sum(axis=1))], ["vec_id", "cluster", "distance"])

    told = stored(found.mapInArrow(distance, OUTPUT))
    inertia = {r["cluster"]: r["total"] for r in told.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    # One row for each cluster.
    about = rows.sparkSession.createDataFrame(
        [(c, inertia.get(c, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest())
         for c, row in enumerate(centroids)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return told.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
