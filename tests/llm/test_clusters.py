import hashlib

import numpy as np

from daytally.llm import clusters
from daytally.llm.clusters import assigned, cluster, first_centroids, rows_of

COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def expected(rows, k, rounds, width):
    """Every vector against every centroid, in Python's whole numbers."""
    limit = clusters.LIMIT
    data = [(i, [int(max(-limit, min(limit, np.floor(64 * c)))) for c in v]) for i, v in rows
            if v is not None and len(v) == width and all(c is not None and np.isfinite(c) for c in v)]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centroids = [x for _, x in sorted(data, key=lambda r: (name(r[0]), r[1]))[:k]]
    square = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))
    for r in range(rounds + 1):
        near = [min(range(len(centroids)), key=lambda c: (square(x, centroids[c]), c)) for _, x in data]
        if r < rounds:
            for c in range(len(centroids)):
                own = [x for (_, x), at in zip(data, near, strict=True) if at == c]
                if own:
                    centroids[c] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    far = [square(x, centroids[c]) for (_, x), c in zip(data, near, strict=True)]
    return sorted(((i, c, d, sum(e for e, at in zip(far, near, strict=True) if at == c), sum(far),
                    hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
                   for (i, _), c, d in zip(data, near, far, strict=True)), key=repr)


def found(spark, rows, k, rounds, width):
    result = cluster(table(spark, rows).repartition(3), k, rounds, width=width)
    return sorted((tuple(r) for r in result.select(*COLUMNS).collect()), key=repr)


def blobs(count, width, seed, spread=0.3):
    random = np.random.default_rng(seed)
    middle = random.normal(size=(6, width)) * 4
    return [(k, (middle[k % 6] + random.normal(size=width) * spread).tolist()) for k in range(count)]


def test_equals_comparing_every_vector_with_every_centroid(spark):
    for width, k, rounds, spread in ((3, 16, 3, 2.0), (2, 5, 6, 0.5), (8, 1, 2, 1.0)):
        rows = blobs(200, width, k, spread)
        assert found(spark, rows, k, rounds, width) == expected(rows, k, rounds, width)


def test_only_vectors_whose_gap_expires_are_scanned_again(spark):
    rows = rows_of(table(spark, blobs(300, 4, 9, 0.1)), 4)
    _, _, scans = assigned(rows, first_centroids(rows, 6, "1"), 6)
    assert scans[0] == 300 and scans[-1] < 30 and sum(scans[1:]) < 6 * 300 * 0.7


def test_bad_vectors_ties_copies_and_ids(spark):
    bad = [(90, None), (91, [1.0]), (92, [1.0, None]), (93, [float("nan"), 1.0]), (94, [float("-inf"), 1.0]), (95, [])]
    ties = [(k, [float(k % 3), 0.0]) for k in range(30)] + [(None, [1.0, 0.0]), (None, [0.5, 0.0]), (3, [0.5, 0.0]), (3, [-0.0, 0.0])]
    large = [(40, [1e30, -1e30]), (41, [-1e300, 0.0])]
    rows = bad + ties + large
    assert found(spark, rows, 4, 3, 2) == expected(rows, 4, 3, 2)


def test_a_third_of_all_rows_are_one_vector(spark):
    rows = [(k, [1.0, 1.0] if k % 3 == 0 else v) for k, (_, v) in enumerate(blobs(150, 2, 5))]
    assert found(spark, rows, 5, 3, 2) == expected(rows, 5, 3, 2)


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = blobs(3, 2, 1)
    assert found(spark, rows, 16, 3, 2) == expected(rows, 16, 3, 2)
    assert found(spark, [], 16, 3, 2) == []
    assert found(spark, [(1, [1.0])], 16, 3, 2) == []


def test_extra_columns_with_clashing_names(spark):
    rows, names = blobs(20, 2, 2), ("x", "was", "cluster", "key", "distance", "sums", "at", "inertia")
    wide = spark.createDataFrame([(*r, *["?"] * len(names)) for r in rows],
                                 "vec_id long, embedding array<double>" + "".join(f", {n} string" for n in names))
    assert sorted((tuple(r) for r in cluster(wide, 4, 3, width=2).select(*COLUMNS).collect()), key=repr) == expected(rows, 4, 3, 2)
