import numpy as np
import pytest

from daytally.llm import whitening
from daytally.llm.whitening import fit, identity_error, rows_of, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"
BAD = [(901, None), (902, [1.0, None, 2.0]), (903, [float("nan"), 0.0, 0.0]), (904, [float("inf"), 0.0, 0.0])]


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0) for i, v in rows], schema)


def drawn(count, width, seed=1):
    random = np.random.default_rng(seed)
    return (random.normal(size=(count, width)) * np.linspace(3, 0.2, width) + random.normal(size=width)).astype(np.float32)


def expected(vectors, k):
    """By the eigenvectors of the covariance; also the exact deviations."""
    x = np.floor(256 * np.array(vectors, dtype=np.float64))
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), [int(s) for s in distinct.sum(axis=0)]
    values, axes = np.linalg.eigh(np.cov(distinct.T, bias=True))
    values, axes = values[::-1], axes[:, ::-1]
    white = (x - distinct.mean(axis=0)) @ axes[:, :k] / np.sqrt(values[:k])
    deviations = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return n, deviations, white, values[:k] / values.sum()


def compare(found, ids, vectors, k):
    n, deviations, white, explained = expected(vectors, k)
    rows = {(r["vec_id"], r["component"]): r for r in found}
    assert len(rows) == len(found) == len(set(ids)) * k
    got = np.array([[rows[i, c + 1]["whitened"] for c in range(k)] for i in ids])
    for c in range(k):
        assert min(np.abs(got[:, c] - white[:, c]).max(), np.abs(got[:, c] + white[:, c]).max()) < 1e-8
    assert all(rows[i, 1]["deviation"] == d and rows[i, 1]["n"] == n for i, d in zip(ids, deviations, strict=True))
    assert np.allclose([rows[ids[0], c + 1]["explained"] for c in range(k)], explained, rtol=1e-9)
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]} and found[0]["identity_error"] < 1e-9


def test_equals_the_eigenvectors_of_the_covariance(spark):
    vectors = drawn(300, 12)
    copies = np.concatenate([vectors, vectors[:50], np.repeat(vectors[:1], 150, axis=0)])
    ids = list(range(len(copies)))
    compare(whiten(table(spark, zip(ids, copies)).repartition(5)).collect(), ids, copies, 4)


def test_bad_vectors_and_other_widths_are_left_out(spark):
    vectors = drawn(40, 3)
    rows = [*enumerate(vectors), *BAD, (905, [1.0, 2.0]), (906, [])]
    compare(whiten(table(spark, rows), 3).collect(), list(range(40)), vectors, 3)


def test_extra_columns_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 0.0], "?"), (7, [0.0, 1.0], "?"), (7, [0.0, 1.0], "?"), (7, [3.0, 1.0], "?")]
    names = ("x", "n", "component", "whitened", "row", "cells", "sums")
    table = spark.createDataFrame([(*r[:2], *["?"] * len(names)) for r in rows],
                                  "vec_id long, embedding array<double>" + "".join(f", {n} string" for n in names))
    found = whiten(table, 2).collect()
    assert len(found) == 8 and {r["n"] for r in found} == {3}
    assert sum(r["vec_id"] is None for r in found) == 2


def test_nothing_to_whiten(spark):
    assert whiten(table(spark, [])).count() == 0
    assert whiten(table(spark, BAD)).count() == 0
    assert whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whiten(table(spark, [(1, []), (2, [])])).count() == 0


def test_directions_without_differences_have_no_component(spark):
    vectors = drawn(50, 2)
    flat = np.column_stack([vectors, np.full(50, 5.0), vectors[:, 0], np.zeros(50)]).astype(np.float32)
    found = whiten(table(spark, enumerate(flat)), 4).collect()
    assert {r["component"] for r in found} == {1, 2}
    compare(found, list(range(50)), flat, 2)


def test_fewer_vectors_than_entries(spark):
    vectors = drawn(3, 10)
    compare(whiten(table(spark, enumerate(vectors))).collect(), [0, 1, 2], vectors, 2)


def test_a_condition_at_which_the_gram_matrix_is_not_definite(spark):
    """One direction a hundred million times as wide as the other: squared, that is beyond doubles."""
    random = np.random.default_rng(3)
    wide, narrow = random.integers(-(2**34), 2**34, 200), random.integers(-8, 8, 200)
    rows = [(k, [(a + b) / 256, (a - b) / 256]) for k, (a, b) in enumerate(zip(wide.tolist(), narrow.tolist(), strict=True))]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = np.array([[a + b, a - b] for a, b in zip(wide.tolist(), narrow.tolist(), strict=True)], dtype=object)
    model, distinct = fit(rows_of(data), 2)
    # The narrow direction is (1, -1), nearly; its variance from whole numbers.
    half = np.array([int(a - b) for a, b in x], dtype=np.float64)
    assert model.scales[1] == pytest.approx(np.sqrt(half.var() / 2), rel=0.02)
    assert identity_error(model, distinct) < 1e-4


def test_large_entries(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])]
    found = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 2).collect()
    limit = whitening.LIMIT
    assert {r["vec_id"]: r["deviation"] for r in found} == {1: None, 2: None, 3: (3 * 512 - 768) ** 2}
    assert 9 * limit**2 > 2**63
    model, _ = fit(rows_of(spark.createDataFrame([(1, [2.0**33, 0.0]), (2, [0.0, 0.0])], "vec_id long, embedding array<double>")), 1)
    assert model.deviations(np.array([[2**41, 0], [0, 0]])) == [None, None]
    assert model.deviations(np.array([[2**40 + 1000, 0], [2**40, 3]])) == [4000000, 36]


def test_deviations_around_the_limit_of_a_long():
    """Products beyond a long, differences within; squares just below, at and above the limit; sums beyond a long."""
    n, edge = 10**6, 3037000499  # the root of the largest long
    x = np.array([[2**52 - 1, 0], [2**52, 1], [2**52 + edge // n, 0], [2**52 + 4000, 0], [0, 0]], dtype=np.int64)
    for sums in ((2**52 * n, 0), (2**52 * n + 17, -5), (edge, 0), (edge + 1, 0), (0, 2**63 + 5)):
        model = whitening.Whitening(n, sums, np.zeros((2, 0)), np.zeros(0), np.zeros(0))
        exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
        assert model.deviations(x) == [v if v < 2**63 else None for v in exact]
