import random

import numpy as np
import pyarrow as pa
import pytest
from cases import rows, words

from daytally.llm import words as module
from daytally.llm import shared
from daytally.llm.shared import chunks, components, minimum_labels, whole_groups
from daytally.llm.spans import code_points, maximal_runs
from daytally.llm.words import Words


def smallest(edges):
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("kind", ["random", "star", "chain", "loops"])
def test_components(spark, kind):
    rng = random.Random(1)
    edges = {
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "star": [(500, k) for k in range(100)] + [(7, -k) for k in range(1, 100)],
        "chain": [(k + 1, k) for k in range(60)],
        "loops": [(3, 3), (4, 5), (5, 4), (4, 5)],
    }[kind]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == smallest(edges)
    assert found.count() == len(smallest(edges))


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_minimum_labels_equal_components():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 200, (2, 150))
    want = smallest(list(zip(a.tolist(), b.tolist())))
    assert [want.get(k, k) for k in range(200)] == minimum_labels(200, a, b).tolist()


def test_words_are_cut_lowered_and_hashed_alike(monkeypatch):
    monkeypatch.setattr(module, "_PIECE", 64)
    texts = [t for _, t, *_ in rows() if t is None or len(t) < 20_000] + ["\x0bA\x1cB\x85c\xa0d", "", " x", "x ", "É é E"]
    found = Words(pa.array(texts, pa.string()))
    hashes = {}
    for k, text in enumerate(texts):
        own = found.hash[found.first[k]:found.first[k + 1]].tolist()
        want = words(text)
        assert len(own) == len(want)
        for h, w in zip(own, want):
            assert hashes.setdefault(w, h) == h
    assert len(set(hashes.values())) == len(hashes)


@pytest.mark.parametrize("width", [1, 3, 5])
def test_shingles_are_equal_exactly_if_their_words_are(width):
    texts = ["a b c d e f", "b c d", "a b", "", None, "a b c d e", "f e d c b a", "a  b\tc d e f", "c"]
    value, row = Words(pa.array(texts, pa.string())).shingles(width)
    want = {}
    for k, text in enumerate(texts):
        w = words(text)
        runs = [tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
        own = value[row == k].tolist()
        assert len(own) == len(runs)
        for h, r in zip(own, runs):
            assert want.setdefault(r, h) == h
    assert len(set(want.values())) == len(want)


def test_chunks_hold_all_rows_and_little_text():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (1, 5, 0, 30, 2, 2, 2)] + [None])], ["text"])
    parts = list(chunks([batch], limit=6))
    assert [r for p in parts for r in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert [p.num_rows for p in parts] == [3, 1, 4]


def test_whole_groups_are_never_cut():
    key = sorted(random.Random(3).choices(range(12), k=100))
    batches = [pa.RecordBatch.from_arrays([pa.array(key[a:a + 7])], ["k"]) for a in range(0, 100, 7)]
    tables = [t.column("k").to_pylist() for t in whole_groups(batches, ["k"])]
    assert [k for t in tables for k in t] == key
    assert all(a[-1] != b[0] for a, b in zip(tables, tables[1:]))


def test_runs_stay_within_their_row():
    data = np.frombuffer(b"aabb" b"bb" b"" b"bab", np.uint8)
    start, end = maximal_runs(data == ord("b"), np.array([0, 4, 6, 6, 9]))
    assert list(zip(start.tolist(), end.tolist())) == [(2, 4), (4, 6), (6, 7), (8, 9)]
    assert code_points(np.frombuffer("aé🙂".encode(), np.uint8)).tolist() == [0, 1, 2, 2, 3, 3, 3, 3]


@pytest.mark.parametrize("edges_per_task", [10, 20_000])
def test_components_by_rounds_and_by_one_task(spark, monkeypatch, edges_per_task):
    """A small graph takes no rounds, which cost a file from every partition; a larger one gives the same by rounds."""
    seen, store = [], shared.stored
    monkeypatch.setattr(shared, "EDGES_PER_TASK", edges_per_task)
    monkeypatch.setattr(shared, "stored", lambda *a, **k: seen.append(k.get("tasks")) or store(*a, **k))
    chain = [(k, k + 1) for k in range(40)]
    hub = [(100, 100 + k) for k in range(30)]
    edges = [(b, a) if a % 3 else (a, b) for a, b in chain + hub] + [(200, 200)]
    found = components(spark.createDataFrame(edges, "a long, b long").repartition(8))
    want = [(k, 0) for k in range(41)] + [(100 + k, 100) for k in range(30)] + [(200, 200)]
    assert sorted(map(tuple, found.collect())) == want
    assert (len(seen) == 2) == (edges_per_task > 100)
