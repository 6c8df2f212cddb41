import random

import pytest
from cases import clashing, collected, documents, passage, rows, words

from daytally.llm import near_dup
from daytally.llm.near_dup import near_duplicates
from daytally.llm.shared import stored

COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def shingles(text, width):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1)))


def expected(pairs, width, percent):
    """Every pair compared; rows that repeat an id are one node."""
    sets = [(i, shingles(t, width)) for i, t in pairs]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    out = []
    for i, s in sets:
        top = None if i is None else find(i)
        out.append((i, len(s), top, i is None or top == i))
    return sorted(out, key=repr)


def edited(rng, text, times):
    w = text.split()
    for _ in range(times):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def families(seed, count, n):
    """Families of copies, edited to all degrees around the limit, with a line that all of them share."""
    rng, out = random.Random(seed), []
    for k in range(count):
        base = "this line is shared by every document there is " + passage(seed * 1000 + k, rng.randint(20, n))
        out += [base, edited(rng, base, 1), edited(rng, base, 2), edited(rng, edited(rng, base, 3), 2), base]
    return list(enumerate(out))


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_edge_cases_and_extra_columns(spark, width, percent):
    want = expected([r[:2] for r in rows()], width, percent)
    assert collected(near_duplicates(documents(spark), width, percent), *COLUMNS) == want
    if width == 3:
        assert collected(near_duplicates(clashing(spark), width, percent), *COLUMNS) == want


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_equals_comparing_every_pair(spark, width, percent):
    pairs = families(width, 60, 120)
    assert collected(near_duplicates(documents(spark, pairs), width, percent), *COLUMNS) == expected(pairs, width, percent)


def test_blocks_of_a_large_family_miss_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "LIST_BLOCK", 8)
    monkeypatch.setattr(near_dup, "FAMILY_BLOCK", 8)
    rng = random.Random(4)
    base = passage(77, 80)
    pairs = list(enumerate([edited(rng, base, rng.randrange(0, 7)) for _ in range(90)]))
    assert collected(near_duplicates(documents(spark, pairs), 3, 85), *COLUMNS) == expected(pairs, 3, 85)


@pytest.mark.parametrize("representatives", [0, 2])
def test_what_lies_apart_meets_across_blocks(spark, monkeypatch, representatives):
    """Several clusters that one passage keeps together, met by no or few representatives."""
    monkeypatch.setattr(near_dup, "LIST_BLOCK", 4)
    monkeypatch.setattr(near_dup, "FAMILY_BLOCK", 4)
    monkeypatch.setattr(near_dup, "REPRESENTATIVES", representatives)
    rng, pairs = random.Random(6), []
    base = passage(78, 90)
    for cluster in range(6):
        centre = edited(rng, base, 3)
        pairs += [edited(rng, centre, rng.randrange(0, 4)) for _ in range(14)]
    pairs = list(enumerate(pairs))
    assert collected(near_duplicates(documents(spark, pairs), 3, 85), *COLUMNS) == expected(pairs, 3, 85)


def test_rows_dealt_grow_with_the_members(spark, monkeypatch):
    """A family of near copies is dealt in proportion to its members, not to their square."""
    dealt, deal = [], near_dup._dealt

    def counted(rows, key):
        out = stored(deal(rows, key))
        if key == "family":
            dealt.append(out.count())
        return deal(rows, key)

    monkeypatch.setattr(near_dup, "_dealt", counted)
    monkeypatch.setattr(near_dup, "FAMILY_BLOCK", 32)
    monkeypatch.setattr(near_dup, "REPRESENTATIVES", 4)
    rng, base, totals = random.Random(7), passage(79, 200), []
    for n in (300, 1200):
        dealt.clear()
        pairs = list(enumerate(edited(rng, base, rng.randrange(1, 4)) for _ in range(n)))
        found = near_duplicates(documents(spark, pairs), 3, 85).collect()
        assert {r.component_id for r in found} == {0}
        totals.append(sum(dealt))
    assert totals[0] < 2 * 300 and totals[1] < 2 * 1200


def test_a_chain_is_one_component(spark):
    w = passage(5, 200).split()
    pairs = [(9 - k, " ".join(w[3 * k:3 * k + 120])) for k in range(8)]
    want = expected(pairs, 3, 85)
    assert {r[2] for r in want} == {2}
    assert collected(near_duplicates(documents(spark, pairs), 3, 85), *COLUMNS) == want


def test_empty_tables(spark):
    assert near_duplicates(documents(spark, []), 3, 85).count() == 0
    assert collected(near_duplicates(documents(spark, [(1, ""), (2, None)])), *COLUMNS) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_an_unsupported_similarity_is_refused(spark):
    with pytest.raises(ValueError):
        near_duplicates(documents(spark, []), 5, 50)
