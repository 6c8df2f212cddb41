import random
import re
from collections import Counter

import pytest
from cases import clashing, collected, documents, lower, passage, rows

from daytally.llm import leaks as module
from daytally.llm.leaks import leaks

WORD = re.compile(r"(?:[0-9A-Za-z]|[^\x00-\x7f])+")


def words(text):
    return [lower(w) for w in WORD.findall(text or "")]


def bag(w):
    return Counter([tuple(w[k:k + 5]) for k in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else [])


def expected(pairs, items):
    out = []
    for i, text in pairs:
        w = words(text)
        for item, other in items:
            v, best = words(other), None
            for s in range(max(1, len(w) - len(v) + 1)) if v and w else ():
                a, b = bag(w[s:s + len(v)]), bag(v)
                over, union = sum((a & b).values()), sum((a | b).values())
                if 5 * over >= 4 * union and (best is None or over * best[1] > best[0] * union):
                    best = over, union, s
            if best:
                out.append((i, item, best[0] / best[1], best[2]))
    return sorted(out, key=repr)


def table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def found(df):
    return collected(df, "doc_id", "item_id", "similarity", "start_word")


def cases(seed):
    """Items of all sizes, hidden whole, edited, cut short, in other case and with other marks."""
    rng = random.Random(seed)
    items = [(k, passage(seed * 100 + k, n)) for k, n in enumerate([1, 3, 4, 5, 6, 8, 14, 15, 30, 40, 59])]
    items += [(50, None), (51, ""), (52, items[8][1])]
    pairs = []
    for k, text in items[:11]:
        w = text.split()
        n = len(w)
        last = [*w[:-1], "changed"]
        doubled = w[:n // 2] + w[n // 2 - 1:]
        for hidden in (w, last, ["changed", *w[1:]], doubled, w[1:], w[:-1], w[:n * 9 // 10], [x.upper() + "!!" for x in w], w + w):
            pairs.append((len(pairs), passage(rng.randrange(10**6), rng.choice([0, 3, 60])) + " " + ", ".join(hidden) + ". " + passage(rng.randrange(10**6), rng.choice([0, 5, 60]))))
    return pairs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_comparing_every_window(spark, seed):
    pairs, items = cases(seed)
    assert found(leaks(documents(spark, pairs), table(spark, items))) == expected(pairs, items)


def test_portions_of_the_items_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(module, "PORTION_ITEMS", 3)
    pairs, items = cases(3)
    assert found(leaks(documents(spark, pairs), table(spark, items))) == expected(pairs, items)


def test_edge_cases_and_extra_columns(spark):
    items = [(1, "two words"), (2, "one two three four five six seven"), (None, "word"), (3, None), (2, passage(2, 100))]
    want = expected([r[:2] for r in rows()], items)
    assert want
    assert found(leaks(documents(spark), table(spark, items))) == want
    assert found(leaks(clashing(spark), table(spark, items))) == want


def test_empty_tables(spark):
    assert leaks(documents(spark, []), table(spark, [(1, "a b c")])).count() == 0
    assert leaks(documents(spark), table(spark, [])).count() == 0
    with pytest.raises(ValueError):
        leaks(documents(spark), table(spark, []), percent=50)


def test_windows_that_end_in_one_repeated_word(spark):
    rng, items, pairs = random.Random(6), [], []
    for k, (n, replaced) in enumerate([(60, 6), (100, 10), (200, 21)] * 4):
        w = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        items.append((k, " ".join(w)))
        # Without words before it, no window of other words around it is as similar.
        pairs.append((k, " ".join([*w[:n - replaced], *["again"] * (replaced + 20)])))
    want = expected(pairs, items)
    assert len(want) == len(pairs)
    assert found(leaks(documents(spark, pairs), table(spark, items))) == want
