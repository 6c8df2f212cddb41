import hashlib
from collections import defaultdict

from cases import clashing, collected, documents, rows

from daytally.llm import exact_dup
from daytally.llm.exact_dup import exact_duplicates

COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def expected(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[t or ""].append(i)
    out = []
    for text, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, top, len(ids), i is None or i == top, sha) for i in ids]
    return sorted(out, key=repr)


def test_edge_cases_and_extra_columns(spark):
    pairs = [r[:2] for r in rows()]
    assert collected(exact_duplicates(documents(spark)), *COLUMNS) == expected(pairs)
    assert collected(exact_duplicates(clashing(spark)), *COLUMNS) == expected(pairs)


def test_texts_that_differ_late_or_end_at_a_level(spark, monkeypatch):
    monkeypatch.setattr(exact_dup, "FIRST_BYTES", 4)
    monkeypatch.setattr(exact_dup, "GROWTH", 2)
    texts = ["abcd", "abcde", "abcd", "abcdefgh", "abcdefghi", "abcdefgh", "ab" * 500, "ab" * 499 + "ac", "ab" * 500, "é" * 9, "é" * 9 + "e"]
    pairs = list(enumerate(texts))
    assert collected(exact_duplicates(documents(spark, pairs)), *COLUMNS) == expected(pairs)


def test_empty_table(spark):
    assert exact_duplicates(documents(spark, [])).count() == 0


def test_a_third_of_all_rows_in_one_group(spark):
    pairs = [(k, "same text" if k % 3 == 0 else f"text {k}") for k in range(900)]
    assert collected(exact_duplicates(documents(spark, pairs)), *COLUMNS) == expected(pairs)
