import zlib

import numpy as np
from cases import clashing, collected, documents, passage, rows

from daytally.llm import quality


def labels(spark, pairs):
    return spark.createDataFrame([(i, q, 0, "?") for i, q in pairs], "doc_id long, quality int, toxic int, label string")


def good_and_bad():
    """Prose, and the same prose shouted or stuttered."""
    pairs, marks = [], []
    for k in range(300):
        text = passage(k, 60)
        kind = k % 5
        if kind == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif kind == 1:
            text = " ".join(w for w in text.split()[:6] for _ in range(20))
        pairs.append((k, text))
        marks.append((k, int(kind > 1)))
    return pairs, marks


def fold(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 3 == 1


def test_held_out_documents_are_told_apart(spark):
    pairs, marks = good_and_bad()
    got = {r.doc_id: r for r in quality.classify(spark, documents(spark, pairs), labels(spark, marks)).collect()}
    assert {i: r.held_out for i, r in got.items()} == {i: fold(i) for i, _ in pairs}
    held = [i for i, _ in pairs if fold(i)]
    assert np.mean([got[i].predicted == dict(marks)[i] for i in held]) > 0.97
    assert all((r.score >= 0.5) == (r.predicted == 1) and 0 <= r.score <= 1 for r in got.values())


def test_labels_of_held_out_documents_are_never_read(spark):
    pairs, marks = good_and_bad()
    turned = [(i, 1 - q if fold(i) else q) for i, q in marks]
    docs = documents(spark, pairs)
    one = collected(quality.classify(spark, docs, labels(spark, marks)), "doc_id", "score")
    assert one == collected(quality.classify(spark, docs, labels(spark, turned)), "doc_id", "score")


def test_edge_cases_and_extra_columns(spark):
    marks = [(1, 1), (2, 0), (2, 1), (8, 1), (10, 0), (None, 1), (13, None), (11, 0), (77, 1)]
    plain = collected(quality.classify(spark, documents(spark), labels(spark, marks)), "doc_id", "held_out", "score", "predicted")
    assert [(i, h) for i, h, *_ in plain] == sorted([(r[0], fold(r[0])) for r in rows()], key=lambda x: repr(x))
    assert plain == collected(quality.classify(spark, clashing(spark), labels(spark, marks)), "doc_id", "held_out", "score", "predicted")


def test_without_labels_or_documents(spark):
    got = quality.classify(spark, documents(spark, [(1, "a"), (2, None)]), labels(spark, []))
    assert {(r.score, r.predicted) for r in got.collect()} == {(0.5, 1)}
    assert quality.classify(spark, documents(spark, []), labels(spark, [(1, 1)])).count() == 0


def test_a_score_depends_on_the_text_alone(spark):
    model = quality.train(*[f(spark, x) for f, x in zip((documents, labels), good_and_bad())])
    docs = documents(spark, [(1, "same text here"), (2, "same text here"), (3, "")])
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert got[1] == got[2]
    assert quality.accepted(documents(spark), model).columns == documents(spark).columns
    kept = quality.accepted(docs, model)
    assert collected(kept, "doc_id") == [(i,) for i, s in sorted(got.items()) if s >= 0.5]


def test_the_sample_is_bounded_in_rows_and_bytes(spark):
    pairs, marks = good_and_bad()
    docs, marked = documents(spark, pairs), labels(spark, marks)
    every = quality._sample(docs, marked, "quality", 4000, 1 << 30)
    assert len(every) == sum(not fold(i) for i, _ in marks)
    # An id that repeats, with its own text or with others, is one document of the sample.
    again = docs.unionByName(docs).unionByName(documents(spark, [(0, passage(k, 30)) for k in range(50)]))
    assert len(quality._sample(again, marked, "quality", 4000, 1 << 30)) == len(every)
    assert len(quality._sample(docs, marked, "quality", 10, 1 << 30)) == 10
    size = sorted((r["place"], len(r["bucket"]) + len(r["count"])) for r in every)
    some = quality._sample(docs, marked, "quality", 4000, sum(n for _, n in size[:7]) + 1)
    assert sorted(r["place"] for r in some) == [place for place, _ in size[:7]]
    assert quality._sample(documents(spark, []), marked, "quality", 4000, 1) == []
