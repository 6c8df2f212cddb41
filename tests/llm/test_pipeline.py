"""Each stage against a brute-force version, on documents with planted cases."""

import random

import corpus_pipeline as pipeline
import pytest
from cases import SCHEMA, documents, passage, rows
from test_bpe import expected as encoded
from test_bpe import library  # noqa: F401
from test_leaks import expected as leaked
from test_near_dup import edited
from test_near_dup import expected as near

ITEMS = [(k, passage(9000 + k, 20 + k)) for k in range(8)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Clean, shouted and stuttered documents, copies, near copies and benchmark passages."""
    rng, texts = random.Random(2), {}
    for k in range(160):
        texts[k] = passage(k, 80)
    for k in range(160, 200):
        texts[k] = " ".join(w.upper() + "!!" for w in passage(k, 40).split())
    for k in range(200, 230):
        texts[k] = " ".join(w for w in passage(k, 5).split() for _ in range(20))
    for k in range(230, 250):
        texts[k] = texts[k - 200]
    for k in range(250, 265):
        texts[k] = edited(rng, texts[k - 180], 1)
    for k in range(265, 273):
        texts[k] = passage(k, 30) + "\n" + ITEMS[k - 265][1] + "\n" + passage(k + 50, 30)
    folder = tmp_path_factory.mktemp("tables")
    documents(spark, list(texts.items())).write.parquet(str(folder / "documents.parquet"))
    marks = [(k, int(not 160 <= k < 230), 0) for k in texts if k % 2 == 0 or k < 230]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder), texts


def test_every_stage_does_its_work_and_keeps_the_rest(spark, tables, library):  # noqa: F811
    folder, texts = tables
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), dict(texts)
    stages = dict(pipeline.STAGES)

    def after(name):
        found = stages[name](spark, docs, folder)
        assert found.columns == docs.columns and found.schema.simpleString() == docs.schema.simpleString()
        return found

    docs = after("quality")
    left = {r.doc_id for r in docs.collect()}
    assert left == {k for k in kept if not 160 <= k < 230}
    kept = {k: kept[k] for k in left}

    docs = after("exact_dedup")
    last = {t: k for k, t in sorted(kept.items())}
    kept = {k: t for t, k in last.items()}
    assert {r.doc_id for r in docs.collect()} == set(kept)

    docs = after("near_dedup")
    kept = {i: kept[i] for i, _, _, stays in near(sorted(kept.items()), 5, 80) if stays}
    assert {r.doc_id for r in docs.collect()} == set(kept)

    docs = after("decontamination")
    bad = {i for i, *_ in leaked(sorted(kept.items()), ITEMS)}
    assert bad == set(range(265, 273))
    kept = {k: t for k, t in kept.items() if k not in bad}
    assert {(r.doc_id, r.text) for r in docs.collect()} == set(kept.items())

    found = stages["bpe"](spark, docs, folder)
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found.collect()) == sorted(encoded(library, kept.items()))
    whole = pipeline.run(spark, folder)
    assert sorted((r.doc_id, list(r.ids)) for r in whole.collect()) == sorted((r.doc_id, list(r.ids)) for r in found.collect())


def test_stages_get_through_edge_cases(spark, tables, tmp_path):
    folder, _ = tables
    for given in (rows(), []):
        docs = spark.createDataFrame(given, SCHEMA)
        for name, stage in pipeline.STAGES[:-1]:
            found = stage(spark, docs, folder)
            assert found.columns == docs.columns, name
            path = str(tmp_path / f"{name}{len(given)}")
            found.write.parquet(path)
            docs = spark.read.parquet(path)
        assert pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()


def test_exactly_the_judged_rows_go(spark, tables):
    folder, _ = tables
    one, two, three, four = (passage(5000 + k, 80) for k in range(4))
    leak = passage(6000, 30) + " " + ITEMS[0][1] + " " + passage(6001, 30)
    near_one = " ".join([*one.split()[:-1], "changed"])
    given = [
        # Ids on rows with different texts: one a copy, a near copy or a leak, the other clean.
        (1, one), (2, one), (1, two), (3, near_one), (3, three), (4, leak), (4, four),
        # Rows without an id: copies of one text and of a row with an id, a leak; rows that repeat both.
        (None, passage(7000, 80)), (None, passage(7000, 80)), (None, two), (None, leak + " more"), (5, passage(7001, 80)), (5, passage(7001, 80)),
    ]
    docs, stages = documents(spark, given), dict(pipeline.STAGES)

    def left():
        return sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)

    docs = stages["exact_dedup"](spark, docs, folder)
    want = [(2, one), (1, two), (3, near_one), (3, three), (4, leak), (4, four), (None, passage(7000, 80)), (None, leak + " more"),
            (5, passage(7001, 80))]
    assert left() == sorted(want, key=repr)
    docs = stages["near_dedup"](spark, docs, folder)
    want.remove((3, near_one))
    want.remove((None, leak + " more"))
    assert left() == sorted(want, key=repr)
    docs = stages["decontamination"](spark, documents(spark, [*want, (None, leak + " more")]), folder)
    want.remove((4, leak))
    assert left() == sorted(want, key=repr)


def test_columns_named_as_the_stages_name_theirs(spark, tables):
    folder, texts = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < 12 or doc_id between 230 and 240")
    for name in ("daytally_row", "DAYTALLY_ROW_", "kept", "component_id", "at", "label"):
        docs = docs.selectExpr("*", f"-doc_id as {name}")
    for name in ("exact_dedup", "near_dedup", "decontamination"):
        docs = dict(pipeline.STAGES)[name](spark, docs, folder)
    got = docs.collect()
    assert {r.doc_id for r in got} == {*range(12), *range(230, 241)}
    assert all(r["daytally_row"] == r["at"] == -r.doc_id for r in got)
