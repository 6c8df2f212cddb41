"""Every registered query runs over whole tables; those that SQL can express are compared with it."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from daytally.llm.queries import ORACLE, QUERIES

TABLES = "/root/testdata/sf0.001"


def test_one_query_for_each_operator_and_the_pipeline():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(entry.queries()) >= {*QUERIES, "pipeline"}
    assert set(entry.oracle_sql()) >= set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "labels", "benchmark", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TABLES}/{table}.parquet'")
    found = QUERIES[name](spark, TABLES)
    cursor = connection.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted(cursor.fetchall(), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"op12_whitening"}))
def test_query_returns_a_row_per_document(spark, name):
    documents = spark.read.parquet(f"{TABLES}/documents.parquet").count()
    found = QUERIES[name](spark, TABLES)
    assert "doc_id" in found.columns
    if name.startswith("op1_"):
        assert found.select("slot").distinct().count() == found.count() >= documents
    elif not name.startswith("op4_"):
        assert found.count() == documents


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "bpe"]
