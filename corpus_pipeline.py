"""The pipeline over ``documents``: each stage applies one operator to all that the stage before kept.

Rows and edge cases: a stage drops rows, never ids, so of rows that repeat an id exactly the judged ones go. A null text
counts as empty; empty texts are judged by quality alone, and of several one stays. Rows without an id are judged like others; of
equal texts a row with an id is preferred. Ties go to the larger id among equal texts and to the smaller among near
copies. An empty table passes through. Further columns are kept up to the last stage, whatever their names.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.llm import bpe, exact_dup, leaks, near_dup, quality
from daytally.llm.shared import read_table, small, stored


def _row(docs: DataFrame) -> str:
    """A name that no column has, for a row's own number, by which operators name it."""
    name, taken = "daytally_row", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _numbered(docs: DataFrame, name: str, nulls_first: bool = False) -> DataFrame:
    """``docs`` with a number of each row, in the order of the ids: the id itself if no row lacks one or repeats it."""
    number = F.col("doc_id").cast("long")
    if docs.groupBy(number.alias("id")).count().filter("id is null or count > 1").isEmpty():
        return docs.withColumn(name, number)
    # Rows with one id may be many, so their place splits them too. Stored, so that numbers stay as they are.
    order = number.asc_nulls_first() if nulls_first else number.asc_nulls_last()
    placed = docs.withColumn(name, F.monotonically_increasing_id()).orderBy(order, name)
    return stored(placed.withColumn(name, F.monotonically_increasing_id()))


def _without(rows: DataFrame, verdicts: DataFrame, name: str) -> DataFrame:
    """The numbered rows that no verdict drops, without their numbers."""
    dropped = stored(verdicts.select(F.col("doc_id").alias(name)).distinct())
    return rows.join(small(dropped), name, "left_anti").drop(name)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Of equal texts the largest number stays, so a row with an id is preferred.
    rows = _numbered(docs, name := _row(docs), nulls_first=True)
    return _without(rows, exact_dup.exact_duplicates(rows, id_column=name).filter("not kept"), name)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _numbered(docs, name := _row(docs))
    return _without(rows, near_dup.near_duplicates(rows, id_column=name).filter("not kept"), name)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _numbered(docs, name := _row(docs))
    return _without(rows, leaks.leaks(rows, read_table(spark, sf_dir, "benchmark"), id_column=name), name)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_leaks),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# Trained scores and tokenizers are beyond SQL; the tests compare each stage with a brute-force version.
ORACLE_SQL = None
