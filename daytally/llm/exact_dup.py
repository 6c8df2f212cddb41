"""Exact duplicates by radix partitioning from the first byte on.

Documents are split into groups by their first bytes, the groups by the next bytes, and so on until a group
holds one document or its documents have ended. Equality is equality of all bytes; no digest takes part. Each
level takes more bytes than the one before, so a long text needs few levels, and a document leaves at the level
that tells it from all others. A level is an aggregate (which combines before the shuffle) and a join of
documents with their group, whose skewed side Spark splits; no group ever meets in one task.

Rows and edge cases: one row comes out per row that goes in. Null text counts as empty, and all empty texts are
equal. Of equal texts the largest id stays. Rows that repeat an id and a text are one document named twice: both
carry the same answer, and ``group_size`` counts both. A row without an id can't be named as the one to keep, so
it is always kept, and ``keep_id`` is null only if no row of the group has an id. Other columns are not read.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.shared import small, stored, text_of

FIRST_BYTES = 128
GROWTH = 8
_LEVEL = ["part", "digit", "ended"]


def _level(state: DataFrame, width: int) -> DataFrame:
    """Documents with the digit they are split by, and whether their text ends with it."""
    return state.withColumn("digit", F.substring("body", 1, width)).withColumn("ended", F.octet_length("body") <= width)


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for each row of ``docs``."""
    state = docs.select(
        F.lit(0).cast("long").alias("part"), F.col(id_column).cast("long").alias("id"),
        text_of(text_column).cast("binary").alias("body"),
    ).withColumn("sha", F.lit(None).cast("string"))
    width, answers = FIRST_BYTES, []
    while True:
        dealt = _level(state, width)
        groups = dealt.groupBy(*_LEVEL).agg(F.count("*").alias("n"), F.max("id").alias("top"))
        # Numbered as stored, so that the numbers of groups can't change when a task runs again.
        groups = stored(groups.withColumn("number", F.monotonically_increasing_id()))
        groups = groups.withColumn("settled", F.col("ended") | (F.col("n") == 1))
        sha = F.coalesce("sha", F.sha2("body", 256)).alias("sha")
        answers.append(
            dealt.select(*_LEVEL, "id", sha).join(groups.filter("settled"), _LEVEL)
            .select("id", "top", "n", "sha"))
        open_groups = groups.filter("not settled").select(*_LEVEL, "number")
        if open_groups.isEmpty():
            break
        state = stored(
            dealt.select(*_LEVEL, "id", sha, "body").join(small(open_groups), _LEVEL)
            .select(F.col("number").alias("part"), "id",
                    F.substring("body", width + 1, 2**31 - 1).alias("body"), "sha"))
        width *= GROWTH
    found = answers[0]
    for more in answers[1:]:
        found = found.unionByName(more)
    return found.select(
        F.col("id").alias("doc_id"), F.col("top").alias("keep_id"), F.col("n").alias("group_size"),
        F.coalesce(F.col("id") == F.col("top"), F.lit(True)).alias("kept"), F.col("sha").alias("text_sha256"))
