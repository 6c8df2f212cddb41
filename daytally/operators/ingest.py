"""Incremental load: which dates to ask for, per symbol, and which rows to keep."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.operators.sizes import broadcast_if_small
from daytally.operators.venues import dedupe
from daytally.sources.documents import good_rows, parse_documents

# The columns that carry a symbol's request along with its documents and rows.
WINDOW = ["last_date", "start_date", "end_date"]


def last_dates(stored: DataFrame, keys: tuple[str, ...] = ("Symbol",)) -> DataFrame:
    """Newest stored date per symbol, or per venue and symbol."""
    return stored.groupBy(*keys).agg(F.max("Date").alias("last_date"))


def advance_last_dates(known: DataFrame, batch: DataFrame, keys: tuple[str, ...] = ("Symbol",)) -> DataFrame:
    """Newest dates after a batch, from the newest dates before it. Stored rows are not read again."""
    both = known.select(*keys, "last_date").unionByName(last_dates(batch, keys))
    return both.groupBy(*keys).agg(F.max("last_date").alias("last_date"))


def global_max_date(stored: DataFrame) -> DataFrame:
    return stored.agg(F.max("Date").alias("max_date"))


def _as_date(text: str) -> Column:
    return F.lit(text).cast("date")


def incremental_plan(symbols: DataFrame, known: DataFrame | None, start: str, pull: str) -> DataFrame:
    """The request for every symbol: ``full`` for an unseen one, ``partial`` after its newest stored date,
    ``skip`` if that date is not before the pull date.

    ``symbols`` holds ``Symbol``, with ``exchange`` where venues are loaded together. ``known`` holds one
    row for each of them that is stored, or is None if nothing is.
    """
    if known is None:
        planned = symbols.withColumn("last_date", F.lit(None).cast("date"))
    else:
        planned = symbols.join(known, symbols.columns, "left")
    last, end = F.col("last_date"), _as_date(pull)
    plan = planned.select(
        *symbols.columns, "last_date",
        F.coalesce(last, _as_date(start)).alias("start_date"), end.alias("end_date"),
        F.when(last.isNull(), "full").when(last < end, "partial").otherwise("skip").alias("action"),
    )
    return broadcast_if_small(plan, bounded_by=symbols)


def fixed_plan(symbols: DataFrame, table_exists: bool, start: str, yesterday: str) -> DataFrame:
    """The older rule: one day for every symbol once there is a table, all days before that."""
    first = yesterday if table_exists else start
    plan = symbols.select(
        *symbols.columns, F.lit(None).cast("date").alias("last_date"),
        _as_date(first).alias("start_date"), _as_date(yesterday).alias("end_date"),
        F.lit("partial" if table_exists else "full").alias("action"),
    )
    return broadcast_if_small(plan, bounded_by=symbols)


def wanted(df: DataFrame, plan: DataFrame) -> DataFrame:
    """``df`` (documents or rows) of the symbols that are not skipped, with the columns of their window."""
    keys = [c for c in ("exchange", "Symbol") if c in plan.columns]
    return df.join(plan.where(F.col("action") != "skip").select(*keys, *WINDOW), keys)


def new_rows(windowed: DataFrame) -> DataFrame:
    """Rows to store, of rows with their window: inside it, after the newest stored date, one per key."""
    inside = F.col("Date").between(F.col("start_date"), F.col("end_date"))
    unseen = F.col("last_date").isNull() | (F.col("Date") > F.col("last_date"))
    return dedupe(windowed.where(inside & unseen).drop(*WINDOW))


def load(documents: DataFrame, plan: DataFrame) -> DataFrame:
    """New rows of documents. The plan meets whole documents, so skipped ones are never parsed and
    rows are not joined."""
    return new_rows(parse_documents(wanted(documents, plan), *WINDOW))


def load_landed_rows(landed: DataFrame, plan: DataFrame) -> DataFrame:
    """New rows of documents that have been parsed (``sources.landed_rows``)."""
    return new_rows(good_rows(wanted(landed, plan), *WINDOW))
