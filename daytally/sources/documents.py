"""Per-symbol source documents: ``{dataset: {column_names, data, newest_available_date}}``.

Documents are landed as text and parsed with built-in functions. Each one is a task's worth of rows at
most; a symbol with a long history arrives as several documents.
"""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions import fits, parse_iso, strip_key
from daytally.schemas import DOCUMENT_SCHEMA, RAW_COLUMNS, VOLUME_COLUMNS


def read_documents(spark: SparkSession, path: str, exchange: str) -> DataFrame:
    """Landed documents, one file each, named ``<symbol>.json``."""
    files = spark.read.text(path, wholetext=True).select("*", F.col("_metadata.file_path").alias("SourceURL"))
    symbol = F.regexp_extract("SourceURL", r"([^/]+)\.json$", 1)
    return files.select(F.lit(exchange).alias("exchange"), symbol.alias("Symbol"), "SourceURL", F.col("value").alias("body"))


def _with_dataset(documents: DataFrame) -> DataFrame:
    return documents.withColumn("dataset", F.from_json("body", DOCUMENT_SCHEMA)["dataset"])


def _place(name: str) -> Column:
    """Where a document keeps the column; -1 if it has none."""
    return (F.array_position("dataset.column_names", name) - 1).cast("int").alias(f"at_{name}")


def _cell(name: str) -> Column:
    """The value under ``name``; null if the document lacks the column or the row is too short."""
    return F.get("row", F.col(f"at_{name}"))


def landed_rows(documents: DataFrame, *keep: str) -> DataFrame:
    """The columnar form of documents: one typed row per data row, and one for a document without data rows.

    ``exchange, Symbol, SourceURL`` (without the key), ``status`` and ``newest`` of the document, ``Date`` and the volumes, the
    ``reason`` why the row can't be used (the first column at fault, null for a good row), the faulty ``row`` as it came,
    ``has_row``, and the columns in ``keep``. Store it where several jobs need the documents: the body is
    parsed here and nowhere else. Values are found by column name, so the order of the columns and extra ones do not
    matter.
    """
    # Whatever belongs to the document is worked out before it is split into rows.
    parsed = _with_dataset(documents).select(
        *keep, "exchange", "Symbol", strip_key(F.col("SourceURL")).alias("SourceURL"), _status().alias("status"),
        parse_iso(F.col("dataset.newest_available_date")).alias("newest"),
        *[_place(name) for name in ("Date", *VOLUME_COLUMNS)], F.col("dataset.data").alias("data"),
    )
    # An inner explode would have its non-empty test, and so the parsing, repeated below any earlier join.
    rows = parsed.select(*[c for c in parsed.columns if c != "data"], F.explode_outer("data").alias("row"))
    # Each cell is read once: its number here, and what is to be said of the number after that.
    head = [*keep, "exchange", "Symbol", "SourceURL", "status", "newest"]
    read = rows.select(
        *head, "row", F.col("row").isNotNull().alias("has_row"), parse_iso(_cell("Date")).alias("Date"),
        *[_cell(n).isNotNull().alias(f"has_{n}") for n in VOLUME_COLUMNS],
        *[_cell(n).try_cast("double").alias(n) for n in VOLUME_COLUMNS],
    )
    told = read.withColumns({n: F.when(fits(F.col(n)), F.col(n)) for n in VOLUME_COLUMNS})
    reason = F.when(~F.col("has_row"), F.lit(None).cast("string")).when(F.col("Date").isNull(), "Date")
    for name in VOLUME_COLUMNS:
        reason = reason.when(F.col(f"has_{name}") & F.col(name).isNull(), name)
    return told.select(
        *head, "has_row", "Date", *VOLUME_COLUMNS, reason.alias("reason"),
        F.when(reason.isNotNull(), F.to_json("row")).alias("row"))


def _good() -> Column:
    return F.col("has_row") & F.col("reason").isNull()


def good_rows(landed: DataFrame, *keep: str) -> DataFrame:
    """The rows of :func:`landed_rows` that can be stored."""
    return landed.where(_good()).select("exchange", *RAW_COLUMNS, *keep)


def bad_rows(landed: DataFrame) -> DataFrame:
    """The rows of :func:`landed_rows` that can't, with the reason."""
    return landed.where(F.col("reason").isNotNull()).select("exchange", "Symbol", "SourceURL", "reason", "row")


def _told_apart(landed: DataFrame, wanted: Column, columns: list[str]) -> DataFrame:
    """The columns of the rows that are ``wanted``, where the rows are being parsed.

    A plain filter would be moved below the parsing, which would then run once for the filter and once for the row.
    """
    found = landed.select(F.explode_outer(F.when(wanted, F.array(F.struct(*columns)))).alias("r"))
    return found.where(F.col("r").isNotNull()).select("r.*")


def parse_documents(documents: DataFrame, *keep: str) -> DataFrame:
    """One typed row per good data row, with the venue, the symbol, the key-free address and the columns in
    ``keep`` carried along. The other data rows are in :func:`bad_document_rows`; none is in neither."""
    return _told_apart(landed_rows(documents, *keep), _good(), ["exchange", *RAW_COLUMNS, *keep])


def bad_document_rows(documents: DataFrame) -> DataFrame:
    """Data rows with no readable date, or with a volume that is no number or does not fit, as they came.

    ``reason`` names the first column at fault. A missing volume is no fault.
    """
    return _told_apart(landed_rows(documents), F.col("reason").isNotNull(), ["exchange", "Symbol", "SourceURL", "reason", "row"])


def newest_offered(documents: DataFrame) -> DataFrame:
    """Newest date the source states, and the short volume of its newest row, per venue and symbol."""
    newest_row = F.struct("Date", "TotalVolume", "ShortVolume", "ShortExemptVolume")
    offered = landed_rows(documents).groupBy("exchange", "Symbol").agg(
        F.max("newest").alias("newest_date"), F.max(F.when(_good(), newest_row)).alias("best")
    )
    return offered.select("exchange", "Symbol", "newest_date", F.col("best.ShortVolume").alias("source_volume"))


def offered_at(landed: DataFrame, date: str, *keep: str) -> DataFrame:
    """Newest date the source states, and its short volume on the day in a column ``date`` of the landed rows.

    One row per venue and symbol the source sent rows for, with ``date`` and the columns in ``keep``, which hold one
    value per symbol. ``sent_day`` says whether the source sent a good row for that day.
    """
    # Rows of other days come down to one per symbol by hash; only those of the day are compared as whole rows.
    by, volumes = ["exchange", "Symbol", date, *keep], ["TotalVolume", "ShortVolume", "ShortExemptVolume"]
    same = F.coalesce(_good() & (F.col("Date") == F.col(date)), F.lit(False))
    marked = landed.select(*by, "newest", "has_row", same.alias("same"), *[F.when(same, F.col(c)).alias(c) for c in volumes])
    told = marked.groupBy(*by, "same", *volumes).agg(F.max("newest").alias("newest"), F.count_if("has_row").alias("n"))
    offered = told.groupBy(*by).agg(
        F.max("newest").alias("newest_date"), F.sum("n").alias("n_rows"),
        F.max(F.when(F.col("same"), F.struct(*volumes))).alias("best"))
    return offered.where("n_rows > 0").select(
        "exchange", "Symbol", date, *keep, "newest_date", F.col("best").isNotNull().alias("sent_day"),
        F.col("best.ShortVolume").alias("source_volume"))


def _status() -> Column:
    return (
        F.when(F.col("body").isNull(), "failed")
        .when(F.col("dataset").isNull() | F.col("dataset.data").isNull(), "malformed")
        .when(F.size("dataset.data") == 0, "no data").otherwise("data")
    )


def document_status(documents: DataFrame) -> DataFrame:
    """Every requested symbol with what came back, so a failed request is not taken for a quiet symbol."""
    return _with_dataset(documents).select(
        "exchange", "Symbol", _status().alias("status"),
        F.when(F.col("dataset.data").isNotNull(), F.size("dataset.data")).otherwise(0).alias("n_rows"),
    )


def document_maps(documents: DataFrame) -> DataFrame:
    """The data rows of each document as one ``array<map>`` column, cut to the shorter of names and row."""
    names = F.col("dataset.column_names")

    def as_map(row: Column) -> Column:
        width = F.least(F.size(names), F.size(row))
        return F.map_from_arrays(F.slice(names, 1, width), F.slice(row, 1, width))

    return _with_dataset(documents).select(
        "exchange", "Symbol", F.transform(F.col("dataset.data"), as_map).alias("short_interests")
    )


def explode_maps(df: DataFrame, column: str, keep_empty: bool = False) -> DataFrame:
    """One row per element of an ``array<map>`` column; ``keep_empty`` keeps rows without elements."""
    explode = F.explode_outer if keep_empty else F.explode
    return df.select(*[c for c in df.columns if c != column], explode(column).alias("col"))


def fetch_documents(
    plan: DataFrame, fetch: Callable[[str, str, str, str], tuple[str, str | None]], tasks: int = 64
) -> DataFrame:
    """Request the planned symbols on the executors, a slice of the symbols in each of ``tasks`` tasks.

    The number of tasks bounds the requests that run at a time, besides the cores. It is stated, because a plan is
    so small that the runtime would otherwise join its partitions into one. ``fetch(exchange, symbol, start, end)`` returns the address and the body, or no body after a failure.
    Land the result before parsing it: a lost task repeats its requests.
    """
    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [fetch(*request) for request in batch.itertuples(index=False, name=None)]
            yield pd.DataFrame({
                "exchange": batch["exchange"], "Symbol": batch["Symbol"],
                "SourceURL": [url for url, _ in answers], "body": [body for _, body in answers],
            })

    wanted = plan.where(F.col("action") != "skip").select(
        "exchange", "Symbol", F.col("start_date").cast("string"), F.col("end_date").cast("string")
    )
    found = wanted.repartition(tasks, "exchange", "Symbol").mapInPandas(
        ask, "exchange string, Symbol string, SourceURL string, body string"
    )
    return found.withColumn("SourceURL", strip_key(F.col("SourceURL")))
