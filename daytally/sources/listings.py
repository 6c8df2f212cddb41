"""Listings of the symbols traded at a venue."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions import normalize_symbol, strip_brackets


def clean_listing(raw: DataFrame) -> DataFrame:
    """Rename the header with a space, drop the column left by a trailing comma, clean all text."""
    listing = raw.withColumnRenamed("Summary Quote", "SummaryQuote").drop("_c8")
    return listing.select(*[
        (normalize_symbol(strip_brackets(F.col(c))) if c == "Symbol" else strip_brackets(F.col(c))).alias(c)
        for c in listing.columns
    ])


def symbol_universe(
    spark: SparkSession, listing: DataFrame | None = None, inline: list[str] | None = None, limit: int | None = None
) -> DataFrame:
    """Symbols to work on: the inline list if there is one, else the listing, optionally its first ``limit``."""
    if inline:
        return spark.createDataFrame([(s,) for s in inline], "Symbol string")
    symbols = listing.select("Symbol").where(F.col("Symbol").isNotNull()).distinct()
    return symbols if limit is None else symbols.orderBy("Symbol").limit(limit)


def csv_lines(df: DataFrame, payload: str, *keep: str) -> DataFrame:
    """Lines of a UTF-8 payload, numbered from 0 (the header)."""
    lines = F.split(F.decode(F.col(payload), "UTF-8"), r"\r?\n")
    return df.select(*keep, F.posexplode(lines).alias("line_no", "line")).where(F.length("line") > 0)


def parse_csv_lines(lines: DataFrame, schema: str, *keep: str) -> DataFrame:
    """Typed columns from data lines held in a text column."""
    data = lines.where(F.col("line_no") > 0).select(*keep, F.from_csv("line", F.lit(schema)).alias("row"))
    return data.select(*keep, "row.*")
