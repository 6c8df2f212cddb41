"""Rows of several venues: union, one row per key, totals per day and symbol."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.functions import exact_sum, exact_total, remap_symbol
from daytally.operators.fixes import check_fixes, fix_symbols
from daytally.schemas import COMBINED_COLUMNS, DAY_KEY, SYMBOL_FIXES, VENUES

# Which of several rows for one key stays: the largest by these columns, in this order.
KEEP_ORDER = ["TotalVolume", "ShortVolume", "ShortExemptVolume"]


def union_venues(tables: dict[str, DataFrame]) -> DataFrame:
    """All rows of all venues, matched by column name, with the venue as a column."""
    parts = [df.withColumn("exchange", F.lit(venue)) for venue, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def largest_row(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the largest by ``order``, then by every other column, so the choice is total.

    A maximum combines on the map side, so a key with very many rows never meets in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"best.{c}") for c in df.columns])


def dedupe(df: DataFrame, keys: list[str] = DAY_KEY) -> DataFrame:
    return largest_row(df, keys, KEEP_ORDER)


def _totals(df: DataFrame) -> DataFrame:
    """Nulls are skipped; a group of nulls sums to null."""
    sums = df.groupBy("Date", "Symbol").agg(
        exact_sum(F.col("ShortExemptVolume")).alias("short_exempt_volume"),
        exact_sum(F.col("ShortVolume")).alias("short_volume"),
        exact_sum(F.col("TotalVolume")).alias("total_volume"),
    )
    return sums.select(F.col("Date").alias("date"), F.col("Symbol").alias("symbol"), *COMBINED_COLUMNS[2:])


def combine_raw(df: DataFrame) -> DataFrame:
    """Totals per date and symbol over every stored row, repeated days included."""
    return _totals(df)


def _variant(symbol: Column, fixes: dict[str, str]) -> Column:
    """Which of the stored symbols of its corrected symbol it is: 0 the symbol itself, then those to be corrected."""
    rank, seen = F.lit(0), {}
    for wrong, right in fixes.items():
        seen[right] = seen.get(right, 0) + 1
        rank = F.when(symbol == wrong, seen[right]).otherwise(rank)
    return rank


def kept_rows(venues: tuple[str, ...] = VENUES, fixes: dict[str, str] = SYMBOL_FIXES) -> dict[str, tuple[str, int]]:
    """Columns of :func:`one_row_per_venue`: one per venue and stored symbol that a corrected symbol can have."""
    most = max((list(fixes.values()).count(right) for right in fixes.values()), default=0)
    return {f"{v}_{k}": (v, k) for v in venues for k in range(most + 1)}


def one_row_per_venue(
    df: DataFrame, venues: tuple[str, ...] = VENUES, fixes: dict[str, str] = SYMBOL_FIXES
) -> DataFrame:
    """The kept rows of each venue and stored symbol, side by side, per date and corrected symbol.

    Duplicates are told by the stored symbol: correcting it first would take the rows of two symbols for copies.
    Removing duplicates and lining up the venues share one shuffle on date and corrected symbol, and a maximum per
    task comes first, so a key with very many rows never meets in one task. A venue that is not listed stops
    the job: its rows would otherwise be missing from the totals.
    """
    known = F.col("exchange").isin(*venues)
    checked = F.when(known, F.col("exchange")).otherwise(
        F.raise_error(F.concat(F.lit("unlisted venue: "), F.coalesce("exchange", F.lit("null"))))
    )
    rows = df.select(
        checked.alias("exchange"), _variant(F.col("Symbol"), fixes).alias("variant"), "Date",
        remap_symbol(F.col("Symbol"), fixes).alias("Symbol"), *KEEP_ORDER,
    )
    best = [
        F.max(F.when((F.col("exchange") == v) & (F.col("variant") == k), F.struct(*KEEP_ORDER))).alias(name)
        for name, (v, k) in kept_rows(venues, fixes).items()
    ]
    return rows.groupBy("Date", "Symbol").agg(*best)


def sum_over(kept: Iterable[str], column: str) -> Column:
    """Sum over the kept rows that have a value; null if none does."""
    return exact_total(*[F.col(f"{name}.{column}") for name in kept])


def combine(
    df: DataFrame, fixes: dict[str, str] | DataFrame = SYMBOL_FIXES, venues: tuple[str, ...] = VENUES
) -> DataFrame:
    """Totals per date and corrected symbol, from one row per venue, date and symbol as stored.

    Stored symbols that are corrected to the same one are added up, so a date and symbol never has two rows. ``fixes`` are
    a few that always hold, or a table of any number with dates (``operators.fixes``), which are then as in
    :func:`combine_dated`.
    """
    if isinstance(fixes, DataFrame):
        return combine_dated(df, fixes)
    kept = kept_rows(venues, fixes)
    return one_row_per_venue(df, venues, fixes).select(
        F.col("Date").alias("date"), F.col("Symbol").alias("symbol"),
        sum_over(kept, "ShortExemptVolume").alias("short_exempt_volume"),
        sum_over(kept, "ShortVolume").alias("short_volume"),
        sum_over(kept, "TotalVolume").alias("total_volume"),
    )


def combine_any_venue(df: DataFrame, fixes: dict[str, str] = SYMBOL_FIXES) -> DataFrame:
    """As :func:`combine`, for any set of venues, at the price of a second shuffle."""
    kept = dedupe(df.select(*DAY_KEY, *KEEP_ORDER))
    return _totals(kept.withColumn("Symbol", remap_symbol(F.col("Symbol"), fixes)))


def combine_dated(df: DataFrame, fixes: DataFrame) -> DataFrame:
    """As :func:`combine`, for any set of venues, with a table of corrections that hold for a time.

    Duplicates are told by the symbol as stored, so they are settled first; the kept rows meet the corrections and are
    added up. Both aggregates combine before their shuffles, and the corrections are no columns, so the plan is the same for
    one and for thousands.
    """
    check_fixes(fixes)
    return _totals(fix_symbols(dedupe(df.select(*DAY_KEY, *KEEP_ORDER)), fixes))
