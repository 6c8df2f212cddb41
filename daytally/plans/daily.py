"""The daily run: load, check, combine, publish, check again, study.

The store is partitioned by venue, pull date and batch, the combined table by date, and every write replaces
whole partitions. So each step can be repeated after a failure, and a day's work reads and writes the
partitions the day touches rather than the whole history.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daytally.operators.analysis import analysis_rows, sampled_correlation, sector_correlation
from daytally.operators.ingest import advance_last_dates, incremental_plan, last_dates, load, load_landed_rows
from daytally.operators.maintenance import (
    append_batch, clear_partition, publish_csv_days, read_index, replace_partitions,
)
from daytally.operators.quality import answers, basic_quality, enforce, landed_vs_stored, no_bad_rows, reconcile
from daytally.operators.sizes import broadcast_if_small
from daytally.operators.venues import combine
from daytally.schemas import SYMBOL_FIXES
from daytally.session import cut_lineage
from daytally.sources.documents import bad_rows, landed_rows
from daytally.sources.tables import table_exists

# Corrections of symbols: a few that always hold, or a table of them with dates (operators.fixes).
Fixes = dict[str, str] | DataFrame

VENUE_SYMBOL = ("exchange", "Symbol")


def _day(text: str) -> Column:
    return F.lit(text).cast("date")


def known_dates(spark: SparkSession, store: str, marks: str, pull: str) -> DataFrame:
    """Newest stored date per venue and symbol before the run of ``pull``.

    Starts from the newest saved dates and adds the pull dates stored since, so the history is read only
    if nothing was saved. What an earlier run of the same day stored does not count.
    """
    stored = spark.read.parquet(store).where(F.col("pull_date") < _day(pull))
    if not table_exists(spark, marks):
        return last_dates(stored, VENUE_SYMBOL)
    saved = spark.read.parquet(marks).where(F.col("pull_date") < _day(pull))
    newest = saved.agg(F.max("pull_date")).first()[0]
    if newest is None:
        return last_dates(stored, VENUE_SYMBOL)
    since = stored.where(F.col("pull_date") > F.lit(newest))
    return advance_last_dates(saved.where(F.col("pull_date") == F.lit(newest)), since, VENUE_SYMBOL)


def save_dates(spark: SparkSession, store: str, marks: str, pull: str) -> None:
    """Save the newest stored dates as of ``pull``."""
    today = spark.read.parquet(store).where(F.col("pull_date") == _day(pull))
    dates = advance_last_dates(known_dates(spark, store, marks, pull), today, VENUE_SYMBOL)
    replace_partitions(dates.withColumn("pull_date", _day(pull)), marks, ["pull_date"])


def land_day(documents: DataFrame, folder: str, pull: str) -> DataFrame:
    """Parse the day's documents into rows, once, and give these back as stored. The same day replaces itself."""
    path = f"{folder}/pull_date={pull}"
    landed_rows(documents).write.mode("overwrite").parquet(path)
    return documents.sparkSession.read.parquet(path)


def _plan(spark: SparkSession, symbols: DataFrame, store: str, marks: str, start: str, pull: str) -> DataFrame:
    known = known_dates(spark, store, marks, pull) if table_exists(spark, store) else None
    return incremental_plan(symbols, known, start, pull)


def _store_day(spark: SparkSession, rows: DataFrame, store: str, marks: str, pull: str) -> None:
    append_batch(rows, store, pull)
    if table_exists(spark, store):
        save_dates(spark, store, marks, pull)


def load_day(
    spark: SparkSession, documents: DataFrame, symbols: DataFrame, store: str, marks: str, start: str, pull: str
) -> None:
    """Add the rows of documents that are not stored yet. ``symbols`` has ``exchange`` and ``Symbol``."""
    _store_day(spark, load(documents, _plan(spark, symbols, store, marks, start, pull)), store, marks, pull)


def load_landed_day(
    spark: SparkSession, landed: DataFrame, symbols: DataFrame, store: str, marks: str, start: str, pull: str
) -> None:
    """As :func:`load_day`, from landed rows."""
    _store_day(spark, load_landed_rows(landed, _plan(spark, symbols, store, marks, start, pull)), store, marks, pull)


def quarantine_day(landed: DataFrame, folder: str, pull: str) -> DataFrame:
    """Set aside the day's data rows that can't be read, and give them back. The same day replaces itself."""
    path = f"{folder}/pull_date={pull}"
    bad_rows(landed).write.mode("overwrite").parquet(path)
    return landed.sparkSession.read.parquet(path)


def check_store(spark: SparkSession, landed: DataFrame, store: str, bad: DataFrame | None = None) -> DataFrame:
    """Presence; whether every request was answered; freshness and accuracy of the symbols the source sent rows
    for; and whether all rows could be read."""
    checks = basic_quality(spark, {"short_interests": store}).unionByName(answers(landed))
    if bad is not None:
        checks = checks.unionByName(no_bad_rows(bad, "documents"))
    if not table_exists(spark, store):
        return checks
    return checks.unionByName(landed_vs_stored(spark.read.parquet(store), landed))


def publish_all(spark: SparkSession, store: str, combined: str, fixes: Fixes = SYMBOL_FIXES) -> None:
    """Combine every stored row."""
    replace_partitions(combine(spark.read.parquet(store), fixes), combined, ["date"])


def changed_dates(spark: SparkSession, store: str, pull: str) -> list:
    """The dates that the runs of ``pull`` brought rows for, or took rows of: one for each calendar day at most."""
    index = read_index(spark, store)
    stored = spark.read.parquet(store).where(F.col("pull_date") == _day(pull)).select("Date")
    if index is None:
        rows = stored
    else:
        entries = index.where(F.col("pull_date") == _day(pull))
        # A batch that is being written may have rows of dates that are not indexed yet.
        open_batch = entries.where(F.col("stored") & F.col("Date").isNull()).head(1)
        rows = entries.select("Date").union(stored) if open_batch else entries.select("Date")
    return sorted(r["Date"] for r in rows.where("Date IS NOT NULL").distinct().collect())


def rows_of(spark: SparkSession, store: str, dates: list) -> DataFrame:
    """Stored rows of some dates, whichever batch brought them.

    Batches that the index names for none of the dates are not read; of the others, row groups without any of the dates
    are skipped by their statistics.
    """
    stored = spark.read.parquet(store)
    if not dates:
        return stored.limit(0)
    stored, index = stored.where(F.col("Date").isin(dates)), read_index(spark, store)
    if index is None:
        return stored
    wanted = F.col("stored") & (F.col("Date").isin(dates) | F.col("Date").isNull())
    batches = index.where(wanted).select("pull_date", "batch").distinct()
    return stored.join(broadcast_if_small(batches), ["pull_date", "batch"], "left_semi")


def publish_changes(
    spark: SparkSession, store: str, combined: str, pull: str, fixes: Fixes = SYMBOL_FIXES
) -> list:
    """Combine again the dates that the runs of ``pull`` brought rows for or took rows of, and name them.

    A date that has no stored row left is published without rows.
    """
    dates = changed_dates(spark, store, pull)
    if dates:
        totals = combine(rows_of(spark, store, dates), fixes)
        replace_partitions(totals, combined, ["date"])
        left = {r["Date"] for r in rows_of(spark, store, dates).select("Date").distinct().collect()}
        inner = StructType([f for f in totals.schema.fields if f.name != "date"])
        for date in dates:
            if date not in left:
                clear_partition(spark, combined, inner, {"date": str(date)})
    return dates


def published(spark: SparkSession, combined: str, dates: list) -> DataFrame:
    """The partitions of some dates."""
    whole = spark.read.parquet(combined)
    return whole.where(F.col("date").isin(dates)) if dates else whole.limit(0)


def check_published(
    spark: SparkSession, store: str, combined: str, dates: list | None = None, fixes: Fixes = SYMBOL_FIXES
) -> DataFrame:
    """Presence and reconciliation, of the given dates or of all."""
    presence = basic_quality(spark, {"short_analysis": combined})
    if not table_exists(spark, combined):
        return presence
    if dates is None:
        return presence.unionByName(reconcile(spark.read.parquet(combined), spark.read.parquet(store), fixes))
    # Not by the index: a batch that it lacks is missing from the totals, and must not be missing here too.
    stored = spark.read.parquet(store).where(F.col("Date").isin(dates))
    return presence.unionByName(reconcile(published(spark, combined, dates), stored, fixes))


def run_day(
    spark: SparkSession, documents: DataFrame, symbols: DataFrame, folders: dict[str, str], start: str, pull: str,
    fixes: Fixes = SYMBOL_FIXES,
) -> None:
    """One day from landed documents to the published table. Stops at the first set of checks with a failure.

    ``folders`` names the shared folders ``store``, ``marks``, ``combined``, ``export``, ``checks``, ``quarantine`` and
    ``landed`` (beside the quarantine if it is not named). All checks of a day are in ``checks`` whether it stops or not.
    Documents are parsed once, into ``landed``; load, quarantine and checks read that. Checks, combined table and export
    read and write what the day touched.
    """
    store, combined = folders["store"], folders["combined"]
    landed = land_day(documents, folders.get("landed", folders["quarantine"].rstrip("/") + "_landed"), pull)
    bad = quarantine_day(landed, folders["quarantine"], pull)
    load_landed_day(spark, landed, symbols, store, folders["marks"], start, pull)
    enforce(check_store(spark, landed, store, bad), f"{folders['checks']}/pull_date={pull}/stage=store")
    if not table_exists(spark, store):
        return
    dates = publish_changes(spark, store, combined, pull, fixes)
    if dates:
        enforce(check_published(spark, store, combined, dates, fixes), f"{folders['checks']}/pull_date={pull}/stage=published")
        publish_csv_days(published(spark, combined, dates), folders["export"], days=dates)


def study(
    combined: DataFrame, prices: DataFrame, sectors: DataFrame, calendar: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Correlations over all rows, per year, and over the sampled middle band.

    With a calendar (``analysis.trading_calendar``) horizons are counted in its days, else in the days a symbol has prices
    for. The joined rows are stored: all three need some of their columns, and they come out of several shuffles.
    """
    rows = cut_lineage(analysis_rows(combined, prices, sectors, calendar))
    return {
        "by_sector": sector_correlation(rows),
        "by_sector_and_year": sector_correlation(rows, per_year=True),
        "sampled": sampled_correlation(rows),
    }
