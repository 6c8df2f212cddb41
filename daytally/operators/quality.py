"""Checks. Each gives rows ``check, subject, status, expected, actual``; status is SUCCESS or FAIL."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions import exact_sum, is_close, iso_text, volume_text
from daytally.operators.fixes import fix_symbols
from daytally.operators.ingest import last_dates
from daytally.operators.sizes import broadcast_if_small
from daytally.operators.venues import KEEP_ORDER, dedupe, kept_rows, largest_row, one_row_per_venue, sum_over
from daytally.schemas import CHECK_COLUMNS, DAY_KEY, SYMBOL_FIXES, VENUES
from daytally.session import stored as stored_once
from daytally.sources.documents import landed_rows, offered_at
from daytally.sources.tables import table_exists


class CheckFailed(Exception):
    """At least one check has status FAIL."""


def _verdict(passed: Column) -> Column:
    """FAIL for null as well: a check without an answer has not passed."""
    return F.when(passed, "SUCCESS").otherwise("FAIL").alias("status")


def not_empty(df: DataFrame, subject: str) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        F.lit("not empty").alias("check"), F.lit(subject).alias("subject"), _verdict(F.col("n") > 0),
        F.lit("rows").alias("expected"), F.col("n").cast("string").alias("actual"),
    )


def basic_quality(spark: SparkSession, tables: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Whether each table exists and has rows, and how many."""
    checks = []
    for subject, path in tables.items():
        if table_exists(spark, path, fmt):
            reader = spark.read.format(fmt)
            checks.append(not_empty((reader.option("header", True) if fmt == "csv" else reader).load(path), subject))
        else:
            missing = [("exists", subject, "FAIL", "a table", "does not exist")]
            checks.append(spark.createDataFrame(missing, ", ".join(f"`{c}` string" for c in CHECK_COLUMNS)))
    return reduce(DataFrame.unionByName, checks)


def latest_rows(stored: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row per key; rows of one date are told apart by their volumes, then by all columns."""
    return largest_row(stored, keys, ["Date", "TotalVolume", "ShortVolume", "ShortExemptVolume"])


def quality_vs_source(stored: DataFrame, documents: DataFrame) -> DataFrame:
    """:func:`landed_vs_stored` for documents that have not been parsed."""
    return landed_vs_stored(stored, landed_rows(documents))


def landed_vs_stored(stored: DataFrame, landed: DataFrame) -> DataFrame:
    """Freshness and accuracy of the newest stored row, for every venue and symbol the source sent rows for.

    A symbol that was not requested, or that the source had nothing for, has nothing to be compared with. Accuracy is
    compared on the newest stored day, and only if the source sent that day: an incremental answer may not. The stored
    side is one row per venue and symbol, found first; it meets the landed rows where they are, which come down to one row
    per venue and symbol before anything is shuffled.
    """
    keys = ["exchange", "Symbol"]
    # Dates come down by hash; whole rows, which would be sorted, are compared on the newest day alone.
    newest = broadcast_if_small(stored_once(last_dates(stored, tuple(keys)).withColumnRenamed("last_date", "Date")))
    on_day = stored.select(*keys, "Date", "TotalVolume", "ShortVolume", "ShortExemptVolume").join(newest, [*keys, "Date"])
    latest = latest_rows(on_day, keys)
    latest = stored_once(latest.select(*keys, F.col("Date").alias("stored_date"), F.col("ShortVolume").alias("stored_volume")))
    pairs = offered_at(landed.join(broadcast_if_small(latest), keys, "left"), "stored_date", "stored_volume")
    freshness = F.struct(
        F.lit("freshness").alias("check"), (F.col("stored_date") == F.col("newest_date")).alias("passed"),
        iso_text(F.col("newest_date")).alias("expected"), iso_text(F.col("stored_date")).alias("actual"),
    )
    no_volume = F.col("stored_volume").isNull() & F.col("source_volume").isNull()
    accuracy = F.struct(
        F.lit("accuracy").alias("check"), (no_volume | is_close(F.col("stored_volume"), F.col("source_volume"))).alias("passed"),
        volume_text(F.col("source_volume")).alias("expected"), volume_text(F.col("stored_volume")).alias("actual"),
    )
    checks = F.array_compact(F.array(freshness, F.when(F.col("sent_day"), accuracy)))
    rows = pairs.select(F.concat_ws("/", *keys).alias("subject"), F.explode(checks).alias("c"))
    return rows.select("c.check", "subject", _verdict(F.col("c.passed")), "c.expected", "c.actual")


def answers(landed: DataFrame) -> DataFrame:
    """Whether every request was answered, from landed rows. A quiet symbol has answered; a failed or malformed one has not."""
    worst = F.max(F.struct(F.col("status").isin("failed", "malformed").alias("bad"), "status"))
    found = landed.groupBy("exchange", "Symbol").agg(worst.alias("worst"))
    return found.select(
        F.lit("answered").alias("check"), F.concat_ws("/", "exchange", "Symbol").alias("subject"),
        _verdict(~F.col("worst.bad")), F.lit("data or no data").alias("expected"), F.col("worst.status").alias("actual"),
    )


def no_bad_rows(bad: DataFrame, subject: str) -> DataFrame:
    """Whether a quarantine is empty."""
    counted = bad.agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        F.lit("readable rows").alias("check"), F.lit(subject).alias("subject"), _verdict(F.col("n") == 0),
        F.lit("0").alias("expected"), F.col("n").cast("string").alias("actual"),
    )


def reconcile(
    combined: DataFrame, stored: DataFrame, fixes: dict[str, str] | DataFrame = SYMBOL_FIXES,
    venues: tuple[str, ...] = VENUES,
) -> DataFrame:
    """Published short volume against the sum over the venues, for every date and symbol.

    The two sides are stacked and totalled together: one shuffle and no sort, where a full outer join of
    two totals would take two of each. A key on one side only fails.
    """
    nothing = F.lit(None).cast("double")
    if isinstance(fixes, DataFrame):
        # One row per venue and stored symbol: what several are corrected to is added up below.
        totals = fix_symbols(dedupe(stored.select(*DAY_KEY, *KEEP_ORDER)), fixes)
        volume = F.col("ShortVolume")
    else:
        totals = one_row_per_venue(stored, venues, fixes)
        volume = sum_over(kept_rows(venues, fixes), "ShortVolume")
    expected = totals.select(
        F.col("Date").alias("date"), F.col("Symbol").alias("symbol"), volume.alias("venue_volume"),
        nothing.alias("short_volume"), F.lit(True).alias("is_stored"),
    )
    published = combined.select(
        "date", "symbol", nothing.alias("venue_volume"), "short_volume", F.lit(False).alias("is_stored")
    )
    pairs = expected.unionByName(published).groupBy("date", "symbol").agg(
        exact_sum(F.col("venue_volume")).alias("venue_volume"), exact_sum(F.col("short_volume")).alias("short_volume"),
        F.max("is_stored").alias("stored"), F.max(~F.col("is_stored")).alias("published"),
    )
    both = F.col("stored") & F.col("published")
    no_volume = F.col("short_volume").isNull() & F.col("venue_volume").isNull()
    return pairs.select(
        F.lit("reconciliation").alias("check"),
        F.concat_ws("/", iso_text(F.col("date")), "symbol").alias("subject"),
        _verdict(both & (no_volume | is_close(F.col("short_volume"), F.col("venue_volume")))),
        volume_text(F.col("venue_volume")).alias("expected"), volume_text(F.col("short_volume")).alias("actual"),
    )


def gate_summary(checks: DataFrame) -> DataFrame:
    """Checks and failures per kind of check, and whether that kind passed."""
    failed = F.count_if(F.col("status") == "FAIL")
    return checks.groupBy("check").agg(
        F.count(F.lit(1)).alias("n_checks"), failed.alias("n_failed"), (failed == 0).alias("passed")
    )


def enforce(checks: DataFrame, folder: str | None = None) -> None:
    """Stop the run if any check failed, naming the first ten.

    With a folder, all checks are written there before anything is raised, and the failures are counted from it.
    """
    if folder is not None:
        checks.write.mode("overwrite").parquet(folder)
        checks = checks.sparkSession.read.parquet(folder)
    failures = checks.where(F.col("status") == "FAIL")
    failed = failures.orderBy("check", "subject").limit(10).collect()
    if failed:
        named = "; ".join(f"{r['check']} {r['subject']}: {r['actual']} instead of {r['expected']}" for r in failed)
        kept = "" if folder is None else f"; all {failures.count()} are in {folder}"
        raise CheckFailed(named + kept)
