"""Corrections of symbols that hold for a time: a table ``wrong, right, valid_from, valid_to``.

Both dates are included; null is open. A symbol may have any number of corrections at different dates, and several
symbols may be corrected to one. Two corrections of a symbol that overlap are a fault of the table.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from daytally.operators.sizes import broadcast_if_small

FIX_SCHEMA = "wrong string, right string, valid_from date, valid_to date"
# The first and last day that dates have.
FIRST_DAY, LAST_DAY = "0001-01-01", "9999-12-31"


class OverlappingFixes(Exception):
    """A symbol has two corrections for one day."""


def fixes_of(spark: SparkSession, always: dict[str, str]) -> DataFrame:
    """Corrections that hold at all times, as a table."""
    return spark.createDataFrame([(wrong, right, None, None) for wrong, right in always.items()], FIX_SCHEMA)


def _bounded(fixes: DataFrame) -> DataFrame:
    def day(column: str, otherwise: str):
        return F.coalesce(F.col(column), F.lit(otherwise).cast("date"))
    return fixes.where("wrong IS NOT NULL AND right IS NOT NULL").select(
        "wrong", "right", day("valid_from", FIRST_DAY).alias("valid_from"), day("valid_to", LAST_DAY).alias("valid_to"))


def check_fixes(fixes: DataFrame) -> None:
    """Stop at corrections of one symbol that overlap, naming the first ten, or that end before they begin."""
    before = Window.partitionBy("wrong").orderBy("valid_from", "valid_to").rowsBetween(Window.unboundedPreceding, -1)
    bad = _bounded(fixes).withColumn("last", F.max("valid_to").over(before))
    bad = bad.where((F.col("valid_from") <= F.col("last")) | (F.col("valid_to") < F.col("valid_from")))
    named = bad.select("wrong", "valid_from").orderBy("wrong", "valid_from").limit(10).collect()
    if named:
        raise OverlappingFixes("; ".join(f"{r['wrong']} from {r['valid_from']}" for r in named))


def fix_symbols(rows: DataFrame, fixes: DataFrame, symbol: str = "Symbol", date: str = "Date", into: str = "Symbol") -> DataFrame:
    """``rows`` with the corrected symbol in the column ``into``. Symbols without a correction on the day, and nulls, stay.

    An interval join on the symbol and the day. A row is never multiplied, because corrections of a symbol do not overlap
    (:func:`check_fixes`). The table is broadcast if it measures small; else the join is by symbol, and Spark splits the
    rows of a symbol that has very many.
    """
    names = {c: f"_fix_{c}" for c in ("wrong", "right", "valid_from", "valid_to")}
    table = broadcast_if_small(_bounded(fixes)).withColumnsRenamed(names)
    meets = (F.col(symbol) == F.col("_fix_wrong")) & F.col(date).between(F.col("_fix_valid_from"), F.col("_fix_valid_to"))
    joined = rows.join(table, meets, "left")
    return joined.withColumn(into, F.coalesce("_fix_right", symbol)).drop(*names.values())
