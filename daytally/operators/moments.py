"""Correlations from stored moments: one small row per sector, date and horizon, merged for any period.

A row has the number of pairs, both means, and the sums of squares and products about these means. Rows of parts
merge to the row of the whole, so a day's work replaces the rows of the dates it touches and no correlation reads history
again but for these rows.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.operators.analysis import analysis_rows, trading_calendar
from daytally.operators.maintenance import replace_partitions
from daytally.schemas import RETURN_HORIZONS
from daytally.session import stored

MOMENTS = ["n", "mean_x", "mean_y", "xx", "yy", "xy"]


def moments(rows: DataFrame, by: list[str], x: str = "ratio", horizons: tuple[int, ...] = RETURN_HORIZONS) -> DataFrame:
    """``by``, ``horizon`` and the moments of ``x`` with the return of each horizon, from rows that have both.

    All horizons share one pass and one shuffle; moments combine before it.
    """
    def told(n: int) -> Column:
        pair = F.col(x).isNotNull() & F.col(f"ret_{n}").isNotNull()
        a, b = F.when(pair, F.col(x)), F.when(pair, F.col(f"ret_{n}"))
        count = F.count(a).cast("double")
        return F.struct(
            F.lit(n).alias("horizon"), F.count(a).alias("n"), F.avg(a).alias("mean_x"), F.avg(b).alias("mean_y"),
            (F.var_pop(a) * count).alias("xx"), (F.var_pop(b) * count).alias("yy"), (F.covar_pop(a, b) * count).alias("xy"))

    found = rows.groupBy(*by).agg(*[told(n).alias(f"m{n}") for n in horizons])
    long = found.select(*by, F.explode(F.array(*[f"m{n}" for n in horizons])).alias("m")).select(*by, "m.*")
    return long.where("n > 0")


def merged(parts: DataFrame, by: list[str]) -> DataFrame:
    """Moments of whole groups from the moments of their parts."""
    n, total = F.col("n"), F.sum("n")
    mean_x, mean_y = F.sum(n * F.col("mean_x")) / total, F.sum(n * F.col("mean_y")) / total

    def about(own: str, a: str, b: str, whole: Column) -> Column:
        return F.sum(F.col(own) + n * F.col(a) * F.col(b)) - total * whole

    return parts.groupBy(*by, "horizon").agg(
        total.alias("n"), mean_x.alias("mean_x"), mean_y.alias("mean_y"),
        about("xx", "mean_x", "mean_x", mean_x * mean_x).alias("xx"),
        about("yy", "mean_y", "mean_y", mean_y * mean_y).alias("yy"),
        about("xy", "mean_x", "mean_y", mean_x * mean_y).alias("xy"))


def correlations(
    parts: DataFrame, by: list[str], horizons: tuple[int, ...] = RETURN_HORIZONS, digits: int = 6
) -> DataFrame:
    """Per group, the correlation for each horizon and the number of pairs it rests on. One pair has none, nor have
    values that do not vary."""
    whole = merged(parts, by)
    corr = F.round(F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy"))), digits)
    columns = []
    for n in horizons:
        own = F.col("horizon") == n
        columns += [F.coalesce(F.max(F.when(own, F.col("n"))), F.lit(0)).alias(f"n_ret_{n}"),
                    F.max(F.when(own, corr)).alias(f"corr_ret_{n}")]
    return whole.groupBy(*by).agg(*columns)


def affected_dates(calendar: DataFrame, dates: list, horizons: tuple[int, ...] = RETURN_HORIZONS) -> DataFrame:
    """``date``: the given trading days, and those whose horizons end on one of them."""
    numbers = calendar.where(F.col("date").isin(dates)).select(
        F.explode(F.array(*[F.col("number") - n for n in (0, *horizons)])).alias("number")).distinct()
    return calendar.join(F.broadcast(numbers), "number", "left_semi").select("date")


def refresh(
    spark: SparkSession, combined: DataFrame, prices: DataFrame, sectors: DataFrame, folder: str, dates: list,
    horizons: tuple[int, ...] = RETURN_HORIZONS,
) -> DataFrame:
    """Work out again the moments of the dates that new volumes or prices of ``dates`` bear on, and give back all as stored.

    Only the volumes of these dates and the prices at the ends of their horizons are read beyond the calendar: one date and
    as many earlier ones as there are horizons, for each new date.
    """
    calendar = stored(trading_calendar(prices))
    touched = stored(affected_dates(calendar, dates, horizons))
    numbered = calendar.join(F.broadcast(touched), "date", "left_semi")
    ends = numbered.select(F.explode(F.array(*[F.col("number") + n for n in (0, *horizons)])).alias("number")).distinct()
    needed = calendar.join(F.broadcast(ends), "number", "left_semi").select("date")
    rows = analysis_rows(
        combined.join(F.broadcast(touched), "date", "left_semi"), prices.join(F.broadcast(needed), "date", "left_semi"),
        sectors, calendar)
    replace_partitions(moments(rows, ["sector", "date"], horizons=horizons), folder, ["date"])
    return spark.read.parquet(folder)
