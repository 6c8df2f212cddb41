"""Short-volume ratio against forward returns, by sector."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally.functions import ratio
from daytally.operators.quantiles import grouped_quantiles
from daytally.operators.sizes import broadcast_if_small
from daytally.schemas import RETURN_HORIZONS
from daytally.session import stored

# Leading hexadecimal digits by which a sample's cut is found.
SAMPLE_DIGITS = 5


def short_ratio(combined: DataFrame) -> DataFrame:
    return combined.withColumn("ratio", ratio(F.col("short_volume"), F.col("total_volume")))


def forward_returns(prices: DataFrame, horizons: tuple[int, ...] = RETURN_HORIZONS) -> DataFrame:
    """Return from each day's close to the close ``n`` stored days later; null past the end.

    Days are those the symbol has a price for: a day that is missing makes its horizons longer by one. ``prices`` has one row per date and symbol, so a window holds one symbol's trading days and no more.
    """
    days = Window.partitionBy("symbol").orderBy("date")
    return prices.select(
        "date", "symbol", "close",
        *[(F.try_divide(F.lead("close", n).over(days), F.col("close")) - 1).alias(f"ret_{n}") for n in horizons],
    )


def trading_calendar(rows: DataFrame, date: str = "date") -> DataFrame:
    """``date, number``: the days on which anything was traded, numbered from 0.

    The days of all rows come down to a set per task, so what meets is one entry per calendar day.
    """
    days = rows.agg(F.array_sort(F.collect_set(date)).alias("days"))
    return days.select(F.posexplode("days").alias("number", "date")).select("date", "number")


def working_day_returns(
    prices: DataFrame, calendar: DataFrame, horizons: tuple[int, ...] = RETURN_HORIZONS
) -> DataFrame:
    """Return from each day's close to the close ``n`` trading days later, by the numbers of a calendar.

    A symbol without a price on that very day has no return for the horizon, where :func:`forward_returns` would take
    its next stored day. Prices of days that the calendar lacks are left out. ``prices`` has one row per date and symbol;
    a window holds the days of one symbol, and a horizon is a frame of one number, so all of them share a sort.
    """
    numbered = prices.join(broadcast_if_small(calendar), "date")
    later = lambda n: Window.partitionBy("symbol").orderBy("number").rangeBetween(n, n)
    return numbered.select(
        "date", "symbol", "close",
        *[(F.try_divide(F.max("close").over(later(n)), F.col("close")) - 1).alias(f"ret_{n}") for n in horizons],
    )


def join_prices(combined: DataFrame, priced: DataFrame, sectors: DataFrame) -> DataFrame:
    """Combined volumes with the price columns and the sector of the same date and symbol.

    The sector joins first: prices come from a window per symbol and are already placed by symbol, should
    there be too many symbols to broadcast their sectors.
    """
    return combined.join(priced.join(sectors, "symbol"), ["date", "symbol"])


def analysis_rows(
    combined: DataFrame, prices: DataFrame, sectors: DataFrame, calendar: DataFrame | None = None
) -> DataFrame:
    """One row per date and symbol: sector, ratio and forward returns, by working days if there is a calendar."""
    returns = [f"ret_{n}" for n in RETURN_HORIZONS]
    priced = forward_returns(prices) if calendar is None else working_day_returns(prices, calendar)
    rows = join_prices(short_ratio(combined), priced, sectors)
    return rows.select("date", "symbol", "sector", "ratio", *returns)


def stratified_sample(df: DataFrame, by: str, key: list[str], n: int) -> DataFrame:
    """Exactly ``n`` rows per stratum (all, if it has fewer): those with the smallest hash of their key.

    The rows are worked out once and stored with their hash. A first pass, over two columns, counts the rows of each stratum by
    the leading digits of their hash, of which there are about a million; a running total over them tells up to which
    digits ``n`` rows are found. The second pass reads the rows up to there, about ``n`` and a millionth of the stratum,
    and ranks them. So the plan is the same for every ``n``, only counts and about ``n`` rows move, and no stratum is
    ever in one task.
    """
    hashed = df.withColumn("_hash", F.md5(F.concat_ws("|", *key))).withColumn("_lead", F.substring("_hash", 1, SAMPLE_DIGITS))
    hashed = stored(hashed)
    counts = hashed.groupBy(by, "_lead").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy(by).orderBy("_lead").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    enough = counts.withColumn("_sum", F.sum("_n").over(running)).where(F.col("_sum") >= n)
    cut = stored(enough.groupBy(F.col(by).alias("_by")).agg(F.min("_lead").alias("_cut")))
    # A stratum without a cut has fewer rows; null is a stratum too.
    near = hashed.join(broadcast_if_small(cut), F.col(by).eqNullSafe(F.col("_by")), "left")
    near = near.where(F.col("_cut").isNull() | (F.col("_lead") <= F.col("_cut")))
    rank = F.row_number().over(Window.partitionBy(by).orderBy("_hash", *key))
    return near.withColumn("_rank", rank).where(F.col("_rank") <= n).select(*df.columns)


def approximate_sample(df: DataFrame, by: str, fractions: dict[str, float], seed: int = 1) -> DataFrame:
    """About the given fraction of each stratum, in one pass without a shuffle."""
    return df.sampleBy(by, fractions, seed)


def long_returns(rows: DataFrame) -> DataFrame:
    """One row per horizon that has a return."""
    pairs = [F.struct(F.lit(n).alias("horizon"), F.col(f"ret_{n}").alias("ret")) for n in RETURN_HORIZONS]
    kept = [c for c in rows.columns if not c.startswith("ret_")]
    long = rows.select(*kept, F.explode(F.array(*pairs)).alias("r")).select(*kept, "r.horizon", "r.ret")
    return long.where(F.col("ret").isNotNull())


def middle_band(rows: DataFrame, value: str, by: list[str], low: float = 0.25, high: float = 0.75) -> DataFrame:
    """Rows whose value lies between two quantiles of its group, both included.

    The quantiles are exact and interpolated, for groups of any size (``operators.quantiles``). ``rows`` is read three
    times: store it if it is dear to work out.
    """
    edges = grouped_quantiles(rows, value, by, {"low": low, "high": high})
    edges = stored(edges.select(*[F.col(c).alias(f"_by{k}") for k, c in enumerate(by)], F.col("low").alias("_low"), F.col("high").alias("_high")))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by{k}")) for k, c in enumerate(by)])
    found = rows.join(broadcast_if_small(edges), same)
    return found.where(F.col(value).between(F.col("_low"), F.col("_high"))).select(*rows.columns)


def correlation(df: DataFrame, by: list[str], x: str, ys: list[str], digits: int = 6) -> DataFrame:
    """Correlation of ``x`` with each of ``ys`` per group, with the number of pairs it rests on."""
    columns = []
    for y in ys:
        pairs = F.count_if(F.col(x).isNotNull() & F.col(y).isNotNull())
        columns += [pairs.alias(f"n_{y}"), F.round(F.corr(x, y), digits).alias(f"corr_{y}")]
    return df.groupBy(*by).agg(*columns)


def sector_correlation(rows: DataFrame, per_year: bool = False) -> DataFrame:
    """Correlation of the ratio with each return per sector, or per sector and year."""
    returns = [f"ret_{n}" for n in RETURN_HORIZONS]
    if per_year:
        return correlation(rows.withColumn("year", F.year("date")), ["sector", "year"], "ratio", returns)
    return correlation(rows, ["sector"], "ratio", returns)


def sampled_correlation(rows: DataFrame, n: int = 1000, per_sector_band: bool = True) -> DataFrame:
    """The whole study: ``n`` rows per sector, the middle half of each set of returns, then correlations."""
    sample = long_returns(stored(stratified_sample(rows, "sector", ["date", "symbol"], n)))
    band = middle_band(sample, "ret", ["sector", "horizon"] if per_sector_band else ["horizon"])
    return correlation(band, ["sector", "horizon"], "ratio", ["ret"])
