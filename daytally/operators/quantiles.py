"""Exact quantiles of large columns.

The built-in exact percentile keeps all distinct values of a group in one task. Here a first pass takes approximate
quantiles, which are small sketches that merge, on both sides of every wanted one. The true quantile lies between
the two, whatever outliers there are, because they are cut by rank and not by value. A second pass counts the
rows below the pair and the rows of each value between them; that is a share of ``4 / ACCURACY`` of the distinct
values per wanted quantile, plus whatever ties there are, which count as one row. Ranks are then found by running
totals over these few values.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally.operators.sizes import broadcast_if_small
from daytally.session import stored

# Approximate quantiles are off by one part in so many of the rows at most.
ACCURACY = 10_000


def brackets(column: str, probabilities: dict[str, float]) -> Column:
    """Aggregate: for each probability, a value at or below its quantile and one at or above, about."""
    value, step = F.col(column), 2.0 / ACCURACY
    edges = [min(max(p + side, 0.0), 1.0) for p in probabilities.values() for side in (-step, step)]
    return F.percentile_approx(value, edges, ACCURACY)


def order_statistics(df: DataFrame, edges: dict[str, list[float]], probabilities: dict[str, float]) -> DataFrame:
    """Quantiles per column, interpolated between neighbouring ranks, one output column per probability.

    ``edges`` holds what :func:`brackets` found for each column that has values.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(name).alias("target"), F.lit(float(p)).alias("p"),
                 F.col(c).cast("double").alias("v"), F.lit(float(found[2 * k])).alias("low"),
                 F.lit(float(found[2 * k + 1])).alias("high"))
        for c, found in edges.items() for k, (name, p) in enumerate(probabilities.items())
    ])
    long = df.select(F.explode(pairs).alias("x")).select("x.*").where("v IS NOT NULL")
    return _by_rank(long, ["column"], probabilities)


def grouped_quantiles(df: DataFrame, value: str, by: list[str], probabilities: dict[str, float]) -> DataFrame:
    """Quantiles of a column in each group, interpolated between neighbouring ranks: ``by`` and one column per probability.

    Groups may be of any size and number; null is a group too. A group without values has no row. Values must not be NaN or
    infinite. One row per group is stored: its sketched brackets, which each row of the group then meets.
    """
    keys = [f"_g{k}" for k in range(len(by))]
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(value).cast("double").alias("v"))
    rows = rows.where("v IS NOT NULL")
    found = stored(rows.groupBy(*keys).agg(brackets("v", probabilities).alias("_edges")))
    found = found.withColumnsRenamed({k: f"{k}_of" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}_of")) for k in keys])
    targets = F.array(*[
        F.struct(F.lit(name).alias("target"), F.lit(float(p)).alias("p"), F.col("_edges")[2 * k].alias("low"),
                 F.col("_edges")[2 * k + 1].alias("high"))
        for k, (name, p) in enumerate(probabilities.items())
    ])
    long = rows.join(broadcast_if_small(found), same).select(*keys, "v", F.explode(targets).alias("x")).select(*keys, "v", "x.*")
    quantiles = _by_rank(long, keys, probabilities)
    return quantiles.select(*[F.col(k).alias(c) for c, k in zip(by, keys, strict=True)], *probabilities)


def _by_rank(long: DataFrame, keys: list[str], probabilities: dict[str, float]) -> DataFrame:
    """Quantiles per group from its values ``v``, once for each ``target`` with its bracket ``low`` to ``high``.

    What lies outside the bracket is counted, which combines before the shuffle; only the distinct values inside it are
    put in order.
    """
    side = F.when(F.col("v") < F.col("low"), -1).when(F.col("v") > F.col("high"), 1).otherwise(0)
    inside = F.when(side == 0, F.col("v"))
    counts = long.groupBy(*keys, "target", "p", side.alias("side"), inside.alias("inside")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("first"), F.max("v").alias("last"))

    within = Window.partitionBy(*keys, "target")
    running = within.orderBy("side", "inside").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = counts.withColumn("total", F.sum("n").over(within)).withColumn("end", F.sum("n").over(running))
    place = (F.col("total") - 1) * F.col("p")

    def at(rank: Column) -> Column:
        """The value of a rank, from the group that holds it; a rank beside the pair must be its neighbour."""
        holds = (F.col("end") - F.col("n") <= rank) & (rank < F.col("end"))
        beyond = F.raise_error(F.lit("a quantile lies outside its approximation")).cast("double")
        value = (
            F.when(F.col("side") == 0, F.col("inside"))
            .when((F.col("side") < 0) & (rank == F.col("end") - 1), F.col("last"))
            .when((F.col("side") > 0) & (rank == F.col("end") - F.col("n")), F.col("first")).otherwise(beyond))
        return F.max(F.when(holds, value))

    found = ordered.groupBy(*keys, "target").agg(
        at(F.floor(place)).alias("a"), at(F.ceil(place)).alias("b"), F.max(place - F.floor(place)).alias("part"))
    value = F.col("a") + (F.col("b") - F.col("a")) * F.col("part")
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("target") == name, value)).alias(name) for name in probabilities])
