import hashlib
import random
import re
import statistics
from types import SimpleNamespace

import numpy as np
import pytest
from helpers import day, tuples
from pyspark.sql import functions as F

from daytally.operators import analysis as a
from daytally.operators import counting, quantiles
from daytally.session import cut_lineage


def _prices(spark, *closes, symbol="A"):
    return spark.createDataFrame([(day(f"2020-01-{i + 1:02d}"), symbol, float(c)) for i, c in enumerate(closes)],
                                 "date date, symbol string, close double")


def test_forward_returns(spark):
    returns = a.forward_returns(_prices(spark, 100, 110, 99), (1, 5))
    rows = tuples(returns, "ret_1", "ret_5")
    assert rows == [(None, None), (pytest.approx(-0.1), None), (pytest.approx(0.1), None)]


def test_returns_stay_within_a_symbol_and_survive_a_zero_price(spark):
    both = _prices(spark, 100, 50).unionByName(_prices(spark, 0, 10, symbol="B"))
    assert tuples(a.forward_returns(both, (1,)), "symbol", "ret_1") == [("A", None), ("A", -0.5), ("B", None), ("B", None)]


def _strata(spark, sizes):
    rows = [(s, f"k{i}") for s, n in sizes.items() for i in range(n)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "sector string, symbol string").withColumn("date", F.lit("2020-01-01")).repartition(8)


@pytest.mark.parametrize("parts", [1, 8, 50])
def test_sample_is_exact_whatever_the_partitions(spark, parts):
    rows = _strata(spark, {"hot": 3000, "cold": 40, "rare": 3}).repartition(parts)
    sample = a.stratified_sample(rows, "sector", ["date", "symbol"], 25)
    assert sample.columns == rows.columns
    expected = {}
    for sector, n in (("hot", 3000), ("cold", 40), ("rare", 3)):
        keys = sorted((f"k{i}" for i in range(n)), key=lambda k: hashlib.md5(f"2020-01-01|{k}".encode()).hexdigest())
        expected[sector] = set(keys[:25])
    found = {}
    for sector, symbol, *_ in sample.collect():
        found.setdefault(sector, set()).add(symbol)
    assert found == expected


def test_the_plan_of_a_sample_is_the_same_for_every_size(spark):
    rows = _strata(spark, {"hot": 3000, "cold": 40})
    shapes = set()
    for n in (10, 1000, 1001, 50_000):
        plan = a.stratified_sample(rows, "sector", ["symbol"], n)._jdf.queryExecution().executedPlan().toString()
        lines = [re.sub(r"[#\[(].*", "", line).strip(" +-:") for line in plan.splitlines()]
        # Besides the fixture's own, one shuffle, of the rows that are left.
        shapes.add(tuple(line for line in lines if line and not line.startswith(("WindowGroupLimit", "Sort"))))
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
        below = plan[plan.index("Exchange hashpartitioning"):]
        assert re.search(r"Filter .*_cut", below)
    assert len(shapes) == 1


def test_only_the_rows_up_to_the_cut_are_ranked(spark):
    rows = spark.range(100_000).select(F.lit("s").alias("sector"), F.col("id").cast("string").alias("symbol"))
    sample = a.stratified_sample(rows, "sector", ["symbol"], 2000)
    assert sample.count() == 2000
    wanted = sorted((hashlib.md5(str(i).encode()).hexdigest(), str(i)) for i in range(100_000))[:2000]
    assert {r["symbol"] for r in sample.collect()} == {k for _, k in wanted}


def test_null_is_a_stratum(spark):
    rows = spark.createDataFrame([(None, f"k{i}") for i in range(50)] + [("a", "x")], "sector string, symbol string")
    assert a.stratified_sample(rows, "sector", ["symbol"], 7).groupBy("sector").count().orderBy("sector").collect() == [(None, 7), ("a", 1)]


def test_quantiles_of_groups_of_any_size_equal_the_percentile(spark, monkeypatch):
    """Sketches so coarse that the values between the brackets have to decide; ties, outliers, null groups, tiny groups."""
    monkeypatch.setattr(quantiles, "ACCURACY", 50)
    ids = spark.range(60_000)
    rows = ids.select(
        F.when(F.col("id") < 20_000, "hot").when(F.col("id") < 40_000, "ties").when(F.col("id") < 40_003, "tiny")
        .when(F.col("id") < 50_000, F.lit(None)).otherwise("far").alias("sector"),
        F.when(F.col("id") < 20_000, F.xxhash64("id") / 1e9).when(F.col("id") < 40_000, F.col("id") % 3)
        .when(F.col("id") < 50_000, F.rand(5)).when(F.col("id") % 100 == 0, 1e300).otherwise(-F.col("id") / 7.0).cast("double").alias("v"),
    ).unionByName(spark.createDataFrame([("empty", None), ("one", 1.5)], "sector string, v double"))
    wanted = {"low": 0.25, "mid": 0.5, "high": 0.9}
    found = quantiles.grouped_quantiles(rows, "v", ["sector"], wanted)
    exact = rows.where("v IS NOT NULL").groupBy("sector").agg(*[F.percentile("v", p).alias(n) for n, p in wanted.items()])
    assert [r["sector"] for r in exact.collect() if r["sector"] == "empty"] == []
    for got, want in zip(tuples(found, "sector", *wanted), tuples(exact, "sector", *wanted), strict=True):
        assert got[0] == want[0] and got[1:] == pytest.approx(want[1:], rel=1e-12)
    assert found.count() == 6


def test_a_band_has_no_largest_group(spark):
    rows = spark.range(100_001).select(F.lit("x").alias("sector"), F.col("id").cast("double").alias("ret"))
    band = a.middle_band(rows, "ret", ["sector"]).agg(F.min("ret"), F.max("ret"), F.count("*")).first()
    assert tuple(band) == (25_000.0, 75_000.0, 50_001)


def test_working_days_are_numbered_and_missing_ones_have_no_return(spark):
    prices = spark.createDataFrame(
        [("A", "2020-01-02", 100.0), ("A", "2020-01-03", 110.0), ("A", "2020-01-07", 121.0),
         ("B", "2020-01-02", 10.0), ("B", "2020-01-06", 20.0), ("B", "2020-01-07", 40.0)], "symbol string, date string, close double")
    prices = prices.withColumn("date", F.col("date").cast("date"))
    calendar = a.trading_calendar(prices)
    assert tuples(calendar, "number", "date") == [(k, day(d)) for k, d in enumerate(["2020-01-02", "2020-01-03", "2020-01-06", "2020-01-07"])]
    rows = tuples(a.working_day_returns(prices, calendar, (1, 2, 3)), "symbol", "date", "ret_1", "ret_2", "ret_3")
    assert [(s, str(d)[-2:], *[None if v is None else round(v, 6) for v in r]) for s, d, *r in rows] == [
        ("A", "02", 0.1, None, 0.21), ("A", "03", None, 0.1, None), ("A", "07", None, None, None),
        ("B", "02", None, 1.0, 3.0), ("B", "06", 1.0, None, None), ("B", "07", None, None, None)]
    assert a.trading_calendar(prices.limit(0)).count() == 0


def test_approximate_sample(spark):
    rows = _strata(spark, {"hot": 3000, "cold": 400})
    sample = a.approximate_sample(rows, "sector", {"hot": 0.1, "cold": 1.0})
    counts = {r["sector"]: r["count"] for r in sample.groupBy("sector").count().collect()}
    assert counts["cold"] == 400 and 200 < counts["hot"] < 400


def test_middle_band(spark):
    rows = spark.createDataFrame([("x", float(v)) for v in range(1, 10)] + [("y", 5.0)], "sector string, ret double")
    assert tuples(a.middle_band(rows, "ret", ["sector"]), "sector", "ret") == [("x", v) for v in (3.0, 4.0, 5.0, 6.0, 7.0)] + [("y", 5.0)]


def test_correlation(spark):
    rng = np.random.default_rng(3)
    x, noise = rng.normal(size=200), rng.normal(size=200)
    frame = spark.createDataFrame([("s", float(u), float(u + v)) for u, v in zip(x, noise)] + [("s", None, 1.0)],
                                  "sector string, ratio double, ret double")
    row = a.correlation(frame, ["sector"], "ratio", ["ret"]).first()
    assert row["n_ret"] == 200
    assert row["corr_ret"] == pytest.approx(np.corrcoef(x, x + noise)[0, 1], abs=1e-6)


def test_profile_against_brute_force(spark):
    rng = random.Random(5)
    wide = [round(rng.expovariate(1e-4), 2) for _ in range(900)] + [9e9, -3.25]
    few = [rng.choice([0.0, 0.5, 7.25]) for _ in range(900)] + [None, None]
    frame = spark.createDataFrame(list(zip(wide, few)), "wide double, few double").repartition(5)
    found = {r["column"]: r for r in counting.profile(frame, ["wide", "few"]).collect()}
    for name, values in (("wide", wide), ("few", [v for v in few if v is not None])):
        row = found[name]
        assert (row["n"], row["min"], row["max"]) == (len(values), min(values), max(values))
        assert row["mean"] == pytest.approx(statistics.fmean(values))
        assert row["std"] == pytest.approx(statistics.stdev(values), abs=1e-3)
        assert [row[q] for q in ("q25", "q50", "q75")] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))


def test_an_outlier_does_not_gather_the_values_in_one_task(spark):
    from daytally.operators import quantiles

    rows = spark.range(200_000).select((F.col("id") / 4).alias("v")).unionByName(spark.range(1).select(F.lit(1e14).alias("v")))
    edges = rows.agg(quantiles.brackets("v", counting.QUARTILES)).first()[0]
    for k, p in enumerate(counting.QUARTILES.values()):
        low, high = edges[2 * k:2 * k + 2]
        # The rows ordered for a quartile: 4 / ACCURACY of all, here 80, with as much again for the sketch's error.
        assert rows.where((F.col("v") >= low) & (F.col("v") <= high)).count() <= 8 * 200_001 / quantiles.ACCURACY
    row = counting.profile(rows, ["v"]).first()
    values = np.append(np.arange(200_000) / 4, 1e14)
    assert [row[q] for q in counting.QUARTILES] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])), rel=1e-12)


def test_profile_of_all_small_sizes(spark):
    for n in range(1, 14):
        values = [float((7 * i) % n) for i in range(n)]
        row = counting.profile(spark.createDataFrame([(v,) for v in values], "v double"), ["v"]).first()
        assert [row[q] for q in counting.QUARTILES] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))


def test_profile_of_one_value_and_of_none(spark):
    frame = spark.createDataFrame([(4.5, None)], "a double, b double")
    found = {r["column"]: r for r in counting.profile(frame, ["a", "b"]).collect()}
    assert (found["a"]["q25"], found["a"]["q75"], found["a"]["std"]) == (4.5, 4.5, None)
    assert (found["b"]["n"], found["b"]["q50"]) == (0, None)


def test_counts(spark):
    frame = spark.createDataFrame([("A_1",), ("A_1",), ("B",), (None,)], "s string")
    assert tuples(counting.row_count(frame), "*") == [(4,)]
    assert tuples(counting.count_matching(frame, F.col("s").contains("_"), "s"), "*") == [(4, 2, 1)]


def test_approximate_count_is_repeatable_and_exact_for_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100_000).repartition(40).write.parquet(path)
    assert tuples(counting.row_count_approx(spark, path), "*") == [(100_000, 40, 40, True)]
    some = counting.row_count_approx(spark, path, files=10)
    assert tuples(some, "*") == tuples(counting.row_count_approx(spark, path, files=10), "*")
    row = some.first()
    assert abs(row["n_rows"] - 100_000) < 5000 and (row["n_files"], row["exact"]) == (10, False)
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    assert counting.row_count_approx(spark, str(tmp_path / "empty")).first()["n_rows"] == 0


@pytest.mark.parametrize(("unequal", "short_by"), [(0.5, 0.04), (1.0, 0.07)])
def test_intervals_cover_as_often_as_asked(unequal, short_by):
    """Files of unequal size, with rows per byte that differ and lean on the size. Very unequal ones are covered a little less."""
    rng = np.random.default_rng(8)
    sizes = np.exp(rng.normal(12, unequal, 400)).astype(int)
    rows = (sizes / 40 * np.exp(rng.normal(0, 0.2, 400)) + 200).astype(int)
    for confidence in (0.8, 0.95):
        covered, width = 0, []
        for _ in range(1000):
            at = rng.choice(400, 40, replace=False)
            middle, low, high = counting.ratio_interval(list(zip(rows[at].tolist(), sizes[at].tolist())), 400, int(sizes.sum()), confidence)
            covered += low <= rows.sum() <= high
            width.append(high - low)
            assert low <= middle <= high
        assert confidence - short_by < covered / 1000 < confidence + 0.04
        assert np.mean(width) < 0.3 * rows.sum()


def test_student_quantiles():
    for confidence, freedom, wanted in ((0.95, 10, 2.228), (0.95, 30, 2.042), (0.99, 20, 2.845), (0.8, 63, 1.295)):
        assert counting._student(confidence, freedom) == pytest.approx(wanted, abs=0.003)


def test_count_with_an_interval(spark, tmp_path):
    path = str(tmp_path / "t:a b")
    table = spark.range(30_000).select("id", F.floor(F.sqrt("id") / 3).cast("int").alias("part"))
    table.repartition(4).write.partitionBy("part").parquet(path)
    exact = counting.row_count_interval(spark, path, files=1000).first()
    assert tuple(exact) == (30_000, 30_000, 30_000, exact["all_files"], exact["all_files"], True)
    some = counting.row_count_interval(spark, path, files=40).first()
    assert some["low"] <= some["n_rows"] <= some["high"] < 60_000 and not some["exact"] and some["n_files"] == 40
    assert some["low"] < 30_000 * 1.3 and some["high"] > 30_000 * 0.7
    narrow = counting.row_count_interval(spark, path, files=40, confidence=0.5).first()
    assert narrow["high"] - narrow["low"] < some["high"] - some["low"]
    with pytest.raises(ValueError, match="at least two"):
        counting.row_count_interval(spark, path, files=1)


@pytest.mark.parametrize("parts", [1, 7])
def test_tail_and_top(spark, parts):
    frame = spark.range(100).select("id", (F.col("id") % 10).alias("k")).repartition(parts)
    assert [(r["id"], r["k"]) for r in counting.tail_rows(frame, ["k"], 3).collect()] == [(99, 9), (89, 9), (79, 9)]
    top = counting.top_rows(spark.range(100), [F.desc("id")], 2)
    assert [r["id"] for r in top.collect()] == [99, 98]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_study_gives_the_same_correlations_as_its_parts(spark):
    from daytally.operators.venues import combine
    from daytally.plans.daily import study
    from daytally.sources import market_views as views

    folder = "/root/testdata/sf0.001"
    tables = combine(views.short_interests(spark, folder)), views.prices(spark, folder), views.sectors(spark, folder)
    results = study(*tables)
    rows = a.analysis_rows(*tables)
    assert tuples(results["by_sector"], "*") == tuples(a.sector_correlation(rows), "*")
    assert tuples(results["by_sector_and_year"], "*") == tuples(a.sector_correlation(rows, per_year=True), "*")
    assert tuples(results["sampled"], "*") == tuples(a.sampled_correlation(rows), "*")
    assert "Scan ExistingRDD" in results["by_sector"]._jdf.queryExecution().executedPlan().toString()


def test_checkpoints_go_to_the_folder_of_the_session(spark, tmp_path):
    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    assert cut_lineage(spark.range(3)).count() == 3
    assert list(tmp_path.rglob("rdd-*"))
    if before:
        spark.sparkContext.setCheckpointDir(before.removeprefix("file:"))


def test_a_cluster_without_a_shared_checkpoint_folder_is_refused():
    class Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(dict)

    session = SimpleNamespace(sparkContext=Context, conf={})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        cut_lineage(SimpleNamespace(sparkSession=session))
