"""What has to hold for large tables: no cross joins, map-side combining, no hot group in one task."""

import re

import pytest
from pyspark.sql import functions as F

from daytally.operators import ingest, quality, venues
from daytally.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_global_window_no_python(spark, name):
    plan = _plan(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "SerializeFromObject"):
        assert bad not in plan
    assert not re.search(r"Window \[.*\], \[\], \[", plan)


def _hot(spark):
    """One key holds a third of all rows, all different; another third are copies of one row."""
    ids = spark.range(30_000)
    hot, copies = F.col("id") < 10_000, F.col("id") < 20_000
    return ids.select(
        F.lit("NYSE").alias("exchange"),
        F.when(copies, F.lit("2020-01-01")).otherwise(F.lit("2020-01-02")).cast("date").alias("Date"),
        (F.col("id") % 7).cast("double").alias("ShortExemptVolume"),
        F.when(hot, F.col("id")).otherwise(1).cast("double").alias("ShortVolume"),
        F.lit("u").alias("SourceURL"),
        F.when(hot, "HOT").when(copies, "COPY").otherwise(F.concat(F.lit("S"), "id")).alias("Symbol"),
        F.when(hot, F.col("id") % 100).otherwise(5).cast("double").alias("TotalVolume"),
    ).repartition(8)




def test_a_hot_key_is_right_and_combined_before_the_shuffle(spark):
    rows = _hot(spark)
    combined = {r["symbol"]: r for r in venues.combine(rows).where("symbol IN ('HOT', 'COPY')").collect()}
    assert (combined["HOT"]["total_volume"], combined["HOT"]["short_volume"]) == (99.0, 9999.0)
    assert combined["COPY"]["short_volume"] == 1.0
    assert venues.combine(rows).count() == 10_002
    for result in (venues.combine(rows), venues.dedupe(rows), ingest.last_dates(rows), quality.latest_rows(rows, ["Symbol"])):
        plan = _plan(result)
        below = plan[plan.index("Exchange hashpartitioning"):]
        assert re.search(r"partial_max\(", below)


def test_combine_shuffles_once(spark):
    plan = _plan(QUERIES["combine"](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") == 1


def test_raw_volumes_are_summed_as_longs_by_hash(spark):
    plan = _plan(QUERIES["combine_raw"](spark, SF_DIR))
    assert "SortAggregate" not in plan and "as bigint" in plan


def test_only_needed_columns_are_read(spark):
    plan = _plan(QUERIES["last_dates"](spark, SF_DIR))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["l_shipdate", "l_suppkey"]


def test_documents_are_bounded(spark):
    from daytally.sources import market_views
    biggest = market_views.documents(spark, SF_DIR).select(
        F.max(F.size(F.from_json("body", "dataset struct<data array<array<string>>>")["dataset"]["data"]))
    ).first()[0]
    assert 1 < biggest <= market_views.ROWS_PER_DOCUMENT
