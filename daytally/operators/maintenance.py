"""Writes and rewrites of tables."""

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daytally.schemas import RAW_COLUMNS
from daytally.sources.tables import table_exists


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which ``predicate`` is not true. Rows where it is null stay."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def delete_report(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows before the delete, rows it takes and rows it leaves, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("n_before"), F.count_if(predicate).alias("n_deleted"),
        (F.count(F.lit(1)) - F.count_if(predicate)).alias("n_after"),
    )


def rewrite_without(spark: SparkSession, source: str, target: str, predicate: Column) -> DataFrame:
    """Write the rows that stay to ``target``, a new place; the source keeps every row until readers move over.

    The report is counted while the rows are written.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("a table cannot be rewritten while it is being read; give a new target")
    seen = Observation()
    taken = F.coalesce(predicate, F.lit(False))
    rows = spark.read.parquet(source).observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(taken).alias("taken"))
    delete_where(rows, predicate).write.mode("overwrite").parquet(target)
    n, gone = seen.get["n"], seen.get["taken"]
    return spark.createDataFrame([(n, gone, n - gone)], "n_before long, n_deleted long, n_after long")


def point_table_at(spark: SparkSession, name: str, path: str) -> None:
    """Move the readers of a catalog table to a rewritten copy, in one metadata change."""
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{quoted}'")
    spark.catalog.refreshTable(name)


def replace_partitions(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Write ``df``, replacing the partitions it has rows for and leaving the others.

    The rebalance hint lets the runtime split a large partition and join small pieces, so files are of
    even size whatever the partition.
    """
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions).parquet(path)
    )


# The characters that Spark writes as percent codes in the names of partition folders.
_CODED = "\"#%'*/:=?\\{[]^"


def clear_partition(spark: SparkSession, path: str, schema: StructType, partition: dict[str, str]) -> None:
    """Leave a partition without rows. Dynamic overwriting does not touch partitions for which there are no new rows."""
    coded = ["".join(f"%{ord(c):02X}" if c in _CODED or ord(c) < 32 else c for c in v) for v in partition.values()]
    folder = "/".join([path.rstrip("/"), *[f"{k}={v}" for k, v in zip(partition, coded, strict=True)]])
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(folder)


# The batch of a daily load; a stream's batches have names of their own.
DAILY = "daily"
STORE_PARTITIONS = ["exchange", "pull_date", "batch"]

# The index of a store: which dates each batch has rows of, per venue. ``stored`` is false for dates that an earlier run
# of the batch had rows of and the last one has not. A row without a date says that a batch is being written (``stored``),
# so that it may have rows of any date, or that it has none.
INDEX_SCHEMA = "exchange string, Date date, stored boolean, pull_date date, batch string"
_BATCH = ["pull_date", "batch"]


def index_path(store: str) -> str:
    return store.rstrip("/") + "_dates"


def read_index(spark: SparkSession, store: str) -> DataFrame | None:
    """The index of a store, or None for a store from before it had one."""
    path = index_path(store)
    return spark.read.schema(INDEX_SCHEMA).parquet(path) if table_exists(spark, path) else None


def _entries(spark: SparkSession, store: str, pull_date: str, batch: str) -> set[tuple]:
    """Venues and dates of a batch, as stored: no more than the venues have calendar days."""
    rows = spark.read.parquet(store).where(
        (F.col("pull_date") == F.lit(pull_date).cast("date")) & (F.col("batch") == F.lit(batch)))
    return {tuple(r) for r in rows.select("exchange", "Date").distinct().collect()}


def _write_entries(spark: SparkSession, store: str, pull_date: str, batch: str, entries: list[tuple]) -> None:
    rows = spark.createDataFrame(entries, "exchange string, Date date, stored boolean").coalesce(1)
    rows = rows.select("*", F.lit(pull_date).cast("date").alias("pull_date"), F.lit(batch).alias("batch"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*_BATCH).parquet(index_path(store))


def _metrics(seen: Observation) -> dict:
    """What was observed; nothing if the plan was known to be empty, which leaves out the observation too."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def build_index(spark: SparkSession, store: str) -> None:
    """Index every stored row: once, for a store from before it had an index."""
    entries = spark.read.parquet(store).select("exchange", "Date", F.lit(True).alias("stored"), *_BATCH).distinct()
    replace_partitions(entries, index_path(store), _BATCH)


def append_batch(rows: DataFrame, path: str, pull_date: str, batch: str = DAILY) -> None:
    """Store a load under ``exchange``, ``pull_date`` and ``batch``, and index the dates it has rows of.

    The same batch of the same day replaces itself, also at venues for which it has no rows any more. The index says
    before the write that the batch may have any date, and after it which dates those are: a run that stops in between
    makes readers look at the whole batch, never past it.
    """
    spark = rows.sparkSession
    index = read_index(spark, path)
    if index is None and table_exists(spark, path):
        build_index(spark, path)
        index = read_index(spark, path)
    former: set[tuple] = set()
    if index is not None:
        own = (F.col("pull_date") == F.lit(pull_date).cast("date")) & (F.col("batch") == F.lit(batch))
        former = {tuple(r) for r in index.where(own).select("exchange", "Date").distinct().collect()} - {(None, None)}
        if index.where(own & F.col("stored") & F.col("Date").isNull()).head(1):
            former |= _entries(spark, path, pull_date, batch) if table_exists(spark, path) else set()
    known = sorted(former, key=repr)
    _write_entries(spark, path, pull_date, batch, [(None, None, True), *[(e, d, False) for e, d in known]])

    named = rows.select(
        "exchange", *RAW_COLUMNS, F.lit(pull_date).cast("date").alias("pull_date"), F.lit(batch).alias("batch"))
    venues = sorted({e for e, _ in known if e is not None})
    seen = Observation()
    counts = [F.count_if(F.col("exchange") == F.lit(v)).alias(f"n{k}") for k, v in enumerate(venues)]
    replace_partitions(named.observe(seen, F.count(F.lit(1)).alias("n"), *counts), path, STORE_PARTITIONS)
    inner = StructType([f for f in named.schema.fields if f.name not in STORE_PARTITIONS])
    counted = _metrics(seen)
    for k, venue in enumerate(venues):
        if not counted.get(f"n{k}"):
            clear_partition(spark, path, inner, {"exchange": venue, "pull_date": pull_date, "batch": batch})
    now = _entries(spark, path, pull_date, batch) if table_exists(spark, path) else set()
    entries = [(e, d, True) for e, d in now] + [(e, d, False) for e, d in former - now]
    _write_entries(spark, path, pull_date, batch, sorted(entries, key=repr) or [(None, None, False)])


def overwrite_parquet(df: DataFrame, path: str) -> None:
    df.hint("rebalance").write.mode("overwrite").parquet(path)


def overwrite_csv(df: DataFrame, path: str) -> None:
    """A directory of CSV files, each with a header."""
    df.write.mode("overwrite").csv(path, header=True)


def append_csv(df: DataFrame, path: str) -> None:
    """Add CSV files to a directory. Columns are stored by position, so select them first."""
    df.write.mode("append").csv(path, header=True)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def publish_csv_days(combined: DataFrame, path: str, rows_per_file: int = 1_000_000, days: list | None = None) -> None:
    """Publish days of the combined table, each in a folder of CSV files of its own, and leave all other days.

    Of ``days``, those without rows are left without files but for one that has the header alone.
    """
    (
        combined.withColumn("day", F.col("date")).hint("rebalance", "day").sortWithinPartitions("day", "symbol")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file)
        .partitionBy("day").csv(path, header=True)
    )
    if days:
        found = {r["date"] for r in combined.select("date").distinct().collect()}
        for day in [d for d in days if d not in found]:
            combined.limit(0).write.mode("overwrite").csv(f"{path.rstrip('/')}/day={day}", header=True)


def publish_csv(combined: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Publish the combined table as CSV files in date order, each with a header and of bounded size.

    The rows are spread by ranges of date and symbol, so no task holds the whole table.
    """
    (
        combined.repartitionByRange("date", "symbol").sortWithinPartitions("date", "symbol")
        .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).csv(path, header=True)
    )


def compact(spark: SparkSession, source: str, target: str, partitions: list[str]) -> None:
    """Rewrite a table of many small files into files of even size at a new place."""
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("a table cannot be compacted onto itself; give a new target")
    spark.read.parquet(source).hint("rebalance", *partitions).write.mode("overwrite").partitionBy(*partitions).parquet(target)
