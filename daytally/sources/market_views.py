"""The test tables seen as market tables: line items are venue days, orders are trades."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions import exact_sum, iso_text, normalize_symbol
from daytally.operators.sizes import broadcast_if_small

SOURCE_URL = "https://data.example.org/api/v3/datasets/"
# Customers come fifteen to a supplier, which gives every symbol its share of the orders.
CUSTOMERS_PER_SYMBOL = 15
ROWS_PER_DOCUMENT = 65_536


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def venue_of(status: Column) -> Column:
    return F.when(status == "O", "NASDAQ").otherwise("NYSE")


def _raw_columns(*extra: Column) -> list[Column]:
    return [
        F.to_date("l_shipdate").alias("Date"),
        F.col("l_discount").alias("ShortExemptVolume"),
        F.col("l_quantity").alias("ShortVolume"),
        F.lit(SOURCE_URL).alias("SourceURL"),
        *extra,
        F.col("l_extendedprice").alias("TotalVolume"),
    ]


def dotted_symbol(key: str) -> Column:
    return F.concat(F.lit("S."), F.col(key).cast("string"))


def short_interests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both venues in one table."""
    symbol = normalize_symbol(dotted_symbol("l_suppkey")).alias("Symbol")
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.select(venue_of(F.col("l_linestatus")).alias("exchange"), *_raw_columns(symbol))


def venue_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """One table per venue, without a venue column. The status is never null."""
    symbol = normalize_symbol(dotted_symbol("l_suppkey")).alias("Symbol")
    lineitem = table(spark, sf_dir, "lineitem")
    listed = F.col("l_linestatus") == "O"
    return {
        "NASDAQ": lineitem.where(listed).select(*_raw_columns(symbol)),
        "NYSE": lineitem.where(~listed).select(*_raw_columns(symbol)),
    }


def text_short_interests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as a CSV scan would give them: every column text."""
    rows = short_interests(spark, sf_dir)
    return rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])


def documents(spark: SparkSession, sf_dir: str, faulty: bool = False) -> DataFrame:
    """Source documents of at most 65,536 rows each, newest row first.

    With faults, rows are spoiled by their exempt volume: 0.01 by a date in another form, 0.02 by a volume that is no
    number, 0.03 by one that is too large, 0.04 by one too fine, 0.05 by a missing volume, which is no fault.

    Pages are cut by position inside each scan task, so a symbol with very many rows gets many documents
    and no group grows with the data.
    """
    keys = ["page", "exchange", "Symbol"]
    page = F.floor(F.monotonically_increasing_id() / ROWS_PER_DOCUMENT)
    # Collecting text does not shrink it, so the rows move first and the text is made after.
    rows = short_interests(spark, sf_dir).withColumn("page", page).repartition(*keys)
    date, short = iso_text(F.col("Date")), F.col("ShortVolume").cast("string")
    if faulty:
        exempt = F.col("ShortExemptVolume")
        date = F.when(exempt == 0.01, F.date_format("Date", "dd.MM.yyyy")).otherwise(date)
        short = (F.when(exempt == 0.02, '"abc"').when(exempt == 0.03, "1e17").when(exempt == 0.04, "0.00000015")
                 .when(exempt == 0.05, "null").otherwise(short))
    cells = F.concat(
        F.lit('["'), date, F.lit('",'), short, F.lit(","),
        F.col("ShortExemptVolume").cast("string"), F.lit(","), F.col("TotalVolume").cast("string"), F.lit("]"),
    )
    pages = rows.groupBy(*keys).agg(
        F.sort_array(F.collect_list(cells), asc=False).alias("cells"), F.max("Date").alias("newest")
    )
    body = F.concat(
        F.lit('{"dataset":{"column_names":["Date","ShortVolume","ShortExemptVolume","TotalVolume"],"data":['),
        F.array_join("cells", ","),
        F.lit('],"newest_available_date":"'), iso_text(F.col("newest")), F.lit('"}}'),
    )
    return pages.select("exchange", "Symbol", F.lit(SOURCE_URL + "?api_key=secret").alias("SourceURL"), body.alias("body"))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closing price per date and symbol."""
    symbol = F.concat(F.lit("S_"), F.floor(F.col("o_custkey") / CUSTOMERS_PER_SYMBOL).cast("string"))
    orders = table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("date"), symbol.alias("symbol"), F.col("o_totalprice").alias("price")
    )
    return orders.groupBy("date", "symbol").agg(exact_sum(F.col("price")).alias("close"))


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sector per symbol: as many rows as there are suppliers, which decides on the broadcast."""
    supplier = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    region = table(spark, sf_dir, "region")
    placed = supplier.join(nation, "n_nationkey").join(region, "r_regionkey")
    symbol = F.concat(F.lit("S_"), F.col("s_suppkey").cast("string")).alias("symbol")
    return broadcast_if_small(placed.select(symbol, F.col("r_name").alias("sector")), bounded_by=supplier)


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A venue listing as downloaded, with its bad header, brackets and surplus column."""
    return table(spark, sf_dir, "part").select(
        dotted_symbol("p_partkey").alias("Symbol"),
        F.col("p_retailprice").cast("decimal(18,2)").cast("string").alias("MarketCap"),
        F.col("p_type").alias("Sector"), F.col("p_brand").alias("industry"),
        F.concat(F.lit("["), F.col("p_name"), F.lit("]")).alias("Summary Quote"),
        F.lit(None).cast("string").alias("_c8"),
    )
