"""CSV tables: directories of part files, each with a header line.

The reader matches columns by position and, when it prunes columns, accepts lines with too few or too
many fields. So every scan here declares the order found in the header and switches pruning off.
CSV is read once, on landing; everything after reads Parquet.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.functions import fits
from daytally.schemas import RAW_TYPES

BAD_LINE = "_corrupt_record"


def read_csv_text(spark: SparkSession, path: str, trim: bool = False, infer: bool = False) -> DataFrame:
    """All columns named by the header, as text or, at the price of another pass, with guessed types."""
    return spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=trim, inferSchema=infer)


def read_csv_layout(
    spark: SparkSession, path: str, types: dict[str, T.DataType] = RAW_TYPES, trim: bool = False
) -> DataFrame:
    """Typed scan of one directory whose files share a column order.

    Lines that do not fit the header or the types keep their text in ``_corrupt_record``; names that
    ``types`` does not know are read as text.
    """
    header = spark.read.csv(path, header=True).columns
    fields = [T.StructField(name, types.get(name, T.StringType())) for name in header]
    schema = T.StructType([*fields, T.StructField(BAD_LINE, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .option("columnPruning", False)
        .option("enforceSchema", False)
        .option("ignoreLeadingWhiteSpace", trim)
        .csv(path)
    )


def union_layouts(spark: SparkSession, paths: dict[str, str], types: dict[str, T.DataType] = RAW_TYPES) -> DataFrame:
    """Bag union of one directory per venue, matched by column name, with the venue as a column."""
    parts = [read_csv_layout(spark, path, types).withColumn("exchange", F.lit(venue)) for venue, path in paths.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def split_bad_rows(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the text of the bad lines. Land the scan in Parquet first if both are needed.

    A line is bad if it does not fit the header or the types, or holds a number that is not finite, too large or too
    fine to be summed exactly. Such a line parsed, so its text is put together again from its values.
    """
    numbers = [f.name for f in landed.schema if isinstance(f.dataType, T.DoubleType)]
    wrong = reduce(lambda a, b: a | b, [~F.coalesce(fits(F.col(c)), F.lit(True)) for c in numbers], F.lit(False))
    text = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in landed.columns if c not in (BAD_LINE, "exchange")])
    is_bad = F.col(BAD_LINE).isNotNull() | wrong
    good = landed.where(~is_bad).drop(BAD_LINE)
    venue = [c for c in ("exchange",) if c in landed.columns]
    return good, landed.where(is_bad).select(*venue, F.coalesce(BAD_LINE, text).alias("line"))
