"""Tables that exist already."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Spark's error conditions for a missing path and for a directory without data files.
ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether ``path`` holds a readable table. Looks at file names and one footer, not at rows."""
    try:
        reader = spark.read.format(fmt)
        columns = (reader.option("header", True) if fmt == "csv" else reader).load(path).columns
    except AnalysisException as error:
        if error.getCondition() in ABSENT:
            return False
        raise
    return len(columns) > 0


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def sql_view(df: DataFrame, name: str, statement: str) -> DataFrame:
    """Run SQL text over ``df`` under the given view name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(statement)
