"""Broadcast decisions that rest on a measured size."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of a broadcast, as measured from the rows' text forms; in memory a few times that.
BROADCAST_BYTES = 32_000_000
# Bytes a row costs beside its values.
ROW_BYTES = 16


def measured_bytes(df: DataFrame) -> int:
    """About the size of all rows. Each task sends two longs, whatever the number of rows."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(ROW_BYTES))
    return df.agg(F.sum(width)).first()[0] or 0


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES, bounded_by: DataFrame | None = None) -> DataFrame:
    """Mark a dimension for broadcast if it has no more than ``max_bytes``; else leave the join to Spark.

    Measuring runs a job over ``df``, or over ``bounded_by`` if that is a cheaper table whose rows are as many and
    as long. Spark's own estimate multiplies the sizes of joined tables, so it takes a joined dimension
    for the larger side, and it takes long text for short.
    """
    return F.broadcast(df) if measured_bytes(df if bounded_by is None else bounded_by) <= max_bytes else df
