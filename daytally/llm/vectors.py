"""What operators on vectors share: sound vectors as whole numbers, and their rows as matrices."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_sound(vector: Column) -> Column:
    """Whether a vector is there and every entry is a finite number. An empty vector is sound."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    return F.coalesce(F.forall(vector, lambda c: F.coalesce(entry(c.cast("double")), F.lit(False))), F.lit(False))


def scaled(vector: Column, factor: int, limit: int) -> Column:
    """Each entry times ``factor``, rounded down, as long; beyond ``limit`` on either side it is that limit."""
    def whole(c: Column) -> Column:
        product = c.cast("double") * F.lit(float(factor))
        return F.floor(F.least(F.greatest(product, F.lit(-float(limit))), F.lit(float(limit))))
    return F.transform(vector, whole)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column of whole numbers, all of one width and none null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = pc.list_flatten(column)
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), width)


def list_column(rows: np.ndarray) -> pa.ListArray:
    """A matrix as a list column."""
    count, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (count + 1) * width, width, dtype=np.int32)), pa.array(rows.reshape(-1)))


def summed(parts: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Element by element, the sum of the arrays of each key. Each task has few rows for a key."""
    long = parts.select(*keys, F.posexplode(column).alias("at", "v"))
    return long.groupBy(*keys, "at").agg(F.sum("v").alias("v"))


def slabs(batches: Iterator[pa.RecordBatch], rows: int = 8192) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, without empty ones."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
