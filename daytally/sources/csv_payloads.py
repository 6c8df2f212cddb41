"""CSV held in a column: records that end where a line ends outside quotes, and rejects with their reasons.

Whether a place is inside quotes is told by the number of quotes before it. Splitting at the quotes gives the pieces
outside (even) and inside (odd) in turn, for which a payload is read a fixed number of times, whatever its length. A doubled quote
inside quotes is an empty piece outside, and changes nothing.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Inside quotes, line ends are written as a mark and a letter while records are split; the mark itself as well.
_MARK = "\x01"
_CODES = (("\n", "n"), ("\r", "r"))
# Quotes are doubled inside quotes, a backslash is a character like others, and a missing value is told from a
# quoted empty text by standing for something that no text is.
_OPTIONS = {"nullValue": "\x00\x01\x00", "emptyValue": "", "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}


def _pieces(text: Column) -> Column:
    return F.split(text, '"', -1)


def csv_records(df: DataFrame, payload: str, *keep: str) -> DataFrame:
    """Records of a UTF-8 payload, numbered from 0 (the header), with ``keep``; ``record_no`` and ``record``.

    Records without characters are left out and keep their number; bytes that are no UTF-8 become U+FFFD. A quote that is never closed takes all that follows into
    its record, which is then a reject.
    """
    text = F.replace(F.make_valid_utf8(F.col(payload).cast("string")), F.lit(_MARK), F.lit(_MARK + "a"))

    def coded(piece: Column, at: Column) -> Column:
        inside = piece
        for end, code in _CODES:
            inside = F.replace(inside, F.lit(end), F.lit(_MARK + code))
        return F.when(at % 2 == 1, inside).otherwise(piece)

    lines = F.split(F.array_join(F.transform(_pieces(text), coded), '"'), r"\r\n|\n|\r", -1)
    found = df.select(*keep, F.posexplode(lines).alias("record_no", "record"))
    record = F.col("record")
    for end, code in _CODES:
        record = F.replace(record, F.lit(_MARK + code), F.lit(end))
    return found.where(F.length("record") > 0).withColumn("record", F.replace(record, F.lit(_MARK + "a"), F.lit(_MARK)))


def _fields(record: Column) -> Column:
    """Number of fields: commas outside quotes, and one."""
    outside = F.array_join(F.filter(_pieces(record), lambda _, at: at % 2 == 0), "")
    return F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1


def read_records(records: DataFrame, schema: str, *keep: str) -> DataFrame:
    """Data records with their typed ``row`` and a ``reason``, which is null for a good one.

    Reasons: ``quote`` (one is not closed), ``fields: n`` (another number than the schema has), or the name of the first
    column whose value has another type. A value that is not there is null and no fault; a quoted empty text is a text.
    """
    fields = T.StructType.fromDDL(schema).fields
    names = [f"c{k}" for k in range(len(fields))]
    told = records.where(F.col("record_no") > 0).select(
        *keep, "record_no", "record", (F.size(_pieces(F.col("record"))) % 2 == 0).alias("open"), _fields(F.col("record")).alias("n"),
        F.from_csv("record", F.lit(", ".join(f"{n} STRING" for n in names)), _OPTIONS).alias("text"))
    values = told.select("*", F.struct(*[
        F.col(f"text.{n}").try_cast(f.dataType).alias(f.name) for n, f in zip(names, fields, strict=True)]).alias("row"))
    reason = F.when(F.col("open"), "quote").when(F.col("n") != len(fields), F.concat(F.lit("fields: "), F.col("n").cast("string")))
    for name, field in zip(names, fields, strict=True):
        reason = reason.when(F.col(f"text.{name}").isNotNull() & F.col(f"row.{field.name}").isNull(), field.name)
    # A filter on the reason would be moved below the parsing, which would then run again for every column it looks at.
    told = values.select(*keep, F.array(F.struct("record_no", "record", "row", reason.alias("reason"))).alias("_told"))
    return told.select(*keep, F.explode_outer("_told").alias("_told")).select(*keep, "_told.*")


def good_records(read: DataFrame, *keep: str) -> DataFrame:
    return read.where(F.col("reason").isNull()).select(*keep, "row.*")


def rejects(read: DataFrame, *keep: str) -> DataFrame:
    """What can't be read, as it came, with the reason."""
    return read.where(F.col("reason").isNotNull()).select(*keep, "record_no", "reason", "record")
