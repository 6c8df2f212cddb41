"""Request addresses. The access key is never part of the stored address."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from daytally.functions.dates import iso_text
from daytally.schemas import SOURCE_CODES


def request_url(base: str, exchange: Column, symbol: Column, start: Column, end: Column) -> Column:
    """Address of one symbol's daily rows between two dates, both included."""
    code = F.lit(None).cast("string")
    for venue, source_code in SOURCE_CODES.items():
        code = F.when(exchange == venue, source_code).otherwise(code)
    return F.concat(
        F.lit(base.rstrip("/") + "/"), code, F.lit("_"), symbol,
        F.lit("?start_date="), iso_text(start), F.lit("&end_date="), iso_text(end),
    )


def strip_key(url: Column) -> Column:
    """Remove ``api_key=...`` wherever it stands in the query part."""
    first, later = r"\?api_key=[^&]*&?", r"&api_key=[^&]*"
    without = F.regexp_replace(F.regexp_replace(url, later, ""), first, "?")
    return F.when(url.contains("api_key="), F.rtrim(without, F.lit("?"))).otherwise(url)
