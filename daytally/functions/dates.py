"""Dates are DateType inside the library and ISO text at its edges."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the form of a date at the edges, four-digit year, month and day.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def parse_iso(text: Column) -> Column:
    """Date of ``yyyy-MM-dd`` text; anything else is null. A cast is far cheaper than a format pattern."""
    return F.when(text.rlike(ISO_DATE), text.try_cast("date"))


def iso_text(date: Column) -> Column:
    return date.cast("string")


def date_before(a: Column, b: Column) -> Column:
    """Strict comparison of two ISO texts; null if either is not a date."""
    return parse_iso(a) < parse_iso(b)
