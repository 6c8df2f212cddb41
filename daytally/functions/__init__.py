"""Column expressions. All are built-in Spark functions, so they stay inside generated code."""

from daytally.functions.dates import date_before, iso_text, parse_iso
from daytally.functions.links import request_url, strip_key
from daytally.functions.numbers import (
    bad_volume,
    exact_sum,
    exact_total,
    fits,
    is_close,
    ratio,
    to_double,
    to_volume,
    volume_text,
)
from daytally.functions.symbols import normalize_symbol, remap_symbol, strip_brackets

__all__ = [
    "bad_volume", "date_before", "exact_sum", "exact_total", "fits", "is_close", "iso_text", "normalize_symbol", "parse_iso", "ratio",
    "remap_symbol", "request_url", "strip_brackets", "strip_key", "to_double", "to_volume", "volume_text",
]
