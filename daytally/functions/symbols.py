"""Ticker symbol rules."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_symbol(symbol: Column) -> Column:
    """Class shares are written with a dot in listings and an underscore at the source."""
    return F.translate(symbol, ".", "_")


def strip_brackets(text: Column) -> Column:
    return F.translate(text, "[]", "")


def remap_symbol(symbol: Column, fixes: dict[str, str]) -> Column:
    """Replace the symbols listed in ``fixes``; leave all others, and nulls, as they are."""
    if not fixes:
        return symbol
    wrong = list(fixes)
    first = F.when(symbol == wrong[0], fixes[wrong[0]])
    return reduce(lambda rule, key: rule.when(symbol == key, fixes[key]), wrong[1:], first).otherwise(symbol)
