from datetime import date

SCHEMA = "exchange string, Date date, ShortExemptVolume double, ShortVolume double, SourceURL string, Symbol string, TotalVolume double"


def day(text):
    return date.fromisoformat(text)


def shorts(spark, *rows):
    """Rows of ``(exchange, date, symbol, exempt, short, total)``."""
    return spark.createDataFrame([(e, day(d) if d else None, x, s, "u", y, t) for e, d, y, x, s, t in rows], SCHEMA)


def tuples(df, *columns):
    """All rows, sorted; nulls first."""
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda row: [(value is not None, value) for value in row])
