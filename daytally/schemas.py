"""Table schemas and column lists. All I/O uses these; nothing is inferred."""

from pyspark.sql import types as T

# Volumes are doubles with six decimals at most (functions.numbers.fits). Their sums are exact and independent of
# order (functions.numbers.exact_sum).
VOLUME = T.DoubleType()

# Column names, venues, source codes and correction of the published data model.
VENUES = ("NASDAQ", "NYSE")
SOURCE_CODES = {"NASDAQ": "FNSQ", "NYSE": "FNYX"}
SYMBOL_FIXES = {"GECCL": "GECC_L"}
VOLUME_COLUMNS = ["ShortExemptVolume", "ShortVolume", "TotalVolume"]
RAW_COLUMNS = ["Date", "ShortExemptVolume", "ShortVolume", "SourceURL", "Symbol", "TotalVolume"]
COMBINED_COLUMNS = ["date", "symbol", "short_exempt_volume", "short_volume", "total_volume"]
RETURN_HORIZONS = (1, 5, 22, 65)

# One observation of one symbol at one venue on one day.
DAY_KEY = ["exchange", "Date", "Symbol"]

# Name -> type of every column a raw file may hold, whatever its order in the file.
RAW_TYPES = {
    "Date": T.DateType(),
    "ShortExemptVolume": VOLUME,
    "ShortVolume": VOLUME,
    "SourceURL": T.StringType(),
    "Symbol": T.StringType(),
    "TotalVolume": VOLUME,
}

COMBINED_SCHEMA = T.StructType(
    [T.StructField("date", T.DateType()), T.StructField("symbol", T.StringType())]
    + [T.StructField(name, T.DoubleType()) for name in COMBINED_COLUMNS[2:]]
)

# Each data row mixes text, numbers and nulls; array<string> reads them all.
DOCUMENT_SCHEMA = T.StructType([
    T.StructField("dataset", T.StructType([
        T.StructField("column_names", T.ArrayType(T.StringType())),
        T.StructField("data", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("newest_available_date", T.StringType()),
    ])),
])

LANDED_DOCUMENT_SCHEMA = T.StructType([
    T.StructField("exchange", T.StringType()),
    T.StructField("Symbol", T.StringType()),
    T.StructField("SourceURL", T.StringType()),
    T.StructField("body", T.StringType()),
])

CHECK_COLUMNS = ["check", "subject", "status", "expected", "actual"]
