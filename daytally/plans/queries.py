"""One query per operator, over the test tables. Each takes the session and the folder of the tables."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions import (
    date_before,
    exact_sum,
    is_close,
    iso_text,
    normalize_symbol,
    remap_symbol,
    request_url,
    strip_key,
    to_double,
    to_volume,
)
from daytally.functions.dates import parse_iso
from daytally.operators import analysis, counting, fixes, ingest, maintenance, moments, quality, quantiles, venues
from daytally.schemas import RAW_COLUMNS
from daytally.session import shared_folder, stored
from daytally.sources import documents as docs
from daytally.sources import csv_payloads, listings, market_views, tables

Query = Callable[[SparkSession, str], DataFrame]

# Settings of the queries; the SQL uses the same values.
FIXES = {"S_7": "S__7"}
START, PULL = "1996-01-01", "2000-06-30"
ARRIVED_BEFORE = "2000-07-04"
STORED_UNTIL = "2001-10-25"
FAULT_MONTH = "1999-06"
SAMPLE_ROWS = 1000
LARGE_SAMPLE_ROWS = 5000
PROFILED = ["ShortExemptVolume", "ShortVolume", "TotalVolume"]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under the function's name, less the underscore that keeps it apart from an import."""
    QUERIES[build.__name__.rstrip("_")] = build
    return build


def _text_date(df: DataFrame, column: str = "Date") -> DataFrame:
    return df.withColumn(column, iso_text(F.col(column)))


def _shorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market_views.short_interests(spark, sf_dir)


def _arrived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store that has one venue only, and not all of its recent rows."""
    rows = _shorts(spark, sf_dir)
    return rows.where(
        (F.col("exchange") == "NASDAQ")
        & (F.col("Date") < F.lit(ARRIVED_BEFORE).cast("date"))
        & (F.col("ShortExemptVolume") <= 0.05)
    )


def _symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every symbol at both venues."""
    supplier = market_views.table(spark, sf_dir, "supplier")
    symbol = normalize_symbol(market_views.dotted_symbol("s_suppkey")).alias("Symbol")
    return supplier.select(F.explode(F.array(F.lit("NASDAQ"), F.lit("NYSE"))).alias("exchange"), symbol)


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = ingest.last_dates(_arrived(spark, sf_dir), ("exchange", "Symbol"))
    return ingest.incremental_plan(_symbols(spark, sf_dir), known, START, PULL)


def _combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return venues.combine(_shorts(spark, sf_dir), FIXES)


def _analysis_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.analysis_rows(
        _combined(spark, sf_dir), market_views.prices(spark, sf_dir), market_views.sectors(spark, sf_dir)
    )


# Scans and sources


@query
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.read_table(spark, f"{sf_dir}/lineitem.parquet")
    return _text_date(lines.withColumn("l_shipdate", F.to_date("l_shipdate")), "l_shipdate")


@query
def scan_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(venues.union_venues(market_views.venue_tables(spark, sf_dir)))


@query
def symbol_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.symbol_universe(spark, listings.clean_listing(market_views.listing(spark, sf_dir)))


@query
def symbol_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.symbol_universe(spark, listings.clean_listing(market_views.listing(spark, sf_dir)), limit=100)


@query
def clean_stock_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.clean_listing(market_views.listing(spark, sf_dir))


@query
def parse_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = market_views.text_short_interests(spark, sf_dir)
    header = F.lit("Date,ShortVolume,Symbol,TotalVolume\r\n")
    line = F.concat_ws(",", "Date", "ShortVolume", "Symbol", "TotalVolume")
    payloads = rows.select("exchange", F.encode(F.concat(header, line), "UTF-8").alias("payload"))
    schema = "Date STRING, ShortVolume DOUBLE, Symbol STRING, TotalVolume DOUBLE"
    return listings.parse_csv_lines(listings.csv_lines(payloads, "payload", "exchange"), schema, "exchange")


@query
def parse_csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two records to a payload, one with a quoted comma, quote and line end; some records are faulty."""
    rows = market_views.text_short_interests(spark, sf_dir)
    exempt = F.col("ShortExemptVolume")
    volume = F.when(exempt == "0.03", "abc").otherwise(F.col("ShortVolume"))
    surplus = F.when(exempt == "0.04", ",x").otherwise("")
    first = F.concat(F.lit('"'), "exchange", F.lit(', ""'), "Symbol", F.lit('""\n",'), volume, F.lit(","), "Date", surplus)
    second = F.concat("Symbol", F.lit(","), F.col("TotalVolume"), F.when(exempt == "0.05", "").otherwise(F.concat(F.lit(","), "Date")))
    payloads = rows.select(F.encode(F.concat(F.lit("name,volume,day\r\n"), first, F.lit("\r\n"), second), "UTF-8").alias("payload"))
    read = csv_payloads.read_records(csv_payloads.csv_records(payloads, "payload"), "name STRING, volume DOUBLE, day DATE")
    good = _text_date(csv_payloads.good_records(read), "day").withColumn("reason", F.lit("good"))
    bad = csv_payloads.rejects(read).select("reason", F.col("record").alias("name"))
    return good.unionByName(bad, allowMissingColumns=True)


@query
def parse_dataset_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(docs.parse_documents(market_views.documents(spark, sf_dir)))


@query
def explode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = docs.explode_maps(docs.document_maps(market_views.documents(spark, sf_dir)), "short_interests")
    return maps.select(
        "exchange", "Symbol", F.col("col")["Date"].alias("Date"),
        to_volume(F.col("col")["ShortVolume"]).alias("ShortVolume"),
    )


@query
def document_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = docs.document_status(market_views.documents(spark, sf_dir))
    return found.groupBy("exchange", "Symbol", "status").agg(F.sum("n_rows").alias("n_rows"))


@query
def document_status_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that failed, came back malformed, or had nothing, by the last digit of the symbol."""
    sent = market_views.documents(spark, sf_dir)
    body = (F.when(F.col("Symbol").endswith("9"), F.lit(None)).when(F.col("Symbol").endswith("8"), "<html>")
            .when(F.col("Symbol").endswith("7"), '{"dataset":{"column_names":["Date"],"data":[]}}').otherwise(F.col("body")))
    found = docs.document_status(sent.withColumn("body", body))
    return found.groupBy("exchange", "Symbol", "status").agg(F.sum("n_rows").alias("n_rows"))


@query
def document_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows set aside, per cause, and what is left of the short volume."""
    faulty = market_views.documents(spark, sf_dir, faulty=True)
    bad = docs.bad_document_rows(faulty).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))
    good = docs.parse_documents(faulty).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("ShortVolume").alias("n_volumes"), exact_sum(F.col("ShortVolume")).alias("volume"))
    return bad.withColumns({"n_volumes": F.lit(0).cast("long"), "volume": F.lit(None).cast("double")}).unionByName(
        good.withColumn("reason", F.lit("good")))


@query
def newest_offered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(docs.newest_offered(market_views.documents(spark, sf_dir)), "newest_date")


@query
def sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = _text_date(_shorts(spark, sf_dir)).select("exchange", *RAW_COLUMNS)
    return tables.sql_view(view, "short_interests", "SELECT * FROM short_interests")


# Projections, filters and scalar functions


@query
def project(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _text_date(_shorts(spark, sf_dir)).withColumnsRenamed({"Date": "date", "Symbol": "symbol"})
    return rows.select("symbol", "date", "TotalVolume", "ShortVolume")


@query
def filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _shorts(spark, sf_dir).where((F.col("Symbol") == "S_7") & (F.col("Date") == F.lit("2001-07-10").cast("date")))
    return _text_date(rows)


@query
def filter_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(_shorts(spark, sf_dir).where(F.col("Symbol").contains("_9")))


@query
def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(maintenance.delete_where(_shorts(spark, sf_dir), F.col("Symbol").contains("_9")))


@query
def delete_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.delete_report(_shorts(spark, sf_dir), F.col("Symbol").contains("_9"))


@query
def normalize_symbol_(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = market_views.table(spark, sf_dir, "part")
    return part.select("p_partkey", normalize_symbol(F.concat(F.lit("P."), "p_size", F.lit("."), "p_partkey")).alias("symbol"))


@query
def symbol_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _shorts(spark, sf_dir)
    return _text_date(rows.select("Date", remap_symbol(F.col("Symbol"), FIXES).alias("symbol"), "TotalVolume"))


def _dated_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two corrections for every symbol, with a gap between them; ten symbols each share the second one."""
    supplier = market_views.table(spark, sf_dir, "supplier")
    wrong = normalize_symbol(market_views.dotted_symbol("s_suppkey"))
    day = lambda text: F.lit(text).cast("date")
    first = F.struct(F.concat(wrong, F.lit("_OLD")).alias("right"), day(None).alias("valid_from"), day("1998-06-30").alias("valid_to"))
    second = F.struct(F.concat(F.lit("G_"), F.floor(F.col("s_suppkey") / 10).cast("string")).alias("right"),
                      day("1999-01-01").alias("valid_from"), day(None).alias("valid_to"))
    return supplier.select(wrong.alias("wrong"), F.explode(F.array(first, second)).alias("f")).select("wrong", "f.*")


@query
def symbol_remap_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixes.fix_symbols(_shorts(spark, sf_dir), _dated_fixes(spark, sf_dir), into="symbol_now")
    return _text_date(rows.select("exchange", "Date", "Symbol", "symbol_now", "TotalVolume"))


@query
def combine_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(venues.combine(_shorts(spark, sf_dir), _dated_fixes(spark, sf_dir)), "date")


@query
def reconcile_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a fault: one day of one symbol is published with the correction of another time."""
    table = _dated_fixes(spark, sf_dir)
    published = venues.combine(_shorts(spark, sf_dir), table)
    wrong = (iso_text(F.col("date")) == "2000-01-03") & (F.col("symbol") == "G_1")
    faulty = published.withColumn("symbol", F.when(wrong, "S_1_OLD").otherwise(F.col("symbol")))
    return quality.reconcile(faulty, _shorts(spark, sf_dir), table)


@query
def typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = market_views.text_short_interests(spark, sf_dir)
    unreadable = F.col("ShortExemptVolume") == "0.03"
    volume = F.when(unreadable, "abc").otherwise(F.col("ShortVolume"))
    date = F.when(unreadable, "not a day").otherwise(F.col("Date"))
    return rows.select(
        "exchange", "Symbol", iso_text(parse_iso(date)).alias("Date"),
        to_volume(volume).alias("ShortVolume"), to_double(F.col("TotalVolume")).alias("TotalVolume"),
    )


@query
def date_before_(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = market_views.text_short_interests(spark, sf_dir)
    date = F.when(F.col("ShortExemptVolume") == "0.03", "not a day").otherwise(F.col("Date"))
    return rows.select("Symbol", date.alias("date"), date_before(date, F.lit(PULL)).alias("before"))


@query
def request_url_(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = request_url(
        market_views.SOURCE_URL, F.col("exchange"), F.col("Symbol"), F.col("Date"), F.lit("2001-12-31").cast("date")
    )
    return _shorts(spark, sf_dir).select("exchange", "Symbol", strip_key(F.concat(url, F.lit("&api_key=secret"))).alias("url"))


@query
def is_close_(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = market_views.table(spark, sf_dir, "lineitem")
    reference = F.col("l_quantity") * (1 + F.col("l_tax") * 0.0005)
    return lines.select(
        "l_orderkey", "l_linenumber", reference.alias("reference"),
        is_close(F.col("l_quantity"), reference).alias("close"),
    )


# Aggregates, top rows and counts


@query
def combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(_combined(spark, sf_dir), "date")


@query
def combine_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(venues.combine_raw(_shorts(spark, sf_dir)), "date")


@query
def combine_any_venue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(venues.combine_any_venue(_shorts(spark, sf_dir), FIXES), "date")


@query
def dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(venues.dedupe(_shorts(spark, sf_dir)))


@query
def last_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(ingest.last_dates(_shorts(spark, sf_dir)), "last_date")


@query
def advance_last_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, pull = _shorts(spark, sf_dir), F.lit(PULL).cast("date")
    known = ingest.last_dates(rows.where(F.col("Date") <= pull))
    return _text_date(ingest.advance_last_dates(known, rows.where(F.col("Date") > pull)), "last_date")


@query
def global_max_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(ingest.global_max_date(_shorts(spark, sf_dir)), "max_date")


@query
def latest_per_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(quality.latest_rows(_shorts(spark, sf_dir).drop("SourceURL"), ["Symbol"]))


@query
def latest_date_for_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _shorts(spark, sf_dir)
    dates = rows.select("Date").where(rows["Symbol"] == F.lit("S_7"))
    return _text_date(counting.top_rows(dates, [F.desc("Date")], 5))


@query
def top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.desc("Date"), *[F.desc(c) for c in venues.KEEP_ORDER], F.asc("exchange"), F.asc("Symbol")]
    return _text_date(counting.top_rows(_shorts(spark, sf_dir), order, 1))


@query
def head_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.asc("Date"), F.asc("Symbol"), *[F.desc(c) for c in venues.KEEP_ORDER], F.asc("exchange")]
    return _text_date(counting.top_rows(_shorts(spark, sf_dir), order, 5))


@query
def tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(counting.tail_rows(_shorts(spark, sf_dir), ["Date", "Symbol", *venues.KEEP_ORDER], 5))


@query
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.row_count(_shorts(spark, sf_dir))


@query
def row_count_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.row_count_approx(spark, f"{sf_dir}/lineitem.parquet").select("n_rows", "exact")


@query
def row_count_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over files of unequal size: one or more for each month."""
    folder = f"{shared_folder(spark)}/months-{uuid.uuid4().hex}"
    rows = _shorts(spark, sf_dir).withColumn("month", F.date_format("Date", "yyyy-MM"))
    rows.repartition("month").write.partitionBy("month").parquet(folder)
    return counting.row_count_interval(spark, folder, files=10_000).select("n_rows", "low", "high", "exact")


@query
def count_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.count_matching(_shorts(spark, sf_dir), F.col("Symbol").contains("_9"), "Symbol")


@query
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.profile(_shorts(spark, sf_dir), PROFILED)


# Incremental load


@query
def incremental_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _plan(spark, sf_dir)
    return plan.select("exchange", "Symbol", *[iso_text(F.col(c)).alias(c) for c in ingest.WINDOW], "action")


@query
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(ingest.load(market_views.documents(spark, sf_dir), _plan(spark, sf_dir)))


@query
def incremental_load_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = ingest.fixed_plan(_symbols(spark, sf_dir), True, START, PULL)
    return _text_date(ingest.load(market_views.documents(spark, sf_dir), plan))


# Checks


def _stored_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _shorts(spark, sf_dir).where(F.col("Date") < F.lit(STORED_UNTIL).cast("date"))
    return quality.quality_vs_source(stored, market_views.documents(spark, sf_dir))


@query
def quality_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["lineitem", "orders", "supplier", "trades"]
    return quality.basic_quality(spark, {name: f"{sf_dir}/{name}.parquet" for name in names})


@query
def quality_vs_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_checks(spark, sf_dir)


def _faulty(published: DataFrame) -> DataFrame:
    """One symbol's volumes are off by one in a month, another's rows are missing."""
    in_month = iso_text(F.col("date")).startswith(FAULT_MONTH)
    off = F.when(in_month & (F.col("symbol") == "S_1"), F.col("short_volume") + 1).otherwise(F.col("short_volume"))
    missing = in_month & (F.col("symbol") == "S_2") & F.col("short_volume").isNotNull()
    return maintenance.delete_where(published, missing).withColumn("short_volume", off)


@query
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reconcile(_faulty(_combined(spark, sf_dir)), _shorts(spark, sf_dir), FIXES)


@query
def quality_gate_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.reconcile(_faulty(_combined(spark, sf_dir)), _shorts(spark, sf_dir), FIXES)
    return quality.gate_summary(found.unionByName(_stored_checks(spark, sf_dir)))


@query
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    shorts = _shorts(spark, sf_dir)
    checks = quality.reconcile(_combined(spark, sf_dir), shorts, FIXES).unionByName(_stored_checks(spark, sf_dir))
    return quality.gate_summary(checks)


# Analysis


@query
def short_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(analysis.short_ratio(_combined(spark, sf_dir)), "date").select("date", "symbol", "ratio")


@query
def forward_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(analysis.forward_returns(market_views.prices(spark, sf_dir)), "date")


def _gapped_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices without some symbols' days, as a halted symbol has them: each seventh day of the month, for a third of the symbols."""
    prices = market_views.prices(spark, sf_dir)
    halted = (F.dayofmonth("date") % 7 == 0) & (F.length("symbol") == 4)
    return prices.where(~halted)


@query
def trading_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_date(analysis.trading_calendar(_gapped_prices(spark, sf_dir)), "date")


@query
def working_day_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = _gapped_prices(spark, sf_dir)
    return _text_date(analysis.working_day_returns(prices, analysis.trading_calendar(prices)), "date")


@query
def join_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = analysis.join_prices(
        _combined(spark, sf_dir), market_views.prices(spark, sf_dir), market_views.sectors(spark, sf_dir)
    )
    return _text_date(rows, "date")


@query
def stratified_sample_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More rows for each sector than Spark's own limits within groups go to."""
    rows = _combined(spark, sf_dir).join(market_views.sectors(spark, sf_dir), "symbol")
    return _text_date(analysis.stratified_sample(rows, "sector", ["date", "symbol"], LARGE_SAMPLE_ROWS), "date")


@query
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _combined(spark, sf_dir).join(market_views.sectors(spark, sf_dir), "symbol")
    return _text_date(analysis.stratified_sample(rows, "sector", ["date", "symbol"], SAMPLE_ROWS), "date")


@query
def iqr_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = stored(analysis.stratified_sample(_analysis_rows(spark, sf_dir), "sector", ["date", "symbol"], SAMPLE_ROWS))
    return _text_date(analysis.middle_band(analysis.long_returns(sample), "ret", ["sector", "horizon"]), "date")


@query
def sector_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.sector_correlation(_analysis_rows(spark, sf_dir))


@query
def sector_period_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.sector_correlation(_analysis_rows(spark, sf_dir), per_year=True)


@query
def working_day_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = _gapped_prices(spark, sf_dir)
    rows = analysis.analysis_rows(
        _combined(spark, sf_dir), prices, market_views.sectors(spark, sf_dir), analysis.trading_calendar(prices))
    return analysis.sector_correlation(rows)


@query
def merged_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``sector_correlation``, from moments per sector and date."""
    return moments.correlations(moments.moments(_analysis_rows(spark, sf_dir), ["sector", "date"]), ["sector"])


@query
def merged_period_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``sector_period_correlation``, from moments per sector and date."""
    parts = moments.moments(_analysis_rows(spark, sf_dir), ["sector", "date"])
    return moments.correlations(parts.withColumn("year", F.year("date")), ["sector", "year"])


@query
def grouped_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of the short volume per month and venue: many groups at once, with many ties."""
    rows = _shorts(spark, sf_dir).withColumn("month", F.date_format("Date", "yyyy-MM"))
    found = quantiles.grouped_quantiles(rows, "TotalVolume", ["exchange", "month"], counting.QUARTILES)
    return found.withColumns({q: F.round(q, 6) for q in counting.QUARTILES})


@query
def sampled_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.sampled_correlation(_analysis_rows(spark, sf_dir), SAMPLE_ROWS)


@query
def sampled_correlation_one_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.sampled_correlation(_analysis_rows(spark, sf_dir), SAMPLE_ROWS, per_sector_band=False)
