"""The queries again, as SQL for another engine."""

from daytally.plans import queries as q
from daytally.schemas import RETURN_HORIZONS
from daytally.sources.market_views import CUSTOMERS_PER_SYMBOL, SOURCE_URL

RAW = f"""raw AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 'NASDAQ' ELSE 'NYSE' END AS exchange,
         CAST(l_shipdate AS DATE) AS d, strftime(l_shipdate, '%Y-%m-%d') AS day,
         l_discount AS ev, l_quantity AS sv, l_extendedprice AS tv,
         replace('S.' || CAST(l_suppkey AS VARCHAR), '.', '_') AS s, '{SOURCE_URL}' AS url
  FROM lineitem)"""

ROW = """exchange, day AS "Date", ev AS "ShortExemptVolume", sv AS "ShortVolume", url AS "SourceURL",
 s AS "Symbol", tv AS "TotalVolume" """

BEST = "tv DESC NULLS LAST, sv DESC NULLS LAST, ev DESC NULLS LAST"

DEDUPED = f"""deduped AS (
  SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY exchange, d, s ORDER BY {BEST}) = 1)"""


def _sum(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(28,6))) AS DOUBLE)"


def _totals(table: str, symbol: str) -> str:
    return f"""SELECT d, day AS date, {symbol} AS symbol, {_sum('ev')} AS short_exempt_volume,
  {_sum('sv')} AS short_volume, {_sum('tv')} AS total_volume FROM {table} GROUP BY d, day, {symbol}"""


FIXED = "CASE WHEN s = 'S_7' THEN 'S__7' ELSE s END"
COMBINED = f"combined AS ({_totals('deduped', FIXED)})"

PRICES = f"""prices AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS date,
         'S_' || CAST(o_custkey // {CUSTOMERS_PER_SYMBOL} AS VARCHAR) AS symbol, {_sum('o_totalprice')} AS close
  FROM orders GROUP BY 1, 2)"""

SECTORS = """sectors AS (
  SELECT 'S_' || CAST(s_suppkey AS VARCHAR) AS symbol, r_name AS sector
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

RETURNS = "returns AS (SELECT date, symbol, close, " + ", ".join(
    f"lead(close, {n}) OVER (PARTITION BY symbol ORDER BY date) / close - 1 AS ret_{n}" for n in RETURN_HORIZONS
) + " FROM prices)"

STUDY = f"""study AS (
  SELECT date, symbol, sector, short_volume / total_volume AS ratio, {', '.join(f'ret_{n}' for n in RETURN_HORIZONS)}
  FROM combined JOIN returns USING (date, symbol) JOIN sectors USING (symbol))"""

DATED = """fixes AS (
  SELECT 'S_' || CAST(s_suppkey AS VARCHAR) AS wrong, 'S_' || CAST(s_suppkey AS VARCHAR) || '_OLD' AS right_,
         DATE '0001-01-01' AS f, DATE '1998-06-30' AS t FROM supplier
  UNION ALL SELECT 'S_' || CAST(s_suppkey AS VARCHAR), 'G_' || CAST(s_suppkey // 10 AS VARCHAR), DATE '1999-01-01', DATE '9999-12-31'
  FROM supplier)"""


def _dated(table: str) -> str:
    return f"SELECT {table}.*, coalesce(right_, s) AS now FROM {table} LEFT JOIN fixes ON s = wrong AND d BETWEEN f AND t"


_SV, _TV = "CAST(sv AS VARCHAR)", "CAST(tv AS VARCHAR)"
CSV_RECORDS = f"""records AS (
  SELECT exchange || ', "' || s || '"' || chr(10) AS name, sv AS volume, day,
    CASE WHEN ev = 0.04 THEN 'fields: 4' WHEN ev = 0.03 THEN 'volume' ELSE 'good' END AS reason,
    '"' || exchange || ', ""' || s || '""' || chr(10) || '",' || CASE WHEN ev = 0.03 THEN 'abc' ELSE {_SV} END || ',' || day
      || CASE WHEN ev = 0.04 THEN ',x' ELSE '' END AS record FROM raw
  UNION ALL
  SELECT s, tv, day, CASE WHEN ev = 0.05 THEN 'fields: 2' ELSE 'good' END,
    s || ',' || {_TV} || CASE WHEN ev = 0.05 THEN '' ELSE ',' || day END FROM raw)"""

GAPPED = """gapped AS (
  SELECT * FROM prices WHERE NOT (CAST(right(date, 2) AS INTEGER) % 7 = 0 AND length(symbol) = 4)),
calendar AS (SELECT date, CAST(row_number() OVER (ORDER BY date) - 1 AS INTEGER) AS number FROM (SELECT DISTINCT date FROM gapped)),
numbered AS (SELECT gapped.*, number FROM gapped JOIN calendar USING (date))"""

WORKING = "returns AS (SELECT p.date, p.symbol, p.close, " + ", ".join(
    f"p{n}.close / p.close - 1 AS ret_{n}" for n in RETURN_HORIZONS
) + " FROM numbered p " + " ".join(
    f"LEFT JOIN numbered p{n} ON p{n}.symbol = p.symbol AND p{n}.number = p.number + {n}" for n in RETURN_HORIZONS) + ")"

STUDY_TABLES = ", ".join([RAW, DEDUPED, COMBINED, PRICES, SECTORS, RETURNS, STUDY])

SAMPLED = f"""sampled AS (
  SELECT * FROM study QUALIFY row_number() OVER (
    PARTITION BY sector ORDER BY md5(date || '|' || symbol), date, symbol) <= {q.SAMPLE_ROWS})"""

LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT date, symbol, sector, ratio, {n} AS horizon, ret_{n} AS ret FROM sampled WHERE ret_{n} IS NOT NULL"
    for n in RETURN_HORIZONS
) + ")"


def _band(by: str) -> str:
    return f"""band AS (
  SELECT long.* FROM long JOIN (
    SELECT {by}, quantile_cont(ret, 0.25) AS low, quantile_cont(ret, 0.75) AS high FROM long GROUP BY {by}
  ) USING ({by}) WHERE ret BETWEEN low AND high)"""


BAND_TABLES = ", ".join([STUDY_TABLES, SAMPLED, LONG])

_CORRELATIONS = ", ".join(
    f"count(*) FILTER (ratio IS NOT NULL AND ret_{n} IS NOT NULL) AS n_ret_{n}, "
    f"round(corr(ret_{n}, ratio), 6) AS corr_ret_{n}" for n in RETURN_HORIZONS
)
_SAMPLED_CORRELATION = """SELECT sector, horizon, count(*) FILTER (ratio IS NOT NULL) AS n_ret,
 round(corr(ret, ratio), 6) AS corr_ret FROM band GROUP BY sector, horizon"""

ARRIVED = f"""arrived AS (
  SELECT * FROM raw WHERE exchange = 'NASDAQ' AND d < DATE '{q.ARRIVED_BEFORE}' AND ev <= 0.05)"""

SYMBOLS = """symbols AS (
  SELECT exchange, 'S_' || CAST(s_suppkey AS VARCHAR) AS s
  FROM supplier CROSS JOIN (VALUES ('NASDAQ'), ('NYSE')) AS v(exchange))"""

PLAN = f"""plan AS (
  SELECT symbols.exchange, symbols.s, last_date, coalesce(last_date, DATE '{q.START}') AS start_date,
         DATE '{q.PULL}' AS end_date,
         CASE WHEN last_date IS NULL THEN 'full' WHEN last_date < DATE '{q.PULL}' THEN 'partial' ELSE 'skip' END AS action
  FROM symbols LEFT JOIN (SELECT exchange, s, max(d) AS last_date FROM arrived GROUP BY exchange, s) USING (exchange, s))"""

STORED = f"stored AS (SELECT * FROM raw WHERE d < DATE '{q.STORED_UNTIL}')"


def _latest(table: str, keys: str) -> str:
    return f"SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY d DESC, {BEST}) = 1"


def _text(volume: str) -> str:
    return f"CAST(CAST({volume} AS DECIMAL(28,6)) AS VARCHAR)"


CLOSE = "abs({a} - {b}) <= 1e-8 + 1e-5 * abs({b})"

SOURCE_CHECKS = f"""pairs AS (
  SELECT b.exchange || '/' || b.s AS subject, a.day AS have, b.day AS want, a.sv AS have_volume, c.sv AS want_volume,
         c.s IS NOT NULL AS sent
  FROM ({_latest('raw', 'exchange, s')}) b LEFT JOIN ({_latest('stored', 'exchange, s')}) a
    ON a.exchange = b.exchange AND a.s = b.s LEFT JOIN deduped c ON a.exchange = c.exchange AND a.s = c.s AND a.d = c.d),
source_checks AS (
  SELECT 'freshness' AS "check", subject, CASE WHEN have = want THEN 'SUCCESS' ELSE 'FAIL' END AS status,
         want AS expected, have AS actual FROM pairs
  UNION ALL
  SELECT 'accuracy', subject, CASE WHEN {CLOSE.format(a='have_volume', b='want_volume')} THEN 'SUCCESS' ELSE 'FAIL' END,
         {_text('want_volume')}, {_text('have_volume')} FROM pairs WHERE sent)"""


def _reconciled(published: str) -> str:
    return f"""sums AS (SELECT day AS date, {FIXED} AS symbol, {_sum('sv')} AS venue_volume FROM deduped GROUP BY day, {FIXED}),
published AS ({published}),
reconciled AS (
  SELECT 'reconciliation' AS "check", date || '/' || symbol AS subject,
         CASE WHEN {CLOSE.format(a='short_volume', b='venue_volume')} THEN 'SUCCESS' ELSE 'FAIL' END AS status,
         {_text('venue_volume')} AS expected, {_text('short_volume')} AS actual
  FROM sums FULL JOIN published USING (date, symbol))"""


FAULTY = f"""SELECT date, symbol,
  CASE WHEN symbol = 'S_1' AND date LIKE '{q.FAULT_MONTH}%' THEN short_volume + 1 ELSE short_volume END AS short_volume
  FROM combined WHERE NOT (symbol = 'S_2' AND date LIKE '{q.FAULT_MONTH}%')"""


def _profile(name: str, column: str) -> str:
    quartiles = ", ".join(f"quantile_cont({column}, {p}) AS q{int(p * 100)}" for p in (0.25, 0.5, 0.75))
    return f"""SELECT '{name}' AS "column", count({column}) AS n, {_sum(column)} / count({column}) AS mean,
 round(stddev_samp({column}), 4) AS std, min({column}) AS min, {quartiles}, max({column}) AS max FROM raw"""


def _basic(name: str) -> str:
    return f"""SELECT 'not empty' AS "check", '{name}' AS subject,
 CASE WHEN count(*) > 0 THEN 'SUCCESS' ELSE 'FAIL' END AS status, 'rows' AS expected,
 CAST(count(*) AS VARCHAR) AS actual FROM {name}"""


LISTING = """listing AS (
  SELECT replace('S.' || CAST(p_partkey AS VARCHAR), '.', '_') AS "Symbol",
         CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS "MarketCap", p_type AS "Sector",
         p_brand AS industry, p_name AS "SummaryQuote" FROM part)"""

ORACLE: dict[str, str] = {
    "scan_parquet": """SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem""",
    "scan_union": f"""WITH {RAW}
SELECT {ROW} FROM raw WHERE exchange = 'NASDAQ' UNION ALL SELECT {ROW} FROM raw WHERE exchange = 'NYSE'""",
    "symbol_universe": f'WITH {LISTING} SELECT DISTINCT "Symbol" FROM listing',
    "symbol_limit": f'WITH {LISTING} SELECT DISTINCT "Symbol" FROM listing ORDER BY "Symbol" LIMIT 100',
    "clean_stock_info": f"WITH {LISTING} SELECT * FROM listing",
    "parse_csv_lines": f"""WITH {RAW}
SELECT exchange, day AS "Date", sv AS "ShortVolume", s AS "Symbol", tv AS "TotalVolume" FROM raw""",
    "parse_csv_records": f"""WITH {RAW}, {CSV_RECORDS}
SELECT CASE WHEN reason = 'good' THEN name ELSE record END AS name, CASE WHEN reason = 'good' THEN volume END AS volume,
  CASE WHEN reason = 'good' THEN day END AS day, reason FROM records""",
    "parse_dataset_json": f"WITH {RAW} SELECT {ROW} FROM raw",
    "explode_rows": f"""WITH {RAW} SELECT exchange, s AS "Symbol", day AS "Date", sv AS "ShortVolume" FROM raw""",
    "document_status": f"""WITH {RAW}
SELECT exchange, s AS "Symbol", 'data' AS status, count(*) AS n_rows FROM raw GROUP BY exchange, s""",
    "document_status_faulty": f"""WITH {RAW}, told AS (SELECT exchange, s, CASE right(s, 1) WHEN '9' THEN 'failed'
WHEN '8' THEN 'malformed' WHEN '7' THEN 'no data' ELSE 'data' END AS status FROM raw)
SELECT exchange, s AS "Symbol", status, count(*) FILTER (status = 'data') AS n_rows FROM told GROUP BY exchange, s, status""",
    "newest_offered": f"""WITH {RAW} SELECT exchange, s AS "Symbol", day AS newest_date, sv AS source_volume
FROM ({_latest('raw', 'exchange, s')})""",
    "sql_view": f"WITH {RAW} SELECT {ROW} FROM raw",
    "project": f"""WITH {RAW} SELECT s AS symbol, day AS date, tv AS "TotalVolume", sv AS "ShortVolume" FROM raw""",
    "filter_eq": f"WITH {RAW} SELECT {ROW} FROM raw WHERE s = 'S_7' AND d = DATE '2001-07-10'",
    "filter_contains": f"WITH {RAW} SELECT {ROW} FROM raw WHERE contains(s, '_9')",
    "delete_where": f"WITH {RAW} SELECT {ROW} FROM raw WHERE NOT contains(s, '_9')",
    "delete_report": f"""WITH {RAW} SELECT count(*) AS n_before, count(*) FILTER (contains(s, '_9')) AS n_deleted,
count(*) FILTER (NOT contains(s, '_9')) AS n_after FROM raw""",
    "normalize_symbol": """SELECT p_partkey,
replace('P.' || CAST(p_size AS VARCHAR) || '.' || CAST(p_partkey AS VARCHAR), '.', '_') AS symbol FROM part""",
    "symbol_remap": f"""WITH {RAW} SELECT day AS "Date", {FIXED} AS symbol, tv AS "TotalVolume" FROM raw""",
    "symbol_remap_dated": f"""WITH {RAW}, {DATED}
SELECT exchange, day AS "Date", s AS "Symbol", now AS symbol_now, tv AS "TotalVolume" FROM ({_dated('raw')})""",
    "combine_dated": f"""WITH {RAW}, {DEDUPED}, {DATED}, dated AS ({_dated('deduped')}), t AS ({_totals('dated', 'now')})
SELECT * EXCLUDE (d) FROM t""",
    "reconcile_dated": f"""WITH {RAW}, {DEDUPED}, {DATED}, dated AS ({_dated('deduped')}),
sums AS (SELECT day AS date, now AS symbol, {_sum('sv')} AS venue_volume FROM dated GROUP BY day, now),
published AS (SELECT date, CASE WHEN date = '2000-01-03' AND symbol = 'G_1' THEN 'S_1_OLD' ELSE symbol END AS symbol,
  venue_volume AS short_volume FROM sums)
SELECT 'reconciliation' AS "check", date || '/' || symbol AS subject,
  CASE WHEN {CLOSE.format(a='short_volume', b='venue_volume')} THEN 'SUCCESS' ELSE 'FAIL' END AS status,
  {_text('venue_volume')} AS expected, {_text('short_volume')} AS actual
FROM sums FULL JOIN published USING (date, symbol)""",
    "typed_cast": f"""WITH {RAW} SELECT exchange, s AS "Symbol", CASE WHEN ev = 0.03 THEN NULL ELSE day END AS "Date",
CASE WHEN ev = 0.03 THEN NULL ELSE sv END AS "ShortVolume", tv AS "TotalVolume" FROM raw""",
    "date_before": f"""WITH {RAW} SELECT s AS "Symbol", CASE WHEN ev = 0.03 THEN 'not a day' ELSE day END AS date,
CASE WHEN ev = 0.03 THEN NULL ELSE d < DATE '{q.PULL}' END AS before FROM raw""",
    "request_url": f"""WITH {RAW} SELECT exchange, s AS "Symbol",
'{SOURCE_URL}' || CASE exchange WHEN 'NASDAQ' THEN 'FNSQ' ELSE 'FNYX' END || '_' || s
|| '?start_date=' || day || '&end_date=2001-12-31' AS url FROM raw""",
    "is_close": f"""WITH r AS (
SELECT l_orderkey, l_linenumber, l_quantity, l_quantity * (1 + l_tax * CAST(0.0005 AS DOUBLE)) AS reference FROM lineitem)
SELECT l_orderkey, l_linenumber, reference, {CLOSE.format(a='l_quantity', b='reference')} AS close FROM r""",
    "combine": f"WITH {RAW}, {DEDUPED}, {COMBINED} SELECT * EXCLUDE (d) FROM combined",
    "combine_raw": f"WITH {RAW}, t AS ({_totals('raw', 's')}) SELECT * EXCLUDE (d) FROM t",
    "combine_any_venue": f"WITH {RAW}, {DEDUPED}, {COMBINED} SELECT * EXCLUDE (d) FROM combined",
    "dedupe": f"WITH {RAW}, {DEDUPED} SELECT {ROW} FROM deduped",
    "last_dates": f"""WITH {RAW} SELECT s AS "Symbol", max(day) AS last_date FROM raw GROUP BY s""",
    "advance_last_dates": f"""WITH {RAW} SELECT s AS "Symbol", max(day) AS last_date FROM raw GROUP BY s""",
    "global_max_date": f"WITH {RAW} SELECT max(day) AS max_date FROM raw",
    "latest_per_symbol": f"""WITH {RAW} SELECT exchange, day AS "Date", ev AS "ShortExemptVolume",
sv AS "ShortVolume", s AS "Symbol", tv AS "TotalVolume" FROM raw
QUALIFY row_number() OVER (PARTITION BY s ORDER BY d DESC, {BEST}, exchange DESC) = 1""",
    "latest_date_for_symbol": f"""WITH {RAW} SELECT day AS "Date" FROM raw WHERE s = 'S_7' ORDER BY d DESC LIMIT 5""",
    "top1": f"WITH {RAW} SELECT {ROW} FROM raw ORDER BY d DESC, {BEST}, exchange, s LIMIT 1",
    "head_sorted": f"WITH {RAW} SELECT {ROW} FROM raw ORDER BY d, s, {BEST}, exchange LIMIT 5",
    "tail": f"WITH {RAW} SELECT {ROW} FROM raw ORDER BY d DESC, s DESC, {BEST}, exchange DESC LIMIT 5",
    "row_count_approx": "SELECT count(*) AS n_rows, true AS exact FROM lineitem",
    "row_count_interval": "SELECT count(*) AS n_rows, count(*) AS low, count(*) AS high, true AS exact FROM lineitem",
    "document_bad_rows": f"""WITH {RAW}, judged AS (
SELECT CASE WHEN ev = 0.01 THEN 'Date' WHEN ev IN (0.02, 0.03, 0.04) THEN 'ShortVolume' ELSE 'good' END AS reason,
       CASE WHEN ev <> 0.05 THEN sv END AS sv FROM raw)
SELECT reason, count(*) AS n_rows, CASE WHEN reason = 'good' THEN count(sv) ELSE 0 END AS n_volumes,
       CASE WHEN reason = 'good' THEN {_sum('sv')} END AS volume FROM judged GROUP BY reason""",
    "row_count": "SELECT count(*) AS n_rows FROM lineitem",
    "count_matching": f"""WITH {RAW} SELECT count(*) AS n_rows, count(*) FILTER (contains(s, '_9')) AS n_matching,
count(DISTINCT s) FILTER (contains(s, '_9')) AS n_distinct FROM raw""",
    "profile": f"WITH {RAW} " + " UNION ALL ".join(
        _profile(name, column) for name, column in zip(q.PROFILED, ("ev", "sv", "tv"), strict=True)
    ),
    "incremental_plan": f"""WITH {RAW}, {ARRIVED}, {SYMBOLS}, {PLAN}
SELECT exchange, s AS "Symbol", strftime(last_date, '%Y-%m-%d') AS last_date,
strftime(start_date, '%Y-%m-%d') AS start_date, strftime(end_date, '%Y-%m-%d') AS end_date, action FROM plan""",
    "incremental_load": f"""WITH {RAW}, {DEDUPED}, {ARRIVED}, {SYMBOLS}, {PLAN}
SELECT {ROW} FROM deduped JOIN plan USING (exchange, s)
WHERE action <> 'skip' AND d BETWEEN start_date AND end_date AND (last_date IS NULL OR d > last_date)""",
    "incremental_load_fixed": f"WITH {RAW}, {DEDUPED} SELECT {ROW} FROM deduped WHERE d = DATE '{q.PULL}'",
    "quality_basic": " UNION ALL ".join(_basic(n) for n in ("lineitem", "orders", "supplier"))
    + " UNION ALL SELECT 'exists', 'trades', 'FAIL', 'a table', 'does not exist'",
    "quality_vs_source": f"WITH {RAW}, {DEDUPED}, {STORED}, {SOURCE_CHECKS} SELECT * FROM source_checks",
    "reconcile": f"WITH {RAW}, {DEDUPED}, {COMBINED}, {_reconciled(FAULTY)} SELECT * FROM reconciled",
    "quality_gate": f"""WITH {RAW}, {DEDUPED}, {COMBINED}, {STORED}, {SOURCE_CHECKS},
{_reconciled('SELECT date, symbol, short_volume FROM combined')},
checks AS (SELECT * FROM reconciled UNION ALL SELECT * FROM source_checks)
SELECT "check", count(*) AS n_checks, count(*) FILTER (status = 'FAIL') AS n_failed,
count(*) FILTER (status = 'FAIL') = 0 AS passed FROM checks GROUP BY "check" """,
    "short_ratio": f"""WITH {RAW}, {DEDUPED}, {COMBINED}
SELECT date, symbol, short_volume / total_volume AS ratio FROM combined""",
    "forward_returns": f"WITH {PRICES}, {RETURNS} SELECT * FROM returns",
    "trading_calendar": f"WITH {PRICES}, {GAPPED} SELECT * FROM calendar",
    "working_day_returns": f"WITH {PRICES}, {GAPPED}, {WORKING} SELECT * FROM returns",
    "working_day_correlation": f"""WITH {RAW}, {DEDUPED}, {COMBINED}, {PRICES}, {GAPPED}, {SECTORS}, {WORKING}, {STUDY}
SELECT sector, {_CORRELATIONS} FROM study GROUP BY sector""",
    "grouped_quantiles": f"""WITH {RAW} SELECT exchange, left(day, 7) AS month, round(quantile_cont(tv, 0.25), 6) AS q25,
round(quantile_cont(tv, 0.5), 6) AS q50, round(quantile_cont(tv, 0.75), 6) AS q75 FROM raw GROUP BY 1, 2""",
    "join_prices": f"""WITH {RAW}, {DEDUPED}, {COMBINED}, {PRICES}, {SECTORS}
SELECT combined.* EXCLUDE (d), close, sector FROM combined JOIN prices USING (date, symbol) JOIN sectors USING (symbol)""",
    "stratified_sample": f"""WITH {RAW}, {DEDUPED}, {COMBINED}, {SECTORS}
SELECT combined.* EXCLUDE (d), sector FROM combined JOIN sectors USING (symbol) QUALIFY row_number() OVER (
PARTITION BY sector ORDER BY md5(date || '|' || symbol), date, symbol) <= {q.SAMPLE_ROWS}""",
    "stratified_sample_large": f"""WITH {RAW}, {DEDUPED}, {COMBINED}, {SECTORS}
SELECT combined.* EXCLUDE (d), sector FROM combined JOIN sectors USING (symbol) QUALIFY row_number() OVER (
PARTITION BY sector ORDER BY md5(date || '|' || symbol), date, symbol) <= {q.LARGE_SAMPLE_ROWS}""",
    "iqr_filter": f"WITH {BAND_TABLES}, {_band('sector, horizon')} SELECT * FROM band",
    "sector_correlation": f"WITH {STUDY_TABLES} SELECT sector, {_CORRELATIONS} FROM study GROUP BY sector",
    "sector_period_correlation": f"""WITH {STUDY_TABLES}
SELECT sector, CAST(left(date, 4) AS INTEGER) AS year, {_CORRELATIONS} FROM study GROUP BY 1, 2""",
    "sampled_correlation": f"WITH {BAND_TABLES}, {_band('sector, horizon')} {_SAMPLED_CORRELATION}",
    "sampled_correlation_one_band": f"WITH {BAND_TABLES}, {_band('horizon')} {_SAMPLED_CORRELATION}",
}
ORACLE["quality_gate_faulty"] = f"""WITH {RAW}, {DEDUPED}, {COMBINED}, {STORED}, {SOURCE_CHECKS}, {_reconciled(FAULTY)},
checks AS (SELECT * FROM reconciled UNION ALL SELECT * FROM source_checks)
SELECT "check", count(*) AS n_checks, count(*) FILTER (status = 'FAIL') AS n_failed,
count(*) FILTER (status = 'FAIL') = 0 AS passed FROM checks GROUP BY "check" """
# The same answers by another way.
ORACLE["merged_correlation"] = ORACLE["sector_correlation"]
ORACLE["merged_period_correlation"] = ORACLE["sector_period_correlation"]
