"""The query text behind each registered name."""

from __future__ import annotations

from .stages import ORDER, change, hash_key, hash_text, money, sql

AVG = money("avg(CAST(price AS DOUBLE))")
FIRST_LOAD = "date < DATE '1998-07-01'"
AS_DOUBLE = "REPLACE (CAST(price_kes AS DOUBLE) AS price_kes, CAST(price_usd AS DOUBLE) AS price_usd, CAST(price_per_kg AS DOUBLE) AS price_per_kg)"
VIEW_COLUMNS = (
    "date", "year", "month", "county", "district", "market", "category", "commodity", "unit", "pricetype",
    "currency", "price_kes", "price_usd", "price_per_kg", "is_valid_price",
)


def dbl(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def _tested(table: str, source: str, test: str, checks: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{test}' AS test, '{c}' AS column_name,"
        f" count(*) FILTER (WHERE {broken}) AS violations, count(*) FILTER (WHERE {broken}) = 0 AS passed FROM {source}"
        for c, broken in checks.items()
    )


def _null_tests(table: str, source: str, columns: tuple[str, ...]) -> str:
    return _tested(table, source, "not_null", {c: f"{c} IS NULL" for c in columns})


def _unique(table: str, source: str, keys: str, columns: str | None = None) -> str:
    return (
        f"SELECT '{table}' AS table_name, 'unique' AS test, '{keys}' AS column_name, count(*) AS violations,"
        f" count(*) = 0 AS passed FROM (SELECT count(*) AS n FROM {source} GROUP BY {columns or keys}) WHERE n > 1"
    )


def _orphans(key: str, parent: str) -> str:
    return (
        f"SELECT 'fact' AS table_name, 'relationship' AS test, '{key}' AS column_name, count(*) AS violations,"
        f" count(*) = 0 AS passed FROM facts WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {parent})"
    )


def _two_loads(source: str, keys: tuple[str, ...], columns: str) -> str:
    """Rows of the first load, and those of the whole whose key the first load did not have."""
    match = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    return f"""
SELECT 1 AS load_no, {columns} FROM (SELECT * FROM {source} WHERE {FIRST_LOAD}) a
UNION ALL
SELECT 2 AS load_no, {columns} FROM {source} a
WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM {source} WHERE {FIRST_LOAD}) b WHERE {match})"""


def _members(source: str, keys: str, picked: str) -> str:
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {picked}) AS rn FROM {source}) WHERE rn = 1)"""


def _dimension_loads(keys: tuple[str, ...], picked: str, columns: str) -> str:
    match = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    everyone = _members("staged", ", ".join(keys), picked)
    first = _members(f"(SELECT * FROM staged WHERE {FIRST_LOAD})", ", ".join(keys), picked)
    return f"""
SELECT 1 AS load_no, {columns} FROM {first} a
UNION ALL
SELECT 2 AS load_no, {columns} FROM {everyone} a WHERE NOT EXISTS (SELECT 1 FROM {first} b WHERE {match})"""


def _market_columns() -> str:
    return (
        f"{hash_key('market', 'district', 'county')} AS market_id, market AS market_name, district, county,"
        f" source_market_id, {dbl('latitude', 'longitude')}"
    )


def _commodity_columns() -> str:
    return f"{hash_key('commodity', 'unit')} AS commodity_id, commodity AS commodity_name, category, unit, source_commodity_id"


def _pct(part: str, places: int, width: str) -> str:
    return f"CAST(CAST(round(CAST({part} * 100.0 / n AS DECIMAL(28,6)), {places}) AS {width}) AS VARCHAR)"


QUALITY = f"""
SELECT r.name, r.passed, r.level, r.detail, r.value,
  CASE WHEN r.passed THEN 'PASS' WHEN r.level = 'critical' THEN 'FAIL' ELSE 'WARN' END AS status
FROM (
  SELECT unnest([
    {{'name': 'not_empty', 'passed': n > 0, 'level': 'critical', 'detail': 'rows: ' || n, 'value': CAST(n AS VARCHAR)}},
    {{'name': 'required_columns', 'passed': true, 'level': 'critical', 'detail': 'no column missing', 'value': ''}},
    {{'name': 'price_nulls', 'passed': nulls * 100.0 / n < 30, 'level': CASE WHEN nulls * 100.0 / n >= 30 THEN 'critical' ELSE 'warning' END,
      'detail': '% of price_kes null: ' || {_pct('nulls', 1, 'DECIMAL(8,1)')}, 'value': {_pct('nulls', 2, 'DECIMAL(8,2)')}}},
    {{'name': 'date_range', 'passed': year(lo) >= 2000 AND year(hi) <= 2030, 'level': CASE WHEN lo IS NULL THEN 'critical' ELSE 'warning' END,
      'detail': 'dates: ' || lo || ' to ' || hi, 'value': lo || '..' || hi}},
    {{'name': 'negative_prices', 'passed': neg = 0, 'level': 'critical', 'detail': 'negative prices: ' || neg, 'value': CAST(neg AS VARCHAR)}},
    {{'name': 'duplicate_keys', 'passed': dup = 0, 'level': 'warning', 'detail': 'rows repeating a key: ' || dup, 'value': CAST(dup AS VARCHAR)}},
    {{'name': 'valid_price_ratio', 'passed': valid * 100.0 / n >= 70, 'level': 'warning',
      'detail': '% of rows valid: ' || {_pct('valid', 1, 'DECIMAL(8,1)')}, 'value': {_pct('valid', 2, 'DECIMAL(8,2)')}}}
  ]) AS r
  FROM (SELECT count(*) AS n, count(*) FILTER (WHERE price_kes IS NULL) AS nulls, count(*) FILTER (WHERE price_kes < 0) AS neg,
          count(*) FILTER (WHERE is_valid_price) AS valid, min(date) AS lo, max(date) AS hi,
          count(*) - (SELECT count(*) FROM (SELECT DISTINCT date, market, commodity, pricetype FROM cleaned)) AS dup
        FROM cleaned))"""

FILES = "(SELECT *, 'prices_' || coalesce(CAST(year AS VARCHAR), 'undated') || '.csv' AS file_name FROM cleaned)"


def _note(text: str, column: str) -> str:
    return (
        f"SELECT file_name, '{text}: ' || count(*) AS quality_note FROM {FILES} WHERE {column} IS NULL GROUP BY file_name"
    )


TREND_COLUMNS = "year, month, month_start, county, commodity, unit"
SPREAD = "stddev_samp(CAST(price AS DOUBLE))"
BY_COMMODITY = f"""
SELECT commodity AS metric, {money('avg(avg_price_per_kg)')} AS value FROM monthly WHERE avg_price_per_kg IS NOT NULL
GROUP BY commodity ORDER BY value DESC NULLS FIRST, metric NULLS LAST LIMIT 15"""

COUNTERS = """
SELECT 'dates_failed' AS counter, count(*) AS rows FROM scanned WHERE date IS NOT NULL AND try_strptime(date, '%Y-%m-%d') IS NULL
UNION ALL SELECT 'price_kes_failed', count(*) FROM scanned WHERE price IS NOT NULL AND TRY_CAST(price AS DECIMAL(28,4)) IS NULL
UNION ALL SELECT 'price_kes_zero', count(*) FROM scanned WHERE TRY_CAST(price AS DECIMAL(28,4)) = 0
UNION ALL SELECT 'price_usd_failed', count(*) FROM scanned WHERE usdprice IS NOT NULL AND TRY_CAST(usdprice AS DECIMAL(28,4)) IS NULL
UNION ALL SELECT 'price_usd_zero', count(*) FROM scanned WHERE TRY_CAST(usdprice AS DECIMAL(28,4)) = 0
UNION ALL SELECT 'duplicates_removed', (SELECT count(*) FROM standard) - (SELECT count(*) FROM (SELECT DISTINCT date, market, commodity, pricetype FROM standard))"""

QUERIES = {
    "scan_obs": "SELECT * FROM scanned",
    "load_raw": """
SELECT date, admin1, admin2, market, market_id, latitude, longitude, category, commodity, commodity_id, unit, priceflag,
  pricetype, currency, price, usdprice, 'lineitem.parquet' AS source_file FROM scanned""",
    "raw_by_file": """
SELECT CASE WHEN source_path < '/prices/1996' THEN 1 ELSE 2 END AS load_no, source_path, count(*) AS rows
FROM (SELECT '/prices/' || coalesce(substr(date, 1, 4), 'none') || '/prices.csv' AS source_path FROM scanned) GROUP BY ALL""",
    "clean_rename": """
SELECT date, admin1 AS county, admin2 AS district, market, market_id AS source_market_id, latitude, longitude, category,
  commodity, commodity_id AS source_commodity_id, unit, priceflag, pricetype, currency, price AS price_kes,
  usdprice AS price_usd FROM scanned""",
    "clean_dates": f"SELECT {ORDER}, date AS date_text, CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS date FROM scanned",
    "clean_strings": f"SELECT {ORDER}, county, district, market, category, commodity, unit, priceflag, pricetype, currency FROM texts",
    "clean_prices": f"""
SELECT {ORDER}, price AS price_text, CAST(nullif(TRY_CAST(price AS DECIMAL(28,4)), 0) AS DOUBLE) AS price_kes,
  CAST(nullif(TRY_CAST(usdprice AS DECIMAL(28,4)), 0) AS DOUBLE) AS price_usd FROM scanned""",
    "clean_derive": f"SELECT {ORDER}, date, source_market_id, source_commodity_id, {dbl('latitude', 'longitude')}, year, month FROM standard",
    "unit_price": f"SELECT {ORDER}, unit, {dbl('price_kes', 'price_per_kg')} FROM standard",
    "flag_valid": f"SELECT {ORDER}, date, {dbl('price_kes')}, is_valid_price FROM standard",
    "clean_dedup": f"SELECT date, market, commodity, pricetype, {ORDER} FROM cleaned",
    "clean_full": f"""
SELECT {ORDER}, date, county, district, market, source_market_id, {dbl('latitude', 'longitude')}, category, commodity,
  source_commodity_id, unit, priceflag, pricetype, currency, {dbl('price_kes', 'price_usd')}, year, month,
  {dbl('price_per_kg')}, is_valid_price FROM cleaned""",
    "valid_counts": "SELECT is_valid_price, count(*) AS records FROM cleaned GROUP BY is_valid_price",
    "staging_rejects": """
SELECT date AS price_date, market, commodity, unit, pricetype,
  concat_ws(', ', CASE WHEN date IS NULL THEN 'price_date is missing' END, CASE WHEN year IS NULL THEN 'year is missing' END,
    CASE WHEN month IS NULL THEN 'month is missing' END, CASE WHEN market IS NULL THEN 'market is missing' END,
    CASE WHEN commodity IS NULL THEN 'commodity is missing' END) AS reason
FROM cleaned WHERE date IS NULL OR market IS NULL OR commodity IS NULL""",
    "staging_incremental": _two_loads(
        "staged",
        ("date", "market", "commodity", "unit", "pricetype"),
        "date AS price_date, market, commodity, unit, pricetype, county, district, "
        + dbl("price_kes", "price_usd", "price_per_kg")
        + ", is_valid_price",
    ),
    "mirror_upper": "SELECT "
    + ", ".join(f'CAST({c} AS DOUBLE) AS "{c.upper()}"' if c.startswith("price_") else f'{c} AS "{c.upper()}"' for c in VIEW_COLUMNS)
    + " FROM cleaned",
    "stg_view": f"SELECT * {AS_DOUBLE} FROM shown",
    "mart_monthly": "SELECT * FROM monthly",
    "mart_monthly_by_category": f"""
SELECT year, month, category, {money('avg(CAST(price_kes AS DOUBLE))')} AS avg_price_kes,
  {money('avg(CAST(price_usd AS DOUBLE))')} AS avg_price_usd, {money('avg(CAST(price_per_kg AS DOUBLE))')} AS avg_price_per_kg,
  {money('min(price_kes)')} AS min_price_kes, {money('max(price_kes)')} AS max_price_kes,
  {money('stddev_samp(CAST(price_kes AS DOUBLE))')} AS stddev_price_kes, count(*) AS num_observations,
  count(DISTINCT market) AS num_markets FROM shown GROUP BY year, month, category""",
    "mart_trend": "SELECT * FROM trend",
    "mart_trend_by_series": f"""
SELECT {TREND_COLUMNS}, {money('avg_price_kes')} AS maize_price_kes, {money('prev')} AS prev_month_price_kes,
  {change('avg_price_kes', 'prev')} AS mom_pct_change, num_observations
FROM (SELECT *, lag(avg_price_kes) OVER (PARTITION BY county, commodity, unit ORDER BY year, month) AS prev
      FROM monthly WHERE lower(commodity) LIKE '%ring%')""",
    "orders_monthly": f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, o_orderpriority,
  {money('avg(o_totalprice)')} AS avg_o_totalprice, {money('min(o_totalprice)')} AS min_o_totalprice,
  {money('max(o_totalprice)')} AS max_o_totalprice, {money('stddev_samp(o_totalprice)')} AS stddev_o_totalprice,
  count(*) AS num_observations, count(DISTINCT o_custkey) AS num_o_custkeys
FROM orders GROUP BY 1, 2, 3""",
    "dim_date": "SELECT * FROM dates",
    "dim_market": f"SELECT * REPLACE ({dbl('latitude', 'longitude')}) FROM markets",
    "dim_market_incremental": _dimension_loads(
        ("market", "district", "county"),
        "source_market_id NULLS LAST, latitude NULLS LAST, longitude NULLS LAST",
        _market_columns(),
    ),
    "dim_commodity": "SELECT * FROM commodities",
    "dim_commodity_incremental": _dimension_loads(
        ("commodity", "unit"), "source_commodity_id NULLS LAST, category NULLS LAST", _commodity_columns()
    ),
    "load_fact": f"""
SELECT * {AS_DOUBLE}, {hash_text('date_id', 'market_id', 'commodity_id', 'pricetype')} AS fact_id FROM facts""",
    "fact_incremental": f"""
SELECT CASE WHEN full_date < DATE '1998-07-01' THEN 1 ELSE 2 END AS load_no, f.* {AS_DOUBLE}
FROM facts f JOIN dates d ON d.date_id = f.date_id""",
    "q1_latest_prices": f"""
SELECT date, market, commodity, unit, {dbl('price')}, currency FROM typed
WHERE market ILIKE '%000000004%' AND price IS NOT NULL
ORDER BY date DESC NULLS FIRST, commodity NULLS LAST, market NULLS LAST, unit NULLS LAST, price NULLS LAST, currency NULLS LAST
LIMIT 50""",
    "q2_commodity_stats": f"""
SELECT commodity, unit, currency, {AVG} AS avg_price, CAST(min(price) AS DOUBLE) AS min_price,
  CAST(max(price) AS DOUBLE) AS max_price, count(*) AS observations
FROM typed WHERE price IS NOT NULL GROUP BY commodity, unit, currency""",
    "q3_wide_commodities": f"""
SELECT commodity, count(DISTINCT market) AS market_count, {AVG} AS avg_price
FROM typed WHERE price IS NOT NULL GROUP BY commodity HAVING count(DISTINCT market) > 10""",
    "q4_county_year": f"""
SELECT admin1 AS county, CAST(year(date) AS INTEGER) AS year, {AVG} AS avg_price, count(*) AS records
FROM typed WHERE price IS NOT NULL AND admin1 IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 5""",
    "q5_recent_monthly": f"""
SELECT CAST(date_trunc('month', date) AS DATE) AS month, commodity, market, {AVG} AS avg_monthly_price
FROM typed WHERE date >= CAST(DATE '2001-11-04' - INTERVAL 12 MONTH AS DATE) AND price IS NOT NULL GROUP BY 1, 2, 3""",
    "q6_yoy": f"""
SELECT year, avg_price, num_records, prev_year_price, {change('avg_price', 'prev_year_price')} AS yoy_pct_change
FROM (SELECT *, lag(avg_price) OVER (ORDER BY year NULLS LAST) AS prev_year_price
  FROM (SELECT CAST(year(date) AS INTEGER) AS year, {AVG} AS avg_price, count(*) AS num_records
        FROM typed WHERE commodity ILIKE '%ring%' AND price IS NOT NULL GROUP BY 1))""",
    "q7_volatility": f"""
SELECT commodity, {AVG} AS avg_price, {money(SPREAD)} AS price_stddev,
  {money(f'{SPREAD} / nullif(avg(CAST(price AS DOUBLE)), 0) * 100')} AS coefficient_of_variation_pct, count(*) AS observations
FROM typed WHERE price IS NOT NULL GROUP BY commodity HAVING count(*) >= 20
ORDER BY coefficient_of_variation_pct DESC NULLS FIRST, commodity NULLS LAST LIMIT 20""",
    "q8_profile": """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE price IS NULL) AS missing_price,
  count(*) FILTER (WHERE market IS NULL) AS missing_market, count(*) FILTER (WHERE commodity IS NULL) AS missing_commodity,
  count(*) FILTER (WHERE date IS NULL) AS missing_date, count(DISTINCT market) AS unique_markets,
  count(DISTINCT commodity) AS unique_commodities, count(DISTINCT admin1) AS unique_counties,
  min(date) AS earliest_date, max(date) AS latest_date FROM typed""",
    "sf_distinct_commodity": "SELECT DISTINCT commodity FROM cleaned WHERE commodity ILIKE '%ring%'",
    "sf_county_commodity_year": f"""
SELECT county, commodity, year, {money('avg(CAST(price_kes AS DOUBLE))')} AS avg_price_kes, count(*) AS records
FROM cleaned WHERE is_valid_price GROUP BY county, commodity, year""",
    "sf_mom": f"""
SELECT year, month, county, {money('mean')} AS avg_maize_price, {money('prev')} AS prev_price, {change('mean', 'prev')} AS mom_pct_change
FROM (SELECT *, lag(mean) OVER (PARTITION BY county ORDER BY year, month) AS prev
  FROM (SELECT year, month, county, avg(CAST(price_kes AS DOUBLE)) AS mean FROM cleaned
        WHERE commodity ILIKE '%ring%' AND is_valid_price GROUP BY year, month, county))""",
    "as_of_count": "SELECT count(*) AS rows FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00'",
    "flatten_notes": " UNION ALL ".join(
        [
            _note("rows without a date", "date"),
            _note("rows without a market", "market"),
            _note("rows without a price", "price_kes"),
        ]
    ),
    "load_metadata": f"SELECT file_name, count(*) AS rows, count(*) FILTER (WHERE is_valid_price) AS valid FROM {FILES} GROUP BY file_name",
    "events_json": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "nb_snapshot": """
SELECT unnest([{'metric': 'rows', 'value': CAST(count(*) AS VARCHAR)}, {'metric': 'columns', 'value': '16'},
  {'metric': 'date_min', 'value': CAST(min(date) AS VARCHAR)}, {'metric': 'date_max', 'value': CAST(max(date) AS VARCHAR)},
  {'metric': 'markets', 'value': CAST(count(DISTINCT market) AS VARCHAR)},
  {'metric': 'commodities', 'value': CAST(count(DISTINCT commodity) AS VARCHAR)},
  {'metric': 'distinct_units', 'value': CAST(count(DISTINCT unit) AS VARCHAR)},
  {'metric': 'missing_admin1', 'value': CAST(count(*) FILTER (WHERE admin1 IS NULL) AS VARCHAR)},
  {'metric': 'missing_admin2', 'value': CAST(count(*) FILTER (WHERE admin2 IS NULL) AS VARCHAR)}], recursive := true) FROM typed""",
    "nb_issues": """
SELECT unnest([{'issue': 'rows_with_missing_county', 'value': count(*) FILTER (WHERE county IS NULL)},
  {'issue': 'rows_with_missing_district', 'value': count(*) FILTER (WHERE district IS NULL)},
  {'issue': 'rows_with_missing_price_kes', 'value': count(*) FILTER (WHERE price_kes IS NULL)},
  {'issue': 'rows_flagged_invalid', 'value': count(*) FILTER (WHERE NOT is_valid_price)},
  {'issue': 'duplicate_business_keys', 'value': count(*) - (SELECT count(*) FROM
    (SELECT DISTINCT date, market, commodity, unit, pricetype FROM cleaned))}], recursive := true) FROM cleaned""",
    "nb_units_per_commodity": """
SELECT commodity, count(DISTINCT unit) AS distinct_units_for_commodity FROM cleaned WHERE commodity IS NOT NULL
GROUP BY commodity ORDER BY 2 DESC NULLS LAST, 1 LIMIT 10""",
    "nb_latest_prices": f"""
SELECT date, market, commodity, unit, {dbl('price_kes')}, currency FROM cleaned WHERE market ILIKE '%000000004%'
ORDER BY date DESC NULLS LAST, commodity NULLS LAST, market NULLS LAST, unit NULLS LAST, cleaned.price_kes NULLS LAST,
  currency NULLS LAST LIMIT 15""",
    "nb_commodity_stats": f"""
SELECT commodity, {money('mean')} AS avg_price_per_kg, {money('low')} AS min_price_per_kg, {money('high')} AS max_price_per_kg, observations
FROM (SELECT commodity, avg(CAST(price_per_kg AS DOUBLE)) AS mean, min(price_per_kg) AS low, max(price_per_kg) AS high,
        count(price_per_kg) AS observations FROM cleaned WHERE price_per_kg IS NOT NULL AND commodity IS NOT NULL GROUP BY commodity)
ORDER BY CAST(mean AS DECIMAL(28,6)) DESC NULLS LAST, commodity NULLS LAST LIMIT 15""",
    "nb_county_year": f"""
SELECT county, year, {money('mean')} AS avg_price_per_kg, records
FROM (SELECT county, year, avg(CAST(price_per_kg AS DOUBLE)) AS mean, count(price_per_kg) AS records FROM cleaned
      WHERE price_per_kg IS NOT NULL GROUP BY county, year)
WHERE records >= 5 ORDER BY year DESC NULLS LAST, CAST(mean AS DECIMAL(28,6)) DESC NULLS LAST, county NULLS LAST LIMIT 20""",
    "nb_trend": f"""
SELECT year, {money('mean')} AS avg_price_per_kg, observations, {money('prev')} AS prev_year_price_per_kg,
  {change('mean', 'prev')} AS yoy_pct_change
FROM (SELECT *, lag(mean) OVER (ORDER BY year) AS prev
  FROM (SELECT year, avg(CAST(price_per_kg AS DOUBLE)) AS mean, count(price_per_kg) AS observations FROM cleaned
        WHERE commodity ILIKE '%ring%' AND price_per_kg IS NOT NULL AND year IS NOT NULL GROUP BY year))
ORDER BY year DESC LIMIT 12""",
    "dash_trend": """
SELECT month_start AS time, county AS metric, maize_price_kes AS value FROM trend
WHERE month_start BETWEEN DATE '1998-01-01' AND DATE '2000-12-31'""",
    "dash_avg_by_commodity": BY_COMMODITY,
    "dash_price_band": f"""
SELECT metric, value, CASE WHEN value >= 300 THEN 'red' WHEN value >= 100 THEN 'yellow' WHEN value IS NOT NULL THEN 'green' END AS band
FROM ({BY_COMMODITY})""",
    "dash_total_records": "SELECT CAST(sum(num_observations) AS BIGINT) AS value FROM monthly",
    "dash_unique_markets": "SELECT count(DISTINCT market_name) AS value FROM markets",
    "dash_unique_commodities": "SELECT count(DISTINCT commodity_name) AS value FROM commodities",
    "dash_latest_months": """
SELECT month_start, county, commodity, avg_price_kes, avg_price_per_kg, num_observations FROM monthly
ORDER BY month_start DESC NULLS FIRST, county NULLS LAST, commodity NULLS LAST, unit NULLS LAST LIMIT 200""",
    "clean_counters": COUNTERS,
    "broken_keys": " UNION ALL ".join(
        [_unique("standard", "standard", "date,market,commodity,pricetype"), _unique("standard", "standard", "market,unit")]
    ),
    "broken_relationship": f"""
SELECT 'fact' AS table_name, 'relationship' AS test, 'date_id' AS column_name, count(*) AS violations, count(*) = 0 AS passed
FROM facts WHERE date_id NOT IN (SELECT date_id FROM dates WHERE full_date >= DATE '1998-07-01')
UNION ALL
SELECT 'fact', 'relationship', 'market_id', count(*), count(*) = 0
FROM facts WHERE market_id NOT IN (SELECT market_id FROM markets WHERE source_market_id % 5 <> 0)""",
    "quality_report": QUALITY,
    "test_not_null": " UNION ALL ".join(
        [
            _tested(
                "staging",
                "staged",
                "not_null",
                {"price_date": "date IS NULL", "market": "market IS NULL", "commodity": "commodity IS NULL",
                 "price_kes": "price_kes IS NULL AND is_valid_price"},
            ),
            _null_tests("view", "shown", ("date", "market", "commodity", "price_kes")),
            _null_tests("monthly", "monthly", ("year", "month", "county", "commodity", "avg_price_kes", "num_observations")),
            _null_tests("trend", "trend", ("year", "county", "maize_price_kes")),
        ]
    ),
    "test_accepted_range": _tested("view", "shown", "accepted_range", {"price_kes": "price_kes <= 0"})
    + " UNION ALL "
    + _tested("monthly", "monthly", "accepted_range", {"avg_price_kes": "avg_price_kes <= 0"}),
    "test_accepted_values": _tested("monthly", "monthly", "accepted_values", {"month": "month NOT BETWEEN 1 AND 12"}),
    "test_unique": " UNION ALL ".join(
        [
            _unique("staging", "staged", "price_date,market,commodity,unit,pricetype", "date, market, commodity, unit, pricetype"),
            _unique("dim_market", "markets", "market_name,district,county"),
            _unique("dim_market", "markets", "market_id"),
            _unique("dim_commodity", "commodities", "commodity_name,unit"),
            _unique("dim_commodity", "commodities", "commodity_id"),
            _unique("fact", "facts", "date_id,market_id,commodity_id,pricetype"),
            _unique("monthly", "monthly", "year,month,month_start,county,commodity,unit"),
        ]
    ),
    "test_relationship": " UNION ALL ".join(
        [_orphans("date_id", "dates"), _orphans("market_id", "markets"), _orphans("commodity_id", "commodities")]
    ),
    "mart_monthly_merged": "SELECT * FROM monthly",
    "scan_broken": """
SELECT fault, count(*) AS n, CAST(coalesce(sum(letters), 0) AS BIGINT) AS letters FROM (
  SELECT CASE WHEN doc_id % 3 = 1 THEN 'quotation mark not closed' WHEN doc_id % 3 = 2 AND commas > 0 THEN concat(commas + 3, ' fields, not 3') END AS fault,
         CASE WHEN doc_id % 3 = 0 THEN length(replace(body, 'a', 'a"')) WHEN doc_id % 3 = 2 AND commas = 0 THEN length(body) END AS letters
  FROM (SELECT doc_id, body, length(body) - length(replace(body, ',', '')) AS commas
        FROM (SELECT doc_id, unnest(string_split(replace(text, '"', ''), chr(10))) AS body FROM documents))
) GROUP BY fault""",
    "tests_by_year": """
SELECT year, 'standard' AS table_name, 'not_null' AS test, 'unit' AS column_name, count(*) FILTER (WHERE unit IS NULL) AS violations,
       count(*) FILTER (WHERE unit IS NULL) = 0 AS passed FROM standard GROUP BY year
UNION ALL
SELECT year, 'standard', 'accepted_values', 'month', count(*) FILTER (WHERE month NOT BETWEEN 2 AND 11), count(*) FILTER (WHERE month NOT BETWEEN 2 AND 11) = 0
FROM standard GROUP BY year
UNION ALL
SELECT year, 'standard', 'unique', 'date,market,commodity,pricetype', count(*) FILTER (WHERE n > 1), count(*) FILTER (WHERE n > 1) = 0
FROM (SELECT year, count(*) AS n FROM standard GROUP BY year, date, market, commodity, pricetype) GROUP BY year
UNION ALL
SELECT CAST(date_id // 10000 AS INTEGER), 'fact', 'relationship', 'market_id', count(*) FILTER (WHERE orphan), count(*) FILTER (WHERE orphan) = 0
FROM (SELECT date_id, market_id NOT IN (SELECT market_id FROM markets WHERE source_market_id % 5 <> 0) AS orphan FROM facts) GROUP BY 1""",
}


def _does_not_fit(c: str) -> str:
    return f"{c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL(12,4)) IS NULL"


_PRICES = ("price_kes", "price_usd", "price_per_kg")
_MISSING = {"price_date": "date", "year": "year", "month": "month", "market": "market", "commodity": "commodity"}
_REASONS = [f"CASE WHEN {c} IS NULL THEN '{name} is missing' END" for name, c in _MISSING.items()]
_REASONS += [f"CASE WHEN {_does_not_fit(c)} THEN '{c} does not fit decimal(12,4)' END" for c in _PRICES]

# Over the odd observations.
ODD_QUERIES = {
    "staging_rejects_odd": f"""
SELECT date AS price_date, market, commodity, unit, pricetype, concat_ws(', ', {', '.join(_REASONS)}) AS reason FROM cleaned
WHERE date IS NULL OR market IS NULL OR commodity IS NULL OR {' OR '.join(f'({_does_not_fit(c)})' for c in _PRICES)}""",
    "clean_prices_odd": QUERIES["clean_prices"],
    "clean_derive_odd": QUERIES["clean_derive"],
    "clean_counters_odd": COUNTERS,
    "broken_columns": " UNION ALL ".join(
        [
            _null_tests("standard", "standard", ("date", "market", "commodity", "price_kes", "unit")),
            _tested("standard", "standard", "accepted_range", {"price_kes": "price_kes <= 0", "year": "year < 1994 OR year > 1996"}),
            _tested("standard", "standard", "accepted_values", {"month": "month NOT BETWEEN 2 AND 11"}),
        ]
    ),
}


def oracles() -> dict[str, str]:
    broken = {"quality_report_broken": sql(QUALITY.replace("FROM cleaned", "FROM standard"), odd=True)}
    return {name: sql(query) for name, query in QUERIES.items()} | {name: sql(query, odd=True) for name, query in ODD_QUERIES.items()} | broken
