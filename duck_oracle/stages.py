"""The stages of the data as named SQL blocks; ``sql`` puts those a query needs in a WITH clause."""

from __future__ import annotations

import re

ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
TEXTS = (
    "date", "admin1", "admin2", "market", "market_id", "commodity_id", "latitude", "longitude", "category", "commodity", "unit",
    "priceflag", "pricetype", "currency", "price", "usdprice",
)
# Texts a CSV reader takes for a missing value.
TOKENS = """'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA',
  'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"""


def money(expr: str, places: int = 2) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(28,6)), {places}) AS DOUBLE)"


def change(current: str, previous: str) -> str:
    return money(f"({current} - {previous}) / nullif({previous}, 0) * 100")


def _squash(c: str) -> str:
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


def _title(c: str) -> str:
    words = f"regexp_extract_all(lower({c}), '[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), '')"


def _text(c: str, title: bool) -> str:
    return f"CASE WHEN lower({c}) IN ('nan', 'none', '') THEN NULL ELSE {_title(c) if title else c} END"


def _whole(c: str) -> str:
    number = f"TRY_CAST({c} AS DECIMAL(38,9))"
    return f"CASE WHEN {number} = floor({number}) THEN TRY_CAST({number} AS INTEGER) END"


def hash_text(*columns: str) -> str:
    def part(c: str) -> str:
        text = f"CAST({c} AS VARCHAR)"
        return f"coalesce(CAST(length({text}) AS VARCHAR) || ':' || {text} || ';', '-;')"

    return "md5(" + " || ".join(part(c) for c in columns) + ")"


def hash_key(*columns: str) -> str:
    return f"CAST('0x' || substr({hash_text(*columns)}, 1, 15) AS BIGINT)"


OBSERVED = """
SELECT
  l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_orderkey % 211 = 0 THEN 'not-a-date' WHEN l_orderkey % 223 = 0 THEN NULL
       ELSE concat(CAST(year(l_shipdate) AS VARCHAR(4)), '-', lpad(CAST(month(l_shipdate) AS VARCHAR(2)), 2, '0'), '-', lpad(CAST(day(l_shipdate) AS VARCHAR(2)), 2, '0')) END AS date,
  CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE concat('  ', lower(replace(n_name, '_', '-'))) END AS admin1,
  CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE concat(r_name, '   (sub) ') END AS admin2,
  CASE WHEN l_orderkey % 401 = 0 THEN NULL ELSE concat('  ', s_name, ' town''s  mkt') END AS market,
  CAST(l_suppkey AS VARCHAR) || CASE WHEN l_suppkey % 7 = 0 THEN '.0' ELSE '' END AS market_id,
  CAST(CAST(l_suppkey % 180 - 90 AS DECIMAL(10,6)) AS VARCHAR(20)) AS latitude,
  CAST(CAST(l_suppkey % 360 - 180 AS DECIMAL(10,6)) AS VARCHAR(20)) AS longitude,
  CASE WHEN l_partkey % 19 = 0 THEN '' ELSE p_type END AS category,
  concat(' ', p_name, '  (white) ') AS commodity,
  CAST(l_partkey AS VARCHAR) || CASE WHEN l_partkey % 7 = 0 THEN '.0' ELSE '' END AS commodity_id,
  CASE CAST(l_quantity AS INT) % 9 WHEN 0 THEN 'KG' WHEN 1 THEN '90 KG' WHEN 2 THEN ' 50  kg ' WHEN 3 THEN '2 KG'
       WHEN 4 THEN '200 G' WHEN 5 THEN 'L' WHEN 6 THEN 'Head' WHEN 7 THEN '100 KG' ELSE NULL END AS unit,
  CASE l_linestatus WHEN 'O' THEN 'actual' ELSE 'aggregate' END AS priceflag,
  CASE l_returnflag WHEN 'A' THEN 'Retail' WHEN 'N' THEN 'Wholesale' ELSE 'None' END AS pricetype,
  'KES' AS currency,
  CASE WHEN l_orderkey % 101 = 0 THEN '0' WHEN l_orderkey % 103 = 0 THEN 'n.a.' WHEN l_orderkey % 107 = 0 THEN NULL
       ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,4)) AS VARCHAR(20)) END AS price,
  CASE WHEN l_orderkey % 109 = 0 THEN NULL
       ELSE CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.0077 AS DECIMAL(12,4)) AS VARCHAR(20)) END AS usdprice
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
"""

_NAMES = {"admin1": "county", "admin2": "district", "market": "market", "category": "category", "commodity": "commodity"}
_CODES = ("unit", "priceflag", "pricetype", "currency")

STAGES = {
    "observed": OBSERVED,
    "scanned": f"""
SELECT * REPLACE ({', '.join(f"CASE WHEN {c} IN ({TOKENS}) THEN NULL ELSE {c} END AS {c}" for c in TEXTS)})
FROM observed""",
    "typed": """
SELECT * REPLACE (CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS date,
                  TRY_CAST(price AS DECIMAL(28,4)) AS price, TRY_CAST(usdprice AS DECIMAL(28,4)) AS usdprice)
FROM scanned""",
    "squashed": f"""
SELECT * REPLACE ({', '.join(f'{_squash(c)} AS {c}' for c in (*_NAMES, *_CODES))}) FROM scanned""",
    "texts": f"""
SELECT {ORDER}, CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS date,
  {', '.join(f'{_text(c, True)} AS {n}' for c, n in _NAMES.items())},
  {', '.join(f'{_text(c, False)} AS {c}' for c in _CODES)},
  {_whole('market_id')} AS source_market_id, {_whole('commodity_id')} AS source_commodity_id,
  TRY_CAST(latitude AS DECIMAL(10,6)) AS latitude, TRY_CAST(longitude AS DECIMAL(10,6)) AS longitude,
  nullif(TRY_CAST(price AS DECIMAL(28,4)), 0) AS price_kes, nullif(TRY_CAST(usdprice AS DECIMAL(28,4)), 0) AS price_usd
FROM squashed""",
    "standard": """
SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  CAST(CAST(price_kes AS DOUBLE) / CASE lower(unit) WHEN 'kg' THEN 1 WHEN '1 kg' THEN 1 WHEN '100 kg' THEN 100
    WHEN '90 kg' THEN 90 WHEN '50 kg' THEN 50 WHEN '25 kg' THEN 25 WHEN '2 kg' THEN 2 END AS DECIMAL(28,4)) AS price_per_kg,
  price_kes IS NOT NULL AND coalesce(price_kes, 0) > 0 AND date IS NOT NULL AS is_valid_price
FROM texts""",
    "cleaned": f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY date, market, commodity, pricetype
    ORDER BY {', '.join(f'{c} DESC NULLS LAST' for c in (*ORDER.split(', '), 'price_kes', 'unit', 'priceflag'))}) AS rn
  FROM standard) WHERE rn = 1""",
    "staged": """
SELECT * FROM cleaned WHERE date IS NOT NULL AND market IS NOT NULL AND commodity IS NOT NULL""",
    "shown": """
SELECT date, year, month, coalesce(county, 'Unknown') AS county, coalesce(district, 'Unknown') AS district, market,
  coalesce(category, 'Uncategorized') AS category, commodity, unit, pricetype, currency, price_kes, price_usd,
  price_per_kg, is_valid_price
FROM staged WHERE is_valid_price""",
    "monthly": f"""
SELECT year, month, CAST(date_trunc('month', date) AS DATE) AS month_start, county, commodity, unit,
  {money('avg(CAST(price_kes AS DOUBLE))')} AS avg_price_kes, {money('avg(CAST(price_usd AS DOUBLE))')} AS avg_price_usd,
  {money('avg(CAST(price_per_kg AS DOUBLE))')} AS avg_price_per_kg, {money('min(price_kes)')} AS min_price_kes,
  {money('max(price_kes)')} AS max_price_kes, {money('stddev_samp(CAST(price_kes AS DOUBLE))')} AS stddev_price_kes,
  count(*) AS num_observations, count(DISTINCT market) AS num_markets
FROM shown GROUP BY ALL""",
    "trend": f"""
SELECT year, month, month_start, county, commodity, unit, {money('avg_price_kes')} AS maize_price_kes,
  {money('prev')} AS prev_month_price_kes, {change('avg_price_kes', 'prev')} AS mom_pct_change, num_observations
FROM (SELECT *, lag(avg_price_kes) OVER (PARTITION BY county ORDER BY year, month, commodity NULLS LAST, unit NULLS LAST) AS prev
      FROM monthly WHERE lower(commodity) LIKE '%ring%')""",
    "markets": f"""
SELECT {hash_key('market', 'district', 'county')} AS market_id, market AS market_name, district, county,
  source_market_id, latitude, longitude
FROM (SELECT *, row_number() OVER (PARTITION BY market, district, county
        ORDER BY source_market_id NULLS LAST, latitude NULLS LAST, longitude NULLS LAST) AS rn FROM staged) WHERE rn = 1""",
    "commodities": f"""
SELECT {hash_key('commodity', 'unit')} AS commodity_id, commodity AS commodity_name, category, unit, source_commodity_id
FROM (SELECT *, row_number() OVER (PARTITION BY commodity, unit
        ORDER BY source_commodity_id NULLS LAST, category NULLS LAST) AS rn FROM staged) WHERE rn = 1""",
    "dates": """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS full_date, CAST(year(d) AS INTEGER) AS year,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
  CAST(day(d) AS INTEGER) AS day_of_month, strftime(d, '%m-%d') = '01-01' AS is_year_start,
  strftime(d, '%m-%d') = '12-31' AS is_year_end
FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS d FROM staged)""",
    "facts": """
SELECT date_id, market_id, commodity_id, s.pricetype, price_kes, price_usd, price_per_kg, is_valid_price
FROM staged s JOIN dates ON full_date = s.date
  JOIN markets m ON m.market_name = s.market AND m.district IS NOT DISTINCT FROM s.district AND m.county IS NOT DISTINCT FROM s.county
  JOIN commodities c ON c.commodity_name = s.commodity AND c.unit IS NOT DISTINCT FROM s.unit
WHERE is_valid_price
QUALIFY row_number() OVER (PARTITION BY date_id, market_id, commodity_id, s.pricetype
  ORDER BY price_kes DESC NULLS LAST, price_usd DESC NULLS LAST, price_per_kg DESC NULLS LAST) = 1""",
}


def _needs(text: str) -> list[str]:
    return [s for s in STAGES if re.search(rf"\b(FROM|JOIN)\s+{s}\b", text)]


# The observations with negative and too large prices and ids that are no whole numbers.
ODD = """
SELECT * REPLACE (
  CASE WHEN l_orderkey % 13 = 0 THEN CAST(CAST(CAST(real_price AS DECIMAL(12,4)) * 100000 AS DECIMAL(28,4)) AS VARCHAR)
       WHEN l_orderkey % 11 = 0 THEN CAST(-CAST(real_price AS DECIMAL(12,4)) AS VARCHAR) ELSE price END AS price,
  CASE WHEN l_orderkey % 5 = 0 THEN CAST(l_suppkey AS VARCHAR) || '.5' ELSE market_id END AS market_id)
FROM ({})"""


def sql(query: str, odd: bool = False) -> str:
    """``query`` with every stage it reads, directly or not, in a WITH clause."""
    wanted: set[str] = set()
    todo = _needs(query)
    while todo:
        stage = todo.pop()
        if stage not in wanted:
            wanted.add(stage)
            todo += _needs(STAGES[stage])
    changed = {"observed": ODD.format(OBSERVED.replace("FROM lineitem", ", l_extendedprice AS real_price FROM lineitem"))} if odd else {}
    blocks = [f"{s} AS ({(STAGES | changed)[s].strip()}\n)" for s in STAGES if s in wanted]
    return ("WITH " + ",\n".join(blocks) + "\n" if blocks else "") + query.strip()
