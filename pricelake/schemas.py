"""Column presets, table schemas and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = "decimal(12,4)"
# Prices while they are cleaned: no number of a file is lost because the table could not hold it.
WIDE_PRICE = "decimal(28,4)"
COORDINATE = "decimal(10,6)"

# Input header, in file order.
RAW_COLUMNS = (
    "date", "admin1", "admin2", "market", "market_id", "latitude", "longitude", "category",
    "commodity", "commodity_id", "unit", "priceflag", "pricetype", "currency", "price", "usdprice",
)

# Input names that change when cleaned (the others keep their name).
CLEAN_NAMES = {
    "admin1": "county",
    "admin2": "district",
    "market_id": "source_market_id",
    "commodity_id": "source_commodity_id",
    "price": "price_kes",
    "usdprice": "price_usd",
}

# Texts a CSV reader takes for a missing value.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Texts that mean "missing" after the string clean-up.
NULL_TEXTS = ("nan", "None", "")

# Kilograms per unit, by lower-case unit name.
UNIT_KILOGRAMS = {"kg": 1, "1 kg": 1, "100 kg": 100, "90 kg": 90, "50 kg": 50, "25 kg": 25, "2 kg": 2}

# Columns by kind, and the keys of the tables.
NAME_COLUMNS = ("county", "district", "market", "commodity", "category")
CODE_COLUMNS = ("unit", "priceflag", "pricetype", "currency")
PRICE_COLUMNS = ("price_kes", "price_usd")

CLEAN_KEY = ("date", "market", "commodity", "pricetype")
STAGING_KEY = ("price_date", "market", "commodity", "unit", "pricetype")
# Columns of the second target, before their names go to upper case.
MIRROR_COLUMNS = (
    "date", "year", "month", "county", "district", "market", "category", "commodity", "unit", "pricetype", "currency",
    "price_kes", "price_usd", "price_per_kg", "is_valid_price",
)
STAGING_REQUIRED = ("price_date", "year", "month", "market", "commodity")
MARKET_KEY = ("market_name", "district", "county")
COMMODITY_KEY = ("commodity_name", "unit")
FACT_KEY = ("date_id", "market_id", "commodity_id", "pricetype")
MONTHLY_KEY = ("year", "month", "month_start", "county", "commodity", "unit")


def _table(columns: dict[str, str | T.DataType]) -> T.StructType:
    schema = T.StructType()
    for name, dtype in columns.items():
        schema = schema.add(name, dtype)
    return schema


# A file is known by its full path and the time it was last written: names repeat from folder to folder.
FILE_KEY = ("source_path", "file_time")
_FILE = {"source_path": "string", "file_time": "timestamp"}
RAW_TABLE = _table({c: "string" for c in RAW_COLUMNS} | {"source_file": "string"} | _FILE | {"loaded_at": "timestamp_ntz"})

# Names and types of the stored tables.
_STAGED = {
    "price_date": "date",
    "month": "integer",
    "county": "string",
    "district": "string",
    "market": "string",
    "source_market_id": "integer",
    "latitude": COORDINATE,
    "longitude": COORDINATE,
    "category": "string",
    "commodity": "string",
    "source_commodity_id": "integer",
    "unit": "string",
    "priceflag": "string",
    "pricetype": "string",
    "currency": "string",
    "price_kes": PRICE,
    "price_usd": PRICE,
    "price_per_kg": PRICE,
    "source_file": "string",
    "is_valid_price": "boolean",
}
_STAMPED = {"loaded_at": "timestamp_ntz", "year": "integer"}

STAGING_TABLE = _table(_STAGED | _STAMPED)
REJECTS_TABLE = _table(
    _STAGED | {c: WIDE_PRICE for c in (*PRICE_COLUMNS, "price_per_kg")} | {"reason": "string", "line": "string"} | _FILE | _STAMPED
)

DIM_MARKET_TABLE = _table(
    {
        "market_id": "long",
        "market_name": "string",
        "district": "string",
        "county": "string",
        "source_market_id": "integer",
        "latitude": COORDINATE,
        "longitude": COORDINATE,
        "created_at": "timestamp_ntz",
    }
)

DIM_COMMODITY_TABLE = _table(
    {
        "commodity_id": "long",
        "commodity_name": "string",
        "category": "string",
        "unit": "string",
        "source_commodity_id": "integer",
        "created_at": "timestamp_ntz",
    }
)

DIM_DATE_TABLE = _table(
    {
        "date_id": "integer",
        "full_date": "date",
        "year": "integer",
        "quarter": "integer",
        "month": "integer",
        "month_name": "string",
        "day_of_month": "integer",
        "is_year_start": "boolean",
        "is_year_end": "boolean",
    }
)

FACT_TABLE = _table(
    {
        "date_id": "integer",
        "market_id": "long",
        "commodity_id": "long",
        "price_kes": PRICE,
        "price_usd": PRICE,
        "price_per_kg": PRICE,
        "pricetype": "string",
        "is_valid_price": "boolean",
        "loaded_at": "timestamp_ntz",
        "year": "integer",
    }
)

METADATA_TABLE = _table({"file_name": "string", "loaded_at": "timestamp_ntz", "stats": "variant"})

# Steps of the loads, the files they brought, and counts of violations by test and year.
JOURNAL_TABLE = _table(
    {"load_id": "string", "step": "string", "moment": "timestamp_ntz", "years": T.ArrayType(T.IntegerType()), "detail": "string", "at": "timestamp_ntz"}
)
FILES_TABLE = _table(_FILE | {"loaded_at": "timestamp_ntz", "load_id": "string"})
TESTS_TABLE = _table(
    {"table_name": "string", "test": "string", "column_name": "string", "year": "integer", "violations": "long", "tested_at": "timestamp_ntz"}
)
