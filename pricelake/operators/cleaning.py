"""The cleaning steps: each takes a DataFrame and returns one, and together they are one lazy plan.

Steps skip columns the input does not have. Rows are never dropped for being invalid, only flagged.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.amounts import parse_amount, parse_integer
from ..functions.dates import DAY_FORMAT, parse_day
from ..functions.text import null_texts, squash_blanks, title_words
from ..schemas import (
    CLEAN_KEY,
    CLEAN_NAMES,
    CODE_COLUMNS,
    COORDINATE,
    NAME_COLUMNS,
    PRICE_COLUMNS,
    UNIT_KILOGRAMS,
    WIDE_PRICE,
)


def standard_names(df: DataFrame, names: Mapping[str, str] = CLEAN_NAMES) -> DataFrame:
    """Trim and lower-case the header, then apply the renames whose column is present."""
    header = [c.strip().lower() for c in df.columns]
    return df.toDF(*[names.get(c, c) for c in header])


def parse_dates(df: DataFrame, columns: Iterable[str] = ("date",), fmt: str = DAY_FORMAT) -> DataFrame:
    return df.withColumns({c: parse_day(F.col(c), fmt) for c in columns if c in df.columns})


def clean_texts(
    df: DataFrame,
    names: Iterable[str] = NAME_COLUMNS,
    codes: Iterable[str] = CODE_COLUMNS,
    strict_tokens: bool = False,
) -> DataFrame:
    """Squash blanks in all text columns, capitalise the names, and blank out null texts last."""
    names = [c for c in names if c in df.columns]
    texts = [*names, *[c for c in codes if c in df.columns]]
    # One projection per step, so that no step repeats the one before it inside its tests.
    squashed = df.withColumns({c: F.trim(c) for c in texts}).withColumns({c: squash_blanks(F.col(c)) for c in texts})
    titled = squashed.withColumns({c: title_words(F.col(c)) for c in names})
    return titled.withColumns({c: null_texts(F.col(c), strict_tokens) for c in texts})


def parse_prices(df: DataFrame, columns: Iterable[str] = PRICE_COLUMNS, dtype: str = WIDE_PRICE) -> DataFrame:
    """Numbers from text; what is not a number becomes NULL, and so does a price of zero."""
    return df.withColumns({c: F.nullifzero(parse_amount(F.col(c), dtype)) for c in columns if c in df.columns})


def derive_parts(
    df: DataFrame,
    date: str | None = "date",
    integers: Iterable[str] = ("source_market_id", "source_commodity_id"),
    coordinates: Iterable[str] = ("latitude", "longitude"),
) -> DataFrame:
    """Year and month of the date; typed source ids and coordinates."""
    exprs = {}
    if date in df.columns:
        exprs |= {"year": F.year(date), "month": F.month(date)}
    exprs |= {c: parse_integer(F.col(c)) for c in integers if c in df.columns}
    exprs |= {c: F.col(c).try_cast(COORDINATE) for c in coordinates if c in df.columns}
    return df.withColumns(exprs)


def price_per_unit(
    df: DataFrame,
    price: str = "price_kes",
    unit: str = "unit",
    into: str = "price_per_kg",
    factors: Mapping[str, int] = UNIT_KILOGRAMS,
) -> DataFrame:
    """Price over the factor of its unit; NULL for units without one."""
    if price not in df.columns or unit not in df.columns:
        return df
    table = F.create_map(*[F.lit(x) for pair in factors.items() for x in pair])
    factor = F.try_element_at(table, F.lower(F.trim(unit)))
    return df.withColumn(into, (F.col(price) / factor).cast(WIDE_PRICE))


def flag_valid(
    df: DataFrame, price: str = "price_kes", date: str = "date", into: str = "is_valid_price"
) -> DataFrame:
    """True where the price is present and above zero and the date is present; never NULL."""
    valid = F.lit(True)
    if price in df.columns:
        valid = valid & F.coalesce(F.col(price) > 0, F.lit(False))
    if date in df.columns:
        valid = valid & F.col(date).isNotNull()
    return df.withColumn(into, valid)


def keep_last(df: DataFrame, keys: Iterable[str] = CLEAN_KEY, sequence: Iterable[str] = ("row_seq",)) -> DataFrame:
    """One row per key, the last in ``sequence`` order; NULL key parts are equal.

    ``row_number() = 1`` lets Spark keep one row per key and task before the shuffle, so a key that
    holds a large share of the rows sends one row per task and not its whole group.

    The row's place in its task settles ties of ``sequence``. It also holds back filters on the keys that come after this step:
    Catalyst would move them below the cleaning of the texts, and each text would be cleaned once more for its filter.
    """
    present = [k for k in keys if k in df.columns]
    order = [F.col(c).desc_nulls_last() for c in (*sequence, "_place")]
    latest = F.row_number().over(Window.partitionBy(*present).orderBy(*order))
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    return placed.withColumn("_rank", latest).where("_rank = 1").drop("_rank", "_place")


def clean(
    df: DataFrame,
    keys: Iterable[str] = CLEAN_KEY,
    sequence: Iterable[str] = ("row_seq",),
    strict_tokens: bool = False,
    fmt: str = DAY_FORMAT,
) -> DataFrame:
    """All steps in order; the result keeps the sequence columns that are not cleaned columns."""
    keys, sequence = list(keys), list(sequence)
    valued = clean_values(df, strict_tokens, fmt)
    if {*keys, *sequence} <= {*valued.columns}:
        return valued.transform(keep_last, keys=keys, sequence=sequence).transform(derive_values)
    # A key may be a column that is derived, such as the year.
    return valued.transform(derive_values).transform(keep_last, keys=keys, sequence=sequence)


def clean_values(df: DataFrame, strict_tokens: bool = False, fmt: str = DAY_FORMAT) -> DataFrame:
    """The row-wise steps on the columns that come with a row."""
    return (
        df.transform(standard_names)
        .transform(parse_dates, fmt=fmt)
        .transform(clean_texts, strict_tokens=strict_tokens)
        .transform(parse_prices)
        .transform(derive_parts, date=None)
    )


def derive_values(df: DataFrame) -> DataFrame:
    """The row-wise steps that add columns. ``keep_last`` needs none of them, so they come after its sorts and its shuffle."""
    return (
        df.transform(derive_parts, integers=(), coordinates=())
        .transform(price_per_unit)
        .transform(flag_valid)
    )


def standardise(df: DataFrame, strict_tokens: bool = False, fmt: str = DAY_FORMAT) -> DataFrame:
    """Every row-wise step: no shuffle, row count unchanged."""
    return df.transform(clean_values, strict_tokens=strict_tokens, fmt=fmt).transform(derive_values)


def counters(df: DataFrame, keys: Iterable[str] = CLEAN_KEY, fmt: str = DAY_FORMAT, kept: int | None = None) -> DataFrame:
    """``counter, rows``: what cleaning takes away. Dates and prices that fail or are zero, and rows that repeat a key.

    ``df`` holds the observations as scanned. Missing values are not failures, so the two can be told apart. With ``kept``,
    the number of rows that cleaning left, repeats are counted without cleaning again.
    """
    named = standard_names(df)
    measures = {}
    if "date" in named.columns:
        measures["dates_failed"] = F.count_if(F.col("date").isNotNull() & parse_day(F.col("date"), fmt).isNull())
    for c in PRICE_COLUMNS:
        if c in named.columns:
            measures[f"{c}_failed"] = F.count_if(F.col(c).isNotNull() & parse_amount(F.col(c)).isNull())
            measures[f"{c}_zero"] = F.count_if(parse_amount(F.col(c)) == 0)
    if kept is not None:
        measures["duplicates_removed"] = F.count(F.lit(1)) - kept
    seen = named.agg(*[m.alias(name) for name, m in measures.items()])
    counted = seen.select(F.inline(F.array(*[F.struct(F.lit(name).alias("counter"), F.col(name).alias("rows")) for name in measures])))
    if kept is not None:
        return counted
    cleaned = standardise(df, fmt=fmt)
    present = [k for k in keys if k in cleaned.columns]
    repeats = cleaned.groupBy(*present).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows"))
    return counted.unionByName(repeats.select(F.lit("duplicates_removed").alias("counter"), "rows"))
