"""Data-quality report, gate, column tests and table constraints."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import CLEAN_KEY

# Limits of the checks.
MAX_NULL_PCT = 30
MIN_VALID_PCT = 70
FIRST_YEAR = 2000
LAST_YEAR = 2030
REQUIRED_COLUMNS = ("date", "market", "commodity", "price_kes")

CRITICAL, WARNING = "critical", "warning"


class QualityError(RuntimeError):
    """A critical check failed; nothing after the gate may run."""


def _percent(part: Column, whole: Column, digits: int) -> Column:
    share = F.round((part * 100 / F.nullif(whole, F.lit(0))).cast("decimal(28,6)"), digits)
    return share.cast(f"decimal(8,{digits})")


def _measures(df: DataFrame, keys: Sequence[str], price: str, date: str, flag: str) -> DataFrame:
    """One row with everything the checks need, from one scan and one shuffle of grouped keys.

    Rows are counted per key first (map-side combine), so duplicates and all other measures come out
    of the same pass and a hot key adds one row per task.
    """
    has = set(df.columns)
    per_key = {
        "n": F.count(F.lit(1)),
        "nulls": F.count_if(F.col(price).isNull()) if price in has else F.lit(0),
        "negative": F.count_if(F.col(price) < 0) if price in has else F.lit(0),
        "valid": F.count_if(F.col(flag)) if flag in has else F.lit(0),
        "first": F.min(date) if date in has else F.lit(None).cast("date"),
        "last": F.max(date) if date in has else F.lit(None).cast("date"),
    }
    grouped = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(
        *[c.alias(name) for name, c in per_key.items()]
    )
    total = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("nulls", "negative", "valid")]
    return grouped.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        *total,
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeats"),
    )


def report(
    df: DataFrame,
    keys: Iterable[str] = CLEAN_KEY,
    price: str = "price_kes",
    date: str = "date",
    flag: str = "is_valid_price",
    required: Iterable[str] = REQUIRED_COLUMNS,
) -> DataFrame:
    """One row per check: name, passed, level, detail, value, status (PASS, FAIL or WARN)."""
    present = [k for k in keys if k in df.columns]
    missing = sorted(set(required) - set(df.columns))
    m = _measures(df, present, price, date, flag)
    rows = F.col("rows")

    def check(name: str, passed: Column, level: Column | str, detail: Column, value: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
            (F.lit(level) if isinstance(level, str) else level).alias("level"),
            detail.alias("detail"),
            value.cast("string").alias("value"),
        )

    absent = F.lit(None).cast("string")
    checks = [
        check("not_empty", rows > 0, CRITICAL, F.concat(F.lit("rows: "), rows), rows),
        check(
            "required_columns",
            F.lit(not missing),
            CRITICAL,
            F.lit("missing columns: " + ", ".join(missing) if missing else "no column missing"),
            F.lit(",".join(missing)),
        ),
    ]
    null_pct = F.col("nulls") * 100 / F.nullif(rows, F.lit(0))
    if price in df.columns:
        checks.append(
            check(
                "price_nulls",
                null_pct < MAX_NULL_PCT,
                F.when(null_pct >= MAX_NULL_PCT, CRITICAL).otherwise(WARNING),
                F.concat(F.lit(f"% of {price} null: "), F.coalesce(_percent(F.col("nulls"), rows, 1).cast("string"), F.lit("-"))),
                _percent(F.col("nulls"), rows, 2),
            )
        )
    else:
        checks.append(check("price_nulls", F.lit(False), CRITICAL, F.lit(f"no column {price}"), absent))

    no_dates = F.col("first").isNull()
    checks.append(
        check(
            "date_range",
            (F.year("first") >= FIRST_YEAR) & (F.year("last") <= LAST_YEAR),
            F.when(no_dates, CRITICAL).otherwise(WARNING),
            F.when(no_dates, "no valid date").otherwise(F.concat(F.lit("dates: "), "first", F.lit(" to "), "last")),
            F.concat("first", F.lit(".."), "last"),
        )
    )
    if price in df.columns:
        negative = F.col("negative")
        checks.append(
            check("negative_prices", negative == 0, CRITICAL, F.concat(F.lit("negative prices: "), negative), negative)
        )
    else:
        checks.append(check("negative_prices", F.lit(False), CRITICAL, F.lit(f"no column {price}"), absent))

    repeats = F.col("repeats")
    if present:
        checks.append(
            check("duplicate_keys", repeats == 0, WARNING, F.concat(F.lit("rows repeating a key: "), repeats), repeats)
        )
    else:
        checks.append(check("duplicate_keys", F.lit(True), WARNING, F.lit("no key column"), absent))

    if flag in df.columns:
        checks.append(
            check(
                "valid_price_ratio",
                F.col("valid") * 100 / F.nullif(rows, F.lit(0)) >= MIN_VALID_PCT,
                WARNING,
                F.concat(F.lit("% of rows valid: "), F.coalesce(_percent(F.col("valid"), rows, 1).cast("string"), F.lit("-"))),
                _percent(F.col("valid"), rows, 2),
            )
        )
    else:
        checks.append(check("valid_price_ratio", F.lit(True), WARNING, F.lit(f"no column {flag}"), absent))

    status = F.when(F.col("passed"), "PASS").when(F.col("level") == CRITICAL, "FAIL").otherwise("WARN")
    return m.select(F.inline(F.array(*checks))).withColumn("status", status)


def gate(checks: DataFrame) -> list:
    """Raise if a critical check failed; returns the report rows (one per check)."""
    results = checks.collect()
    failed = [r for r in results if not r["passed"] and r["level"] == CRITICAL]
    if failed:
        raise QualityError("; ".join(f"{r['name']}: {r['detail']}" for r in failed))
    return results


class ColumnTest(NamedTuple):
    test: str
    column: str
    violation: Column


def not_null(column: str, where: Column | None = None) -> ColumnTest:
    broken = F.col(column).isNull()
    return ColumnTest("not_null", column, broken if where is None else broken & where)


def accepted_range(column: str, low: float | None = None, high: float | None = None, inclusive: bool = True) -> ColumnTest:
    """NULLs are not counted: that is what ``not_null`` is for."""
    c, broken = F.col(column), []
    if low is not None:
        broken.append(c < low if inclusive else c <= low)
    if high is not None:
        broken.append(c > high if inclusive else c >= high)
    if not broken:
        raise ValueError("accepted_range needs a low or a high limit")
    return ColumnTest("accepted_range", column, reduce(lambda a, b: a | b, broken))


def accepted_values(column: str, values: Iterable) -> ColumnTest:
    return ColumnTest("accepted_values", column, ~F.col(column).isin(*values))


def _results(counted: DataFrame, table: str, by: str | None, tests: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One result row per test (name, column, column of ``counted`` with its violations), and per value of ``by``."""
    rows = [
        F.struct(F.lit(table).alias("table_name"), F.lit(test).alias("test"), F.lit(column).alias("column_name"),
                 F.col(count).alias("violations"), (F.col(count) == 0).alias("passed"))
        for test, column, count in tests
    ]
    return counted.select(*([by] if by else []), F.inline(F.array(*rows)))


def _grouped(df: DataFrame, by: str | None):
    return df.groupBy(*([by] if by else []))


def column_tests(df: DataFrame, table: str, tests: Sequence[ColumnTest], by: str | None = None) -> DataFrame:
    """All tests of one table in a single aggregate; one result row per test, and per value of ``by`` if given."""
    counted = _grouped(df, by).agg(*[F.count_if(t.violation).alias(f"v{i}") for i, t in enumerate(tests)])
    return _results(counted, table, by, [(t.test, t.column, f"v{i}") for i, t in enumerate(tests)])


def unique(df: DataFrame, table: str, keys: Sequence[str], by: str | None = None) -> DataFrame:
    """Keys held by more than one row; NULL key parts count as equal. ``by`` must follow from the key, as its year does."""
    repeated = df.groupBy(*keys, *([by] if by and by not in keys else [])).agg(F.count(F.lit(1)).alias("n"))
    counted = _grouped(repeated, by).agg(F.count_if(F.col("n") > 1).alias("v"))
    return _results(counted, table, by, [("unique", ",".join(keys), "v")])


def relationship(child: DataFrame, table: str, key: str, parent: DataFrame, parent_key: str, by: str | None = None) -> DataFrame:
    """Rows whose ``key`` has no parent. Counted per key first, so hot keys are one row in the join."""
    keys = child.where(F.col(key).isNotNull()).groupBy(*([by] if by else []), key).agg(F.count(F.lit(1)).alias("n"))
    held = parent.select(F.col(parent_key).alias("_parent"))
    if by is None:
        counted = keys.join(held, keys[key] == held["_parent"], "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("v"))
    else:  # values of ``by`` without orphans are results too
        matched = keys.join(held.distinct(), keys[key] == held["_parent"], "left")
        counted = matched.groupBy(by).agg(F.sum(F.when(F.col("_parent").isNull(), F.col("n")).otherwise(0)).alias("v"))
    return _results(counted, table, by, [("relationship", key, "v")])


def split_rejects(df: DataFrame, required: Sequence[str], types: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows that fill all ``required`` columns with values that fit ``types``, and the others with a reason."""
    faults = {f"{c} is missing": F.col(c).isNull() for c in required}
    for c, dtype in (types or {}).items():
        faults[f"{c} does not fit {dtype}"] = F.col(c).isNotNull() & F.col(c).try_cast(dtype).isNull()
    reason = F.concat_ws(", ", *[F.when(fault, text) for text, fault in faults.items()])
    refused = reduce(lambda a, b: a | b, faults.values())
    return df.where(~refused), df.where(refused).withColumn("reason", reason)
