"""Report, gate, column tests and constraints."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricelake.operators import quality

SCHEMA = "date date, market string, commodity string, pricetype string, price_kes decimal(12,4), is_valid_price boolean"
DAY = datetime.date(2024, 1, 15)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def row(i=0, date=DAY, price="1", valid=True):
    return (date, f"m{i}", "c", "Retail", None if price is None else Decimal(price), valid)


def by_name(df, **options):
    return {r["name"]: r for r in quality.report(df, **options).collect()}


def test_all_checks_pass(spark):
    checks = by_name(frame(spark, row(1), row(2)))
    assert list(checks) == [
        "not_empty", "required_columns", "price_nulls", "date_range", "negative_prices", "duplicate_keys",
        "valid_price_ratio",
    ]
    assert all(c["passed"] and c["status"] == "PASS" for c in checks.values())


def test_empty_input(spark):
    checks = by_name(frame(spark))
    found = {n: (c["passed"], c["level"]) for n, c in checks.items()}
    assert found["not_empty"] == (False, "critical")
    assert found["date_range"] == (False, "critical")
    assert found["price_nulls"] == (False, "warning")
    assert found["valid_price_ratio"] == (False, "warning")
    assert found["duplicate_keys"] == (True, "warning")


@pytest.mark.parametrize("nulls,passed,level", [(299, True, "warning"), (300, False, "critical")])
def test_null_share(spark, nulls, passed, level):
    df = spark.range(1000).select(
        F.lit(DAY).alias("date"),
        F.concat(F.lit("m"), "id").alias("market"),
        F.lit("c").alias("commodity"),
        F.lit("p").alias("pricetype"),
        F.when(F.col("id") >= nulls, F.lit(1).cast("decimal(12,4)")).alias("price_kes"),
        F.lit(True).alias("is_valid_price"),
    )
    check = by_name(df)["price_nulls"]
    assert (check["passed"], check["level"]) == (passed, level)


def test_negative_duplicate_and_range(spark):
    early = datetime.date(1999, 12, 31)
    checks = by_name(frame(spark, row(1, price="-5"), row(1), row(1), row(2, date=early, valid=False), row(2, date=None)))
    assert checks["negative_prices"]["value"] == "1" and checks["negative_prices"]["status"] == "FAIL"
    assert checks["duplicate_keys"]["value"] == "2" and checks["duplicate_keys"]["status"] == "WARN"
    assert checks["date_range"]["value"] == "1999-12-31..2024-01-15" and checks["date_range"]["status"] == "WARN"


def test_low_valid_ratio_only_warns(spark):
    checks = by_name(frame(spark, row(1, valid=False), row(2)))
    assert checks["valid_price_ratio"]["status"] == "WARN" and checks["valid_price_ratio"]["value"] == "50.00"


def test_missing_columns(spark):
    checks = by_name(frame(spark, row()).drop("price_kes", "is_valid_price", "market"))
    assert checks["required_columns"]["value"] == "market,price_kes"
    assert checks["price_nulls"]["status"] == checks["negative_prices"]["status"] == "FAIL"
    assert checks["valid_price_ratio"]["passed"]


def test_gate(spark):
    assert len(quality.gate(quality.report(frame(spark, row())))) == 7
    with pytest.raises(quality.QualityError, match="negative_prices"):
        quality.gate(quality.report(frame(spark, row(price="-1"))))


def test_report_reads_the_input_once(spark, tmp_path):
    frame(spark, row(1), row(2)).write.parquet(f"{tmp_path}/rows")
    report = quality.report(spark.read.parquet(f"{tmp_path}/rows"))
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_column_tests(spark):
    df = spark.createDataFrame([(1, 0.0), (13, 2.0), (None, None)], "month int, price double")
    tests = [
        quality.not_null("month"),
        quality.not_null("price", where=F.col("month") == 1),
        quality.accepted_range("price", low=0, inclusive=False),
        quality.accepted_range("price", low=0, high=1),
        quality.accepted_values("month", range(1, 13)),
    ]
    got = [(r["test"], r["violations"], r["passed"]) for r in quality.column_tests(df, "t", tests).collect()]
    assert got == [
        ("not_null", 1, False), ("not_null", 0, True), ("accepted_range", 1, False), ("accepted_range", 1, False),
        ("accepted_values", 1, False),
    ]


def test_unique_and_relationship(spark):
    child = spark.createDataFrame([("a", None), ("a", None), ("b", 1), ("c", 7), ("c", 7)], "k string, p int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert quality.unique(child, "child", ["k", "p"]).first()["violations"] == 2
    assert quality.relationship(child, "child", "p", parent, "id").first()["violations"] == 2


def test_rejects_name_their_reason(spark):
    df = spark.createDataFrame([("m", 1), (None, None), (None, 2)], "market string, year int")
    good, bad = quality.split_rejects(df, ["year", "market"])
    assert good.count() == 1
    assert sorted(r["reason"] for r in bad.collect()) == ["market is missing", "year is missing, market is missing"]
