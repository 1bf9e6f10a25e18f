"""Cleaning rules on hand-made rows."""

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from pricelake.functions.text import contains, missing_to_null, null_texts, squash_blanks, title_words
from pricelake.operators import cleaning
from pricelake.schemas import RAW_COLUMNS

BASE = {
    "date": "2024-01-15", "admin1": "nairobi", "admin2": "nairobi", "market": "wakulima", "market_id": "1",
    "latitude": "1.0", "longitude": "2.0", "category": "cereals", "commodity": "maize", "commodity_id": "51",
    "unit": "90 KG", "priceflag": "actual", "pricetype": "Wholesale", "currency": "KES", "price": "900", "usdprice": "9",
}


def rows(spark, *changes):
    """Observations that differ from the base row as given, in file order."""
    data = [tuple({**BASE, **c}[k] for k in RAW_COLUMNS) + (i,) for i, c in enumerate(changes)]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in RAW_COLUMNS) + ", row_seq int")


def standard(spark, *changes, **options):
    return cleaning.standardise(rows(spark, *changes), **options).orderBy("row_seq").collect()


def cleaned(spark, *changes, **options):
    return cleaning.clean(rows(spark, *changes), **options).orderBy("row_seq").collect()


def test_dates_other_formats_are_null_and_invalid(spark):
    texts = ["2024-01-15", "x", "15/01/2024", "2024-01-15 10:00", "2024-02-30", None]
    got = standard(spark, *[{"date": t} for t in texts])
    assert [str(r["date"]) if r["date"] else None for r in got] == ["2024-01-15"] + [None] * 5
    assert [r["is_valid_price"] for r in got] == [True] + [False] * 5
    assert (got[0]["year"], got[0]["month"]) == (2024, 1)


@pytest.mark.parametrize(
    "text,expected",
    [
        ("murang'a", "Murang'A"),
        ("TAITA-taveta", "Taita-Taveta"),
        ("maize (white)", "Maize (White)"),
        ("2nd  street", "2Nd Street"),
        ("  a \t b \x1f", "A B"),
        ("", None),
    ],
)
def test_names(spark, text, expected):
    assert standard(spark, {"county": text, "admin1": text})[0]["county"] == expected


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aZéß'(-. \t 3ǆñЖж’_x\u0001", max_size=12), min_size=1, max_size=20))
def test_title_and_squash_agree_with_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", title_words(F.col("t")).alias("title"), squash_blanks(F.col("t")).alias("squash")).orderBy("i")
    for text, row in zip(texts, got.collect()):
        assert row["title"] == text.title()
        assert row["squash"] == " ".join(text.split())


def test_null_texts(spark):
    df = spark.createDataFrame([("nan",), ("None",), ("",), ("NONE",), ("x",), (None,)], "t string")
    loose = [r[0] for r in df.select(null_texts(F.col("t"))).collect()]
    strict = [r[0] for r in df.select(null_texts(F.col("t"), strict=True)).collect()]
    assert loose == [None, None, None, None, "x", None]
    assert strict == [None, None, None, "NONE", "x", None]


def test_strict_tokens_come_after_capitalising(spark):
    strict = standard(spark, {"admin1": "nan"}, {"admin1": "none"}, {"unit": "nan"}, strict_tokens=True)
    assert [strict[0]["county"], strict[1]["county"], strict[2]["unit"]] == ["Nan", None, None]
    assert standard(spark, {"admin1": "nan"})[0]["county"] is None


def test_missing_tokens_and_contains(spark):
    df = spark.createDataFrame([("NA",), ("n/a",), ("Nairobi",), (None,)], "t string")
    assert [r[0] for r in df.select(missing_to_null(F.col("t"))).collect()] == [None, None, "Nairobi", None]
    assert [r[0] for r in df.select(contains(F.col("t"), "NAIR")).collect()] == [False, False, True, False]


def test_prices(spark):
    got = standard(spark, *[{"price": p} for p in ("0", "-5", "n.a.", "NaN", "inf", "12.34567", None)])
    prices = [r["price_kes"] for r in got]
    assert prices == [None, Decimal("-5.0000"), None, None, None, Decimal("12.3457"), None]
    assert [r["is_valid_price"] for r in got] == [False, False, False, False, False, True, False]


def test_unit_factors(spark):
    got = standard(spark, {"unit": "90 KG"}, {"unit": " 50 \t kg "}, {"unit": "Head"}, {"unit": None}, {"unit": "KG"})
    assert [r["unit"] for r in got] == ["90 KG", "50 kg", "Head", None, "KG"]
    assert [r["price_per_kg"] for r in got] == [Decimal("10.0000"), Decimal("18.0000"), None, None, Decimal("900.0000")]


def test_users_extend_the_unit_table(spark):
    df = spark.createDataFrame([("Sack", Decimal("30"))], "unit string, price_kes decimal(12,4)")
    assert cleaning.price_per_unit(df, factors={"sack": 3}).first()["price_per_kg"] == Decimal("10.0000")


def test_keep_last_ignores_the_unit_unless_asked(spark):
    changes = ({"price": "1"}, {"price": "2"}, {"price": "3", "unit": "KG"})
    assert [r["price_kes"] for r in cleaned(spark, *changes)] == [Decimal("3.0000")]
    keys = ("date", "market", "commodity", "unit", "pricetype")
    assert [r["price_kes"] for r in cleaned(spark, *changes, keys=keys)] == [Decimal("2.0000"), Decimal("3.0000")]


def test_keep_last_takes_null_keys_as_equal_and_names_as_cleaned(spark):
    got = cleaned(spark, {"market": None, "price": "1"}, {"market": " ", "price": "2"}, {"market": "A "}, {"market": "a"})
    assert [(r["market"], r["row_seq"]) for r in got] == [(None, 1), ("A", 3)]


def test_keep_last_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("row_seq"))
    last = cleaning.keep_last(df, keys=["k"])
    plan = last._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("Partial"), plan.index("Exchange")
    assert exchange < partial  # printed top down: the partial limit runs below the exchange
    assert sorted(r["row_seq"] for r in last.collect()) == [998, 999]


def test_columns_may_be_absent_and_headers_untidy(spark):
    df = spark.createDataFrame([("2024-01-15", "5", 1)], "` Date ` string, PRICE string, row_seq int")
    row = cleaning.clean(df).first()
    assert row["price_kes"] == Decimal("5.0000") and row["is_valid_price"] and "unit" not in row.asDict()


def test_cleaning_twice_changes_nothing(spark):
    once = cleaning.clean(rows(spark, {}, {"market": "o'neil (x)"}, {"price": "0"}, {"unit": " 2  KG", "date": "x"}))
    texts = ["county", "district", "market", "category", "commodity", "unit", "priceflag", "pricetype", "currency"]
    again = cleaning.clean_texts(once)
    assert once.select(texts).exceptAll(again.select(texts)).count() == 0
    assert cleaning.keep_last(once).count() == once.count()


def test_filters_on_keys_after_keep_last_clean_no_text_twice(spark):
    got = cleaning.clean(rows(spark, {}, {"market": None})).where("market IS NOT NULL AND commodity IS NOT NULL AND date IS NOT NULL")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("initcap(") == 5  # once per name column
    assert [r["market"] for r in got.collect()] == ["Wakulima"]


def test_derived_columns_stay_out_of_the_shuffle_of_keep_last(spark):
    plan = cleaning.clean(rows(spark, {}))._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange", 1)
    for name in ("year", "month", "price_per_kg", "is_valid_price"):
        assert f"AS {name}#" in above and f"{name}#" not in below, name


def test_keys_of_clean_may_be_derived(spark):
    changes = ({"date": "2024-01-15", "price": "1"}, {"date": "2024-07-15", "price": "2"}, {"date": "2023-07-15", "price": "3"})
    assert [r["price_kes"] for r in cleaned(spark, *changes, keys=("year",))] == [Decimal("2.0000"), Decimal("3.0000")]


def test_word_starts_and_marks_of_the_data(spark):
    texts = ["o'neil (x)  7th", "4 b-c", "a\u0001 b", "\u0001\u0001 b", "a\u0001b", "\u00aa\u05d0b \u01c6a", "\U0001d4d0b 'c", ""]
    mark = "\u0001 "
    old = F.replace(F.initcap(F.regexp_replace("t", r"([^\p{LC} ])(?=[\p{L} ])", "$1" + mark)), F.lit(mark), F.lit(""))
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", title_words(F.col("t")).alias("now"), old.alias("old")).collect()
    assert [r["now"] for r in got] == [r["old"] for r in got]
    assert {r["t"]: r["now"] for r in got}["a\u0001 b"] == "A\u0001 B"
