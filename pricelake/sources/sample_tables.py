"""Observations derived from the star-schema tables in a data folder (see FIXTURES.md, part B).

The texts are made dirty on purpose so that every cleaning rule has rows to work on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.matching import too_large_to_broadcast
from ..schemas import RAW_COLUMNS
from .files import blank_missing, spread

ORDERING = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
SEQUENCE = (*ORDERING, "price_kes", "unit", "priceflag")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _every(column: str, step: int) -> Column:
    return F.col(column) % step == 0


def _id_text(column: str) -> Column:
    """An id as text; some have been through a float."""
    return F.concat(F.col(column).cast("string"), F.when(_every(column, 7), ".0").otherwise(""))


def observations(spark: SparkSession, folder: str, source_file: bool = False, odd: bool = False) -> DataFrame:
    """The 16 input columns as text, plus the four columns that give the row order.

    ``odd`` adds prices that are negative or too large for the tables, and ids that are no whole numbers.
    """
    items = table(spark, folder, "lineitem")
    if source_file:
        items = items.select("*", F.col("_metadata.file_name").alias("source_file"))
    parts, of_part = table(spark, folder, "part").select("p_partkey", "p_name", "p_type"), F.col("l_partkey") == F.col("p_partkey")
    # Parts too many to broadcast need a shuffle of the items anyhow, and AQE joins and splits its partitions by size as it
    # does those of ``spread``. They come first, so that the names of suppliers are not in this shuffle.
    shuffled = too_large_to_broadcast(parts)
    joined = (
        (items.join(parts.hint("merge"), of_part) if shuffled else spread(items, *ORDERING))
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    joined = joined if shuffled else joined.join(parts, of_part)
    nothing = F.lit(None).cast("string")
    units = ["KG", "90 KG", " 50  kg ", "2 KG", "200 G", "L", "Head", "100 KG"]
    slot = F.col("l_quantity").cast("int") % 9
    unit = nothing
    for i, name in enumerate(units):
        unit = F.when(slot == i, name).otherwise(unit)

    def coordinate(span: int) -> Column:
        return (F.col("l_suppkey") % span - span // 2).cast("decimal(10,6)").cast("string")

    columns = {
        "date": F.when(_every("l_orderkey", 211), "not-a-date")
        .when(_every("l_orderkey", 223), nothing)
        .otherwise(F.col("l_shipdate").cast("date").cast("string")),
        "admin1": F.when(
            ~_every("l_suppkey", 17), F.concat(F.lit("  "), F.lower(F.replace("n_name", F.lit("_"), F.lit("-"))))
        ),
        "admin2": F.when(~_every("l_suppkey", 13), F.concat("r_name", F.lit("   (sub) "))),
        "market": F.when(~_every("l_orderkey", 401), F.concat(F.lit("  "), "s_name", F.lit(" town's  mkt"))),
        "market_id": _id_text("l_suppkey"),
        "latitude": coordinate(180),
        "longitude": coordinate(360),
        "category": F.when(_every("l_partkey", 19), "").otherwise(F.col("p_type")),
        "commodity": F.concat(F.lit(" "), "p_name", F.lit("  (white) ")),
        "commodity_id": _id_text("l_partkey"),
        "unit": unit,
        "priceflag": F.when(F.col("l_linestatus") == "O", "actual").otherwise("aggregate"),
        "pricetype": F.when(F.col("l_returnflag") == "A", "Retail")
        .when(F.col("l_returnflag") == "N", "Wholesale")
        .otherwise("None"),
        "currency": F.lit("KES"),
        "price": F.when(_every("l_orderkey", 101), "0")
        .when(_every("l_orderkey", 103), "n.a.")
        .when(_every("l_orderkey", 107), nothing)
        .otherwise(F.col("l_extendedprice").cast("decimal(12,4)").cast("string")),
        "usdprice": F.when(
            ~_every("l_orderkey", 109),
            (F.col("l_extendedprice").cast("decimal(12,2)") * F.lit(0.0077).cast("decimal(5,4)"))
            .cast("decimal(12,4)")
            .cast("string"),
        ),
    }
    if odd:
        price = F.col("l_extendedprice").cast("decimal(12,4)")
        columns["price"] = (
            F.when(_every("l_orderkey", 13), (price * 100000).cast("decimal(28,4)").cast("string"))
            .when(_every("l_orderkey", 11), (-price).cast("string"))
            .otherwise(columns["price"])
        )
        columns["market_id"] = F.when(_every("l_orderkey", 5), F.concat(F.col("l_suppkey").cast("string"), F.lit(".5"))).otherwise(columns["market_id"])
    extra = ["source_file"] if source_file else []
    return joined.select(*ORDERING, *[columns[c].alias(c) for c in RAW_COLUMNS], *extra)


def scanned(spark: SparkSession, folder: str, source_file: bool = False, odd: bool = False) -> DataFrame:
    """The observations as a file scan gives them: missing-value tokens are NULL."""
    return blank_missing(observations(spark, folder, source_file, odd))
