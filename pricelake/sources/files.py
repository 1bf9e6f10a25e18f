"""Reading observation files and landing raw copies."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.text import missing_to_null
from ..schemas import MISSING_TOKENS


def resolve_source(
    spark: SparkSession,
    path: str | None = None,
    env_var: str = "LOCAL_CSV_PATH",
    default: str | None = None,
) -> str:
    """First path that exists: the argument, then the environment variable, then the default.

    Any file, folder or glob on a Hadoop file system counts. An explicit argument that does not
    exist is an error rather than a silent fall-through.
    """
    if path:
        if not _exists(spark, path):
            raise FileNotFoundError(f"no such source: {path}")
        return path
    for candidate in (os.environ.get(env_var), default):
        if candidate and _exists(spark, candidate):
            return candidate
    raise FileNotFoundError(f"no source given, none in ${env_var} and none at {default}")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("value STRING").text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Deal the rows out over all cores: for inputs that cannot be split, such as one Parquet row group or a zipped CSV.

    With ``by``, columns that tell rows apart, partitions have a size in place of a number (AQE splits and joins them to it),
    so that tasks do not grow with the input; nor is every task's part sorted first, as dealing out in turn does.
    It costs a shuffle, so leave it out where the input has splits enough.
    """
    return df.hint("rebalance", *by) if by else df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def blank_missing(df: DataFrame, tokens: Iterable[str] = MISSING_TOKENS) -> DataFrame:
    """Missing-value tokens become NULL in every text column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: missing_to_null(F.col(f"`{c}`"), tokens) for c in texts})


def _lineage() -> list[Column]:
    """File name, path and time, and ``row_seq``, which orders rows as written: file time, path, block, position in it."""
    name, path, time = _file_columns()
    sequence = F.struct(
        time.alias("file_time"),
        path.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
    )
    return [name.alias("source_file"), path.alias("source_path"), time.alias("file_time"), sequence.alias("row_seq")]


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``line`` and lineage of every line under the header; blank lines are none.

    Every line is one field to Spark's CSV reader, which splits big files, leaves the header out and fails for files whose
    header is not that of the first one. A line that holds the character between fields comes back whole as a bad record.
    """
    reader = spark.read.options(header=True, sep="\x01", quote="", columnNameOfCorruptRecord="_whole", enforceSchema=False)
    header = reader.csv(path).columns[0]
    lines = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in (header, "_whole")])).csv(path)
    quoted = header.replace("`", "``")
    return lines.select(F.coalesce("_whole", f"`{quoted}`").alias("line"), *_lineage())


def line_fault(line: Column, fields: int) -> Column:
    """Why a line is no record of so many fields, or NULL: a quotation mark that opens a field and does not end it, or
    too many or too few fields. Marks inside a field that does not begin with one are text."""
    # Well quoted fields go, so that what is left holds one comma per border, and an opening mark that nothing closes.
    plain = F.regexp_replace(line, r'(?<=^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|$)', "")
    plain = F.when(F.contains(line, F.lit('"')), plain).otherwise(line)
    found = F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1
    count = F.format_string(f"%d fields, not {fields}", found)
    return F.when(plain.rlike('(?:^|,)"'), "quotation mark not closed").when(found != fields, count)


def parse_lines(lines: DataFrame, columns: Iterable[str], tokens: Iterable[str] = MISSING_TOKENS) -> DataFrame:
    """``lines`` with the fields of every ``line`` as text columns, and ``fault``; a line with a fault has no fields."""
    columns = list(columns)
    schema = ", ".join(f"_{i} STRING" for i in range(len(columns)))
    checked = lines.withColumn("fault", line_fault(F.col("line"), len(columns)))
    sound = F.when(F.col("fault").isNull(), F.col("line"))
    parsed = checked.withColumn("_fields", F.from_csv(sound, F.lit(schema), {"escape": '"'}))
    fields = [missing_to_null(F.col(f"_fields._{i}"), tokens).alias(c) for i, c in enumerate(columns)]
    return parsed.select(*fields, *[F.col(f"`{c}`") for c in lines.columns], "fault")


def scan_observations(
    spark: SparkSession,
    path: str | list[str],
    header: Iterable[str] | None = None,
    tokens: Iterable[str] = MISSING_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """CSV files with a header as text columns, in one pass; broken records are rows with a ``fault`` and their ``line``.

    ``header`` defaults to the first line found (one line is read); files whose header differs fail instead of shifting
    columns. One record per line lets big files split over many tasks; set ``multi_line`` for quoted line breaks, at the
    price of one task per file and of a fault that only tells the record is malformed. Adds the lineage columns
    ``source_file``, ``source_path``, ``file_time`` and ``row_seq``.
    """
    reader = spark.read.options(header=True, escape='"', multiLine=multi_line)
    found = reader.csv(path).columns
    columns = list(header) if header else found
    if [c.lower() for c in columns] != [c.lower() for c in found]:
        raise ValueError(f"the header is {found} and not {columns}")
    if not multi_line:
        return parse_lines(read_lines(spark, path), columns, tokens)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, "_whole")])
    df = reader.options(enforceSchema=False, columnNameOfCorruptRecord="_whole").schema(schema).csv(path)
    fields = [F.when(F.col("_whole").isNull(), missing_to_null(F.col(f"`{c}`"), tokens)).alias(c) for c in columns]
    fault = F.when(F.col("_whole").isNotNull(), "malformed record").alias("fault")
    return df.select(*fields, F.col("_whole").alias("line"), *_lineage(), fault)


def sound_rows(scanned: DataFrame) -> DataFrame:
    """Rows of a scan without a fault."""
    return scanned.where("fault IS NULL").drop("line", "fault")


def read_observations(
    spark: SparkSession,
    path: str | list[str],
    header: Iterable[str] | None = None,
    tokens: Iterable[str] = MISSING_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """The sound records of ``scan_observations``."""
    return sound_rows(scan_observations(spark, path, header, tokens, multi_line))


def _file_columns() -> tuple[Column, Column, Column]:
    # The metadata columns hold names as in a URL, where a plus sign stands for itself.
    decoded = [F.url_decode(F.replace(F.col(f"_metadata.{c}"), F.lit("+"), F.lit("%2B"))) for c in ("file_name", "file_path")]
    return *decoded, F.col("_metadata.file_modification_time")


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``source_path`` and ``file_time`` of the files under a path, listed by Spark; their content is not read."""
    listed = spark.read.format("binaryFile").load(path)
    _, source, time = _file_columns()
    return listed.select(source.alias("source_path"), time.alias("file_time"))


def exact_paths(paths: Iterable[str]) -> list[str]:
    """File names as Spark's readers take them, with the characters of a pattern escaped."""
    return [re.sub(r"([\\{}\[\]*?])", r"\\\1", path) for path in paths]


def land_copy(df: DataFrame, folder: str, load_date: str) -> str:
    """Keep a dated raw copy as Parquet; a repeated load replaces its own date only."""
    target = f"{folder.rstrip('/')}/load_date={load_date}"
    df.write.mode("overwrite").parquet(target)
    return target
