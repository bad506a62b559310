"""Pipe-delimited text tables, read string-safe."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

FILE_ORDER = "_file_order"

# Cell texts that a tabular reader takes for a missing value.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def _path_missing(error: AnalysisException) -> bool:
    return (error.getCondition() or "").startswith("PATH_NOT_FOUND")


def try_read_pipe_csv(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = False,
    missing_texts: tuple[str, ...] = (),
    file_order: bool = False,
) -> DataFrame | None:
    """All columns as strings, named by the header, missing as ''; None without a file.

    Large files are split over tasks; ``multi_line`` reads quoted line breaks, for
    which a file has to stay in one task. ``missing_texts`` also become ''.
    ``file_order`` adds a number that grows with the place of each row in the
    input: the file in the sorted listing, the split in it, the row.
    """
    reader = spark.read.options(
        sep="|", header=True, quote='"', escape='"', encoding="UTF-8", multiLine=multi_line,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, enforceSchema=False,
    )
    try:
        raw = reader.csv(path)
    except AnalysisException as error:
        if _path_missing(error):
            return None
        raise
    cells = [F.coalesce(F.col(f"`{name}`"), F.lit("")).alias(name) for name in raw.columns]
    if missing_texts:
        cells = [
            F.when(cell.isin(*missing_texts), F.lit("")).otherwise(cell).alias(name)
            for name, cell in zip(raw.columns, cells)
        ]
    return raw.select(*cells, *([_file_order(raw).alias(FILE_ORDER)] if file_order else []))


def listed_tables(spark: SparkSession, pattern: str) -> DataFrame | None:
    """``file_name`` of each text table that matches a path pattern, a file or a folder of part files; None without any.

    Folders may be named ``key=name``, as partitioned writers do. The names come from the
    reader's own listing, which has files without a byte as well.
    """
    try:
        listed = spark.read.text(pattern).inputFiles()
    except AnalysisException as error:
        if _path_missing(error):
            return None
        raise
    files = spark.createDataFrame([(path,) for path in listed], "path string")
    return files.select(_table_name("path").alias("file_name")).distinct()


def _table_name(path: str) -> Column:
    return F.regexp_extract(path, r"/(?:[^/=]+=)?([^/]+?\.csv)(?:/[^/]+)?$", 1)


def first_lines(spark: SparkSession, pattern: str) -> DataFrame:
    """``(file_name, at, value)``: the lines of the first block of each file, ``at`` ordering those of a table."""
    lines = spark.read.text(pattern).filter(F.col("_metadata.file_block_start") == 0)
    at = F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id())
    return lines.select(_table_name("_metadata.file_path").alias("file_name"), at.alias("at"), "value")


def read_all_tables(
    spark: SparkSession, pattern: str, width: int, multi_line: bool = False, missing_texts: tuple[str, ...] = ()
) -> DataFrame:
    """``(file_name, cells)`` of every row behind the header of all tables that match, in one scan."""
    schema = StructType([StructField(f"c{k}", StringType()) for k in range(max(width, 1))])
    rows = spark.read.options(
        sep="|", header=True, quote='"', escape='"', encoding="UTF-8", multiLine=multi_line,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, enforceSchema=True,
    ).schema(schema).csv(pattern)
    cells = [F.coalesce(F.col(name), F.lit("")) for name in schema.names]
    if missing_texts:
        cells = [F.when(cell.isin(*missing_texts), F.lit("")).otherwise(cell) for cell in cells]
    return rows.select(_table_name("_metadata.file_path").alias("file_name"), F.array(*cells).alias("cells"))


def _file_order(raw: DataFrame) -> Column:
    """One whole number per row: 10 digits of file, 14 of split, 10 of the row in its task."""
    # both sides without the optional slashes of an empty host
    files = [re.sub("^([a-z0-9+.-]+):/+", r"\1:/", name) for name in sorted(raw.inputFiles())]
    path = F.regexp_replace("_metadata.file_path", "^([a-z0-9+.-]+):/+", "$1:/")
    file = F.array_position(F.array(*[F.lit(name) for name in files]), path)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    parts = (file * F.lit(Decimal(10**24)), F.col("_metadata.file_block_start") * F.lit(Decimal(10**10)), row)
    return sum((part.cast("decimal(35,0)") for part in parts[1:]), parts[0].cast("decimal(35,0)")).cast("decimal(35,0)")


def empty_table(spark: SparkSession, columns: list[str]) -> DataFrame:
    return spark.createDataFrame([], StructType([StructField(name, StringType()) for name in columns]))


def read_pipe_csv(spark: SparkSession, path: str | list[str], columns: list[str], **options) -> DataFrame:
    """As ``try_read_pipe_csv``; a missing file gives an empty table with ``columns``."""
    found = try_read_pipe_csv(spark, path, **options)
    return empty_table(spark, columns) if found is None else found


def header_line(spark: SparkSession, path: str) -> str:
    """First line of a text table, without its byte-order mark."""
    first = spark.read.text(path).limit(1).select(F.regexp_replace("value", r"^\x{feff}", "").alias("line")).first()
    return "" if first is None else first["line"]


def has_pipe_header(spark: SparkSession, path: str) -> bool:
    return "|" in header_line(spark, path)
