"""Tables by label, files by pattern, pages by table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.sources.pipe_csv import try_read_pipe_csv


def read_catalog(spark: SparkSession, paths: dict[str, str], **options) -> dict[str, DataFrame]:
    """Published tables by label; labels without a file are left out."""
    found = {label: try_read_pipe_csv(spark, path, **options) for label, path in paths.items()}
    return {label: df for label, df in found.items() if df is not None}


def list_files(spark: SparkSession, folder: str, pattern: str = "*.pdf", recursive: bool = False) -> DataFrame:
    """Files of a folder (and of those in it) that match a pattern, by path; their content is not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    listed = reader.option("recursiveFileLookup", recursive).load(folder)
    return listed.select(
        "path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", "modificationTime"
    ).orderBy("path")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Collected pages ``(page_id, url, html)``."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def read_page_text(spark: SparkSession, path: str) -> DataFrame:
    """Text per document page ``(source_file, page, text)``; no text is ''."""
    return spark.read.parquet(path).select(
        "source_file", "page", F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
