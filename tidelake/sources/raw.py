"""Hourly files of newline-delimited JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions import file_date, file_hour


def _with_origin(text: DataFrame) -> DataFrame:
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def with_line_position(lines: DataFrame) -> DataFrame:
    """Order of lines within a file is ``(block_start, line_pos)``.

    The id grows along each scanned block, and the block start orders the blocks of a file, so
    the order also holds for plain files Spark splits. Must directly follow the scan.
    """
    return lines.withColumn("line_pos", F.monotonically_increasing_id())


def scan_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of the given files or folders with their origin; gzip is read as one block per file."""
    return with_line_position(_with_origin(spark.read.text(paths)))


def stream_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The same as a stream of files appearing in ``folder``; positions are added per batch."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _with_origin(reader.text(folder))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files below ``folder`` with the hour in their name, also those without a single line.

    Only names and sizes are read; the content column is pruned.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return (
        files.withColumn("source_file", name)
        .withColumns({"date": file_date(F.col("source_file")), "hour": file_hour(F.col("source_file"))})
        .withColumn("hour_ts", hour_start())
    )


def hour_start():
    """Start of the hour named by ``date`` and the unpadded text ``hour``."""
    return F.col("date").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("hour").cast("int"))
