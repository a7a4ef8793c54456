"""Source file listings and fingerprints."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_path(path: str) -> str:
    """A path as readers take it, with the characters escaped that would make it a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def list_source_files(spark: SparkSession, path: str | list[str], with_hash: bool = False) -> DataFrame:
    """Files below the path or paths with length and modification time, and the MD5 of their bytes on request.

    Without the hash no file is opened. With it each file is one value, of 2 GB at most; ``text_fingerprints`` has no
    such bound. Hidden files and folder markers are left out by Spark.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    plain = [
        F.col("_metadata.file_path").alias("file_path"),
        "length",
        F.col("modificationTime").cast("timestamp_ntz").alias("modified_at"),
    ]
    return files.select(*plain, F.md5("content").alias("file_hash")) if with_hash else files.select(*plain)


def text_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Text lines with their file, the start of their split, and an id that grows along each file."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .text(paths)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"),
        )
        .withColumn("line_id", F.monotonically_increasing_id())
    )


def text_fingerprints(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file_path, file_hash``: 32 hexadecimal digits over the lines of each text file.

    Files are read in splits and combined per task, so a file of any size takes the same path. The order of lines does
    not count.
    """
    lines = text_lines(spark, paths)
    parts = [F.count("*"), F.bit_xor(F.xxhash64("value")), F.sum(F.hash("value").cast("long"))]
    return lines.groupBy("file_path").agg(F.md5(F.concat_ws(":", *parts)).alias("file_hash"))


def latest_file(files: DataFrame) -> DataFrame:
    """The file whose path sorts last, which is the newest one when names carry a timestamp."""
    return files.agg(F.max("file_path").alias("file_path")).filter(F.col("file_path").isNotNull())


#: Error classes of Spark that speak of a file's content.
READER_ERRORS = ("FAILED_READ_FILE", "MALFORMED_CSV_RECORD", "MALFORMED_RECORD_IN_PARSING")


def is_reader_error(failure: Exception) -> bool:
    """Whether a failure comes from the files or their columns, and not from the cluster."""
    return isinstance(failure, (TypeError, ValueError, OSError, AnalysisException)) or any(name in str(failure) for name in READER_ERRORS)


def usable_files(rows_of: Callable[[list[str]], DataFrame], paths: list[str]) -> tuple[list[str], list[str]]:
    """Split files into usable and unusable ones by halving the batch until each part is pure.

    Only a failure that comes from the files is taken as a verdict; any other one is raised.
    """
    try:
        rows_of(paths).write.format("noop").mode("overwrite").save()
        return paths, []
    except Exception as failure:
        if not is_reader_error(failure):
            raise
        if len(paths) == 1:
            return [], paths
    half = len(paths) // 2
    left, right = usable_files(rows_of, paths[:half]), usable_files(rows_of, paths[half:])
    return left[0] + right[0], left[1] + right[1]
