"""Files as documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.options import DEFAULT_MAX_BYTES

#: Tasks of a scan that are never joined, for each core, and how many make one beyond them.
SCANS_A_CORE, TASKS_IN_ONE = 8, 16


def scan_documents(
    spark: SparkSession,
    path: str | list[str],
    glob: str | None = None,
    recursive: bool = True,
    max_bytes: int = DEFAULT_MAX_BYTES,
) -> DataFrame:
    """Files as ``(path, length, content, status, error)``.

    The size cap is a pushed-down filter, so an oversized file is listed but never read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return within_size(grouped(reader.load(path)), max_bytes)


def grouped(files: DataFrame) -> DataFrame:
    """Files in fewer tasks where there are very many.

    Spark counts some MiB for the opening of a file, so of small files it gives a task a few only, and
    starting tasks takes longer than their work.
    """
    return in_fewer_tasks(files.select("*", "_metadata"), SCANS_A_CORE)


def in_fewer_tasks(df: DataFrame, a_core: int) -> DataFrame:
    """Up to ``TASKS_IN_ONE`` tasks made one, as long as there are so many for each core."""
    tasks, few = df.rdd.getNumPartitions(), a_core * df.sparkSession.sparkContext.defaultParallelism
    return df if tasks <= few else df.coalesce(max(few, tasks // TASKS_IN_ONE))


def within_size(files: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """Split a file listing by size; only the accepted half ever opens a file, and no task is made for the other's."""
    accepted = files.where((F.col("length") <= max_bytes) & (F.col("_metadata.file_size") <= max_bytes)).select(
        "path",
        "length",
        "content",
        F.lit("ok").alias("status"),
        F.lit(None).cast("string").alias("error"),
    )
    refused = files.where((F.col("length") > max_bytes) & (F.col("_metadata.file_size") > max_bytes)).select(
        "path",
        "length",
        F.lit(None).cast("binary").alias("content"),
        F.lit("too_large").alias("status"),
        too_large("path", max_bytes).alias("error"),
    )
    return accepted.unionByName(refused)


def too_large(path: str, max_bytes: int) -> Column:
    return F.concat(path, F.lit(f" is larger than the configured max_bytes of {max_bytes}"))
