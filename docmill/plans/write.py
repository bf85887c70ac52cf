"""Markdown to storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.functions.strings import percent_decode
from docmill.operators.results import output_hint


def write_markdown(results: DataFrame, path: str, layout: str = "parquet") -> DataFrame:
    """Write result rows, return them with ``output_path`` set and ``markdown`` empty.

    ``parquet`` stores all columns, one folder per format; a file holds many documents.
    ``text`` stores one folder with one file per document and is for small exports. Convert with ``truncate=False`` first: what is
    written is not cut. The returned rows are read back, so nothing is converted twice.
    """
    spark = results.sparkSession
    if layout == "parquet":
        results.write.mode("overwrite").partitionBy("format").parquet(path)
        kept = spark.read.parquet(path)
        location = F.col("_metadata.file_path")
    elif layout == "text":
        facts = f"{path.rstrip('/')}/_results"
        results.write.mode("overwrite").parquet(facts)
        kept = spark.read.parquet(facts)
        texts = kept.where(F.col("markdown").isNotNull()).select("doc_id", "markdown")
        texts.write.mode("overwrite").partitionBy("doc_id").text(f"{path.rstrip('/')}/markdown")
        # Folder names escape some characters, so the paths are those of the files written.
        files = spark.read.schema("value string, doc_id string").text(f"{path.rstrip('/')}/markdown")
        places = files.groupBy("doc_id").agg(F.min("_metadata.file_path").alias("_location"))
        kept = kept.join(places, "doc_id", "left")
        location = F.col("_location")
    else:
        raise ValueError(f'unknown layout "{layout}"; expected parquet or text')
    # What Spark reports is a URI; a path that can be opened has its escapes undone.
    plain = F.coalesce(percent_decode(location), location)
    written = kept.withColumn("output_path", F.when(F.col("status") == "ok", plain))
    notes = F.nullif(F.concat_ws("\n", "notes", output_hint(F.col("output_path"))), F.lit(""))
    return written.withColumn("notes", notes).select(
        *[
            F.lit(None).cast("string").alias(c) if c == "markdown" else F.col(c)
            for c in results.columns
        ]
    )
