"""Documents converted as they arrive."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docmill.options import ConvertOptions
from docmill.plans.convert import convert_documents, formats_of
from docmill.plans.storage import shared_folder
from docmill.sources.files import in_fewer_tasks, within_size

FILES = "path string, modificationTime timestamp, length bigint, content binary"
#: Tasks for each core that list the files of a batch, of which Spark otherwise gives every file one.
LISTINGS_A_CORE = 4
#: Batches after which the log of the files seen is put together anew, all of it; by default 10.
LOG_BATCHES = 200


def _unless_set(spark: SparkSession, values: dict[str, int]) -> None:
    """Settings of the session, from which the file source takes them at every batch, where it has none of its own."""
    for name, value in values.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def stream_documents(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    options: ConvertOptions = ConvertOptions(),
    glob: str | None = None,
    max_files: int = 100_000,
    containers: bool = True,
) -> StreamingQuery:
    """Convert files that landed since the last run, each once, and append the results.

    A micro-batch writes its own ``batch_id`` folder in overwrite mode, below a folder for the
    id that the checkpoint holds. So a batch that is run again after a failure replaces its
    first attempt, and a new checkpoint leaves earlier output alone. What every batch costs
    besides its files is kept small: only converters of formats that it holds are planned.
    """
    listings = LISTINGS_A_CORE * spark.sparkContext.defaultParallelism
    _unless_set(
        spark,
        {
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": listings,
            "spark.sql.streaming.fileSource.log.compactInterval": LOG_BATCHES,
        },
    )
    # Batches follow one another, so each may replace the unpacked parts of the one before.
    parts_path = shared_folder(spark, "stream-parts")
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILES)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
    )
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)

    @cache
    def results_path() -> str:
        query = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
        return f"{out.rstrip('/')}/query_id={query}"

    def convert(batch: DataFrame, batch_id: int) -> None:
        # A task writes a file, whether it has rows or not.
        documents = in_fewer_tasks(batch, 1).select(
            F.col("path").alias("doc_id"), F.col("path").alias("input"), "content", "status", "error"
        )
        formats = formats_of(documents, options)
        results = convert_documents(documents, options, containers=containers, parts_path=parts_path, formats=formats)
        results.write.mode("overwrite").parquet(f"{results_path()}/batch_id={batch_id}")

    return (
        within_size(reader.load(path), options.max_bytes)
        .writeStream.foreachBatch(convert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
