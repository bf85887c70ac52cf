"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the folder of tables, BENCH_CPUS the number of local cores. Every query
runs once to warm up and is then timed, writing all columns to a sink that discards them.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from docmill.plans.catalog import QUERIES  # noqa: E402

HEADLINES = (
    "html_to_markdown",
    "normalize_markdown",
    "plain_to_markdown",
    "decode_entities",
    "json_to_markdown",
    "csv_to_markdown",
    "notebook_to_markdown",
    "markdown_table",
    "xlsx_to_markdown",
    "docx_to_markdown",
    "pptx_to_markdown",
    "epub_to_markdown",
    "explode_archive",
    "select_engine",
    "conversion_report",
    "convert_documents",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("docmill-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINES
    times = {}
    for name in chosen:
        for _ in range(2):
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    line = {
        "metric": "headline queries, total time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(folder).name.removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(line))


main()
