"""Shared storage for intermediate tables and outputs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder all executors can reach, below the one the session names."""
    base = spark.conf.get(SETTING, None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="docmill-")
        spark.conf.set(SETTING, base)
    return f"{base.rstrip('/')}/docmill-{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str, by: str | None = None, path: str | None = None) -> DataFrame:
    """Write a table that is read several times once; later reads prune and filter it.

    With ``by`` each value has its own folder, so a reader of one value opens no other.
    A given ``path`` is replaced, otherwise the table gets a fresh folder.
    """
    path = path or shared_folder(df.sparkSession, purpose)
    # Such tables hold texts more than anything else, which take a quarter to a half less than by default.
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer if by is None else writer.partitionBy(by)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
