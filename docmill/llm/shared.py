"""Helpers of several operators: tables kept in the shared folder, keys, components of links."""

from __future__ import annotations

import pickle

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.plans.storage import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table that is read again to the shared folder, where lost executors don't matter."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def send(spark: SparkSession, value) -> Broadcast:
    """Broadcast a value of bounded size, its classes included; ``received`` gives it in a task."""
    return spark.sparkContext.broadcast({"sent": cloudpickle.dumps(value)})


def received(sent: Broadcast):
    """The value, unpacked once per Python worker; later tasks of the worker get the same object."""
    box = sent.value
    if "value" not in box:
        box["value"] = pickle.loads(box["sent"])
    return box["value"]


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo a number; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of


def components(links: DataFrame, purpose: str) -> DataFrame:
    """Connected components of links ``(a, b)`` of bigint: one row ``(node, component)`` per node.

    The component is its smallest node. Rounds of the large-star and small-star steps: every
    node hands its larger, then its smaller neighbours to the smallest one, until nothing
    changes. Minima are combined before they are shuffled and joined back, so a node with very
    many neighbours is never gathered in one task. A table of each round is written.
    """
    edges = kept(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), purpose
    )

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()

    before = state(edges)
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = kept(
            large.join(small, "a")
            .select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct(),
            purpose,
        )
        after = state(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
