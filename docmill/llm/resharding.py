"""Moving documents between shards so that the fewest bytes travel.

Old shards are cut into blocks by a hash of the document. The sizes of all blocks, a bounded
table, give supplies; new capacities give demands; a minimum-cost flow says how many bytes each
old shard sends to each new one (staying costs nothing). Whole blocks, largest first, realise
the flow. Then the files of the shards that lose or gain blocks are written anew.

Defined cases: a null text has no bytes and its crc32 is that of nothing; every row counts its
text's UTF-8 bytes plus one, so sizes never vanish; repeated rows are kept and get slots of their
own; rows whose old shard is null are in shard NO_SHARD, from which all rows move; an empty table
gives no rows and no moves. Other columns pass through ``rewritten``.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docmill.llm.shared import kept
from docmill.plans.storage import shared_folder

BLOCKS = 2048
#: Old shard of rows that are in none.
NO_SHARD = -1


def least_cost_flow(supply: list[int], demand: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Units sent from each supply to each demand at the least total cost; totals must agree.

    Cheapest augmenting paths, one after the other, over residual arcs.
    """
    rows, columns = len(supply), len(demand)
    flow = [[0] * columns for _ in range(rows)]
    left, open_ = list(supply), list(demand)
    while sum(left):
        far = {("s", i): 0 for i in range(rows) if left[i]}
        came: dict = {k: None for k in far}
        changed = True
        while changed:
            changed = False
            for i in range(rows):
                for j in range(columns):
                    a, b = far.get(("s", i)), far.get(("d", j))
                    if a is not None and (b is None or a + cost[i][j] < b):
                        far[("d", j)], came[("d", j)], b, changed = a + cost[i][j], i, a + cost[i][j], True
                    if flow[i][j] and b is not None and (a is None or b - cost[i][j] < a):
                        far[("s", i)], came[("s", i)], changed = b - cost[i][j], j, True
        end = min((d, j) for (side, j), d in far.items() if side == "d" and open_[j])[1]
        path, at, amount = [], ("d", end), open_[end]
        while came[at] is not None:
            back = came[at]
            if at[0] == "d":
                path.append((back, at[1], 1))
                at = ("s", back)
            else:
                path.append((at[1], back, -1))
                amount = min(amount, flow[at[1]][back])
                at = ("d", back)
        amount = min(amount, left[at[1]])
        for i, j, sign in path:
            flow[i][j] += sign * amount
        left[at[1]] -= amount
        open_[end] -= amount
    return flow


def realised(sizes: dict[int, int], quota: dict[int, int]) -> dict[int, int]:
    """Blocks of one old shard to new shards, largest first to the one that lacks most."""
    lacks = [(-v, k) for k, v in quota.items()]
    heapq.heapify(lacks)
    out = {}
    for block, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        missing, shard = heapq.heappop(lacks)
        out[block] = shard
        heapq.heappush(lacks, (missing + size, shard))
    return out


@dataclass
class Plan:
    """Where each block goes; ``first`` is the slot of its first row in the new shard."""

    blocks: DataFrame
    moved_bytes: int
    affected: list[int]


def sized(docs: DataFrame, old: Column, blocks: int = BLOCKS) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "*",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(old.cast("int"), F.lit(NO_SHARD)).alias("old_shard"),
        F.pmod(F.xxhash64("doc_id", text), F.lit(blocks)).cast("int").alias("block"),
    )


def planned(docs: DataFrame, capacities: list[float] | int) -> Plan:
    """The plan for ``sized`` documents; ``capacities`` are relative, or a number of equal shards."""
    spark = docs.sparkSession
    shares = [1.0] * capacities if isinstance(capacities, int) else list(capacities)
    sizes: dict[int, dict[int, int]] = {}
    counts = {}
    for r in docs.groupBy("old_shard", "block").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect():
        sizes.setdefault(r.old_shard, {})[r.block] = r.size
        counts[r.old_shard, r.block] = r.n
    olds = sorted(sizes)
    supply = [sum(sizes[i].values()) for i in olds]
    total, edge, demand = sum(supply), 0, []
    for j in range(len(shares)):
        upto = round(total * sum(shares[: j + 1]) / sum(shares)) if j + 1 < len(shares) else total
        demand.append(upto - edge)
        edge = upto
    flow = least_cost_flow(supply, demand, [[int(i != j) for j in range(len(shares))] for i in olds])
    rows, first, moved, affected = [], [0] * len(shares), 0, set()
    for i, sends in zip(olds, flow, strict=True):
        goes = realised(sizes[i], {j: x for j, x in enumerate(sends) if x})
        for block in sorted(goes):
            j = goes[block]
            rows.append((i, block, j, first[j]))
            first[j] += counts[i, block]
            if i != j:
                moved += sizes[i][block]
                affected |= {i, j}
    kind = "old_shard int, block int, shard int, first long"
    return Plan(spark.createDataFrame(rows, kind), moved, sorted(affected))


def rewritten(docs: DataFrame, plan: Plan) -> DataFrame:
    """All documents with their shards. Affected shards are written anew, one folder each; others stay as they are."""
    placed = docs.join(F.broadcast(plan.blocks), ["old_shard", "block"])
    changed = F.col("shard").isin(plan.affected)
    path = shared_folder(docs.sparkSession, "shards")
    placed.where(changed).write.option("compression", "zstd").partitionBy("shard").parquet(path)
    schema = placed.schema
    again = docs.sparkSession.read.schema(schema).parquet(path)
    return again.unionByName(placed.where(~changed)) if len(plan.affected) < plan.blocks.select("shard").distinct().count() else again


def slotted(placed: DataFrame) -> DataFrame:
    """Gapless numbers within each shard: where the block begins, plus the rank within the block."""
    order = Window.partitionBy("old_shard", "block").orderBy("doc_id", "size", "text_crc32")
    return placed.withColumn("slot", F.col("first") + F.row_number().over(order) - 1)


def reshard(docs: DataFrame, old: Column, capacities: list[float] | int) -> DataFrame:
    """``docs(doc_id, text)`` moved from shards ``old`` to shards of equal bytes: shard and slot per row."""
    rows = sized(docs, old)
    placed = rewritten(rows, planned(rows, capacities))
    return slotted(placed.select("doc_id", "size", "text_crc32", "old_shard", "block", "shard", "first"))
