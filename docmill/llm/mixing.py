"""Mixing sources to target weights by weighted sampling without replacement.

Each document draws an exponential key, divided by its quality weight; within a source documents
are taken in the order of their keys until the token budget is filled. A target of several times
the source first takes complete epochs; the rest is the selection. Draws depend on the document's
id and the seed alone, so reruns agree.

Prefix sums are taken in two steps: sums of buckets of keys, then the rows of the one bucket in
which the budget ends. No source is ever gathered in one task. The selection then is one cut per
source, and rows are compared with it.

Defined cases: sizes of null texts are 0 and such rows are never taken; a null source is one
source and comes last; rows with equal id and size stand or fall together; an empty table gives
no rows. Other columns pass through; columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docmill.llm.shared import kept

WORD = "[^\\x20\\x09-\\x0D]+"
#: Buckets per doubling of the key; a bucket holds less than one in two hundred documents of equal weight.
FINE = 64
MOST_EPOCHS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """The share of a-z among all characters, at least 0.05: prose weighs more than tables and shouting."""
    return F.greatest(F.lit(0.05), F.coalesce(F.length(F.regexp_replace(text, "[^a-z]+", "")) / F.nullif(F.length(text), F.lit(0)), F.lit(0.05)))


def draw(doc_id: Column, seed: int) -> Column:
    """Evenly distributed between 0 and 1, from the id."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + 0.5) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """``(source, source_size)`` with the target of each: shares of the total by weight, held at
    MOST_EPOCHS times the source, the excess reshared until none is above."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*map(F.lit, weights))
    ranked = sizes.select("*", F.row_number().over(by_name).alias("place")).withColumn("weight", F.element_at(cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int")))
    tight = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before, rest, everywhere = tight.rowsBetween(Window.unboundedPreceding, -1), tight.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    most = F.col("source_size") * MOST_EPOCHS
    level = ranked.select(
        "*",
        ((F.sum("source_size").over(everywhere) - F.coalesce(F.sum(most).over(before), F.lit(0))) / F.sum("weight").over(rest)).alias("level"),
        F.row_number().over(tight).alias("turn"),
    )
    free = F.col("level") * F.col("weight") <= most
    settled = level.withColumn("settled", F.min(F.when(free, F.struct("turn", "level"))).over(everywhere))
    held = F.col("settled").isNull() | (F.col("turn") < F.col("settled.turn"))
    return settled.select("source", "source_size", F.when(held, most.cast("double")).otherwise(F.col("settled.level") * F.col("weight")).alias("target"))


def cuts(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source the complete epochs and the last row taken beyond them, as ``(key, doc_id, size)``."""
    same = F.col("r.source").eqNullSafe(F.col("g.source"))
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST_EPOCHS))).otherwise(0).cast("long")
    goals = goals.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    sums = rows.where("size > 0").groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.max(F.struct("key", "doc_id", "size")).alias("last"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    buckets = sums.withColumn("upto", upto).alias("r").join(goals.alias("g"), same).select("g.*", "r.bucket", "r.words", "r.upto", "r.last")
    whole = buckets.where(F.col("upto") <= F.col("rest")).groupBy("source").agg(F.max("last").alias("whole"))
    ends = buckets.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") < F.col("rest")))
    inside = rows.where("size > 0").alias("r").join(ends.alias("g"), same & (F.col("r.bucket") == F.col("g.bucket")))
    order = Window.partitionBy("g.source").orderBy("r.key", "r.doc_id", "r.size").rowsBetween(Window.unboundedPreceding, 0)
    passed = inside.select(F.col("g.source").alias("source"), F.struct("r.key", "r.doc_id", "r.size").alias("last"), (F.col("g.upto") - F.col("g.words") + F.sum("r.size").over(order)).alias("upto"), "g.rest")
    partly = passed.where(F.col("upto") + F.col("upto") - F.col("last.size") <= 2 * F.col("rest")).groupBy("source").agg(F.max("last").alias("partly"))
    out = goals
    for name, table in (("whole", whole), ("partly", partly)):
        out = out.alias("g").join(table.alias("t"), F.col("g.source").eqNullSafe(F.col("t.source")), "left").select("g.*", f"t.{name}")
    return out.withColumn("cut", F.greatest("whole", "partly")).drop("whole", "partly", "rest")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), seed: int = 11) -> DataFrame:
    """``docs(doc_id, text, source, ...)`` with size, source_size, target, and ``taken``: the words of
    the mix that come from this row, repeats counted."""
    results = ("size", "key", "source_size", "target", "taken")
    docs = docs.select(*(f"`{c}`" for c in docs.columns if c.lower() not in results))
    drawn = docs.withColumn("size", word_count(F.col("text"))).withColumn("key", -F.ln(draw(F.col("doc_id"), seed)) / quality_weight(F.col("text")))
    rows = kept(drawn.select("doc_id", "source", "size", "key", F.floor(F.log2("key") * FINE).alias("bucket")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    cut = kept(cuts(rows, targets(sizes, weights)), "mix-cuts")
    taken = F.col("size") * F.col("epochs") + F.when(F.struct("key", "doc_id", "size") <= F.col("cut"), F.col("size")).otherwise(0)
    joined = drawn.alias("d").join(cut.alias("c"), F.col("d.source").eqNullSafe(F.col("c.source"))).select("d.*", "c.source_size", "c.target", "c.epochs", "c.cut")
    return joined.withColumn("taken", taken).drop("epochs", "cut", "key")


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row as often as it is taken."""
    times = F.try_divide("taken", "size").cast("int")
    return mixed.where("taken > 0").withColumn("__turn", F.explode(F.sequence(F.lit(1), times))).drop("__turn")
