"""Compression of vectors to one code per part: Lloyd's rounds over two trees, in whole numbers.

Components become integers, vectors are cut into PARTS equal parts, and each part position has a
codebook. Rows are stored once in blocks; each block holds, per part position, a balanced tree
over its parts: the box of every node and the cached sum of its rows. A round grows a tree over
the entries of each codebook and goes down both trees together. Of the pairs (node of parts, node
of entries) those whose boxes are farther apart than another pair's are at the most are given up,
and once single entries are left, those that are nowhere in the box nearer than the best one. A
node with one entry left is assigned as a whole by its cached sum; leaves that stay uncertain are
settled by exact distances. All numbers are 64-bit integers, so results don't depend on blocks.

Only codebooks, sums and counts (PARTS x ENTRIES x part length) move between the rounds; every
task adds up its blocks before. Blocks are files in the shared folder, so lost tasks are repeated.

Defined cases: a vector that is null or holds null or non-finite components is dropped. Vectors of
the commonest length are coded (of equally common ones the shorter); zeros are added to a multiple
of PARTS. Vectors of other lengths, and empty ones, have a null code and error. Integers beyond
+-LARGEST are held at it, which keeps errors of 8,192 components and less within 64 bits (longer
vectors are held lower). Rows with equal or null ids are rows of their own; the first entries
follow the order of id, nulls last, then vector. With fewer than ENTRIES vectors a codebook has as
many entries as there are vectors. Null labels are one label. No vectors give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill.llm.shared import kept, received, send

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Rows of a block, and the least rows of a leaf of its trees.
BLOCK, LEAF = 4096, 64
LARGEST = 1 << 24


def largest(width: int) -> int:
    """What integers are held at, so that the error of a vector of this width is below 2^63."""
    return min(LARGEST, int((2.0**60 / max(width, 1)) ** 0.5))


def whole_numbers(vectors: pa.Array, width: int) -> np.ndarray:
    """``floor(SCALE * x)`` of list rows of one length, zeros added up to the width."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    out = np.zeros((len(flat), width), np.int64)
    most = largest(width)
    out[:, : flat.shape[1]] = np.clip(np.floor(flat * SCALE), -most, most)
    return out


def borders(n: int, level: int) -> np.ndarray:
    """Where the nodes of a level begin and end in the tree's order."""
    return (np.arange((1 << level) + 1) * n) >> level


@dataclass
class Tree:
    """A balanced tree over rows: halves at the median of the widest side. Nodes are numbered level by level."""

    order: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray
    depth: int

    @classmethod
    def depth_of(cls, n: int, leaf: int) -> int:
        return max(0, (n // leaf).bit_length() - 1)

    @classmethod
    def over(cls, rows: np.ndarray, leaf: int) -> Tree:
        n = len(rows)
        depth, order = cls.depth_of(n, leaf), np.arange(n)
        nodes: list[list[np.ndarray]] = [[], [], []]
        for level in range(depth + 1):
            ends = borders(n, level)
            sorted_rows = rows[order]
            for box, of in zip(nodes, (np.minimum, np.maximum, np.add), strict=True):
                box.append(of.reduceat(sorted_rows, ends[:-1], axis=0))
            if level < depth:
                node = np.repeat(np.arange(1 << level), np.diff(ends))
                side = (nodes[1][-1] - nodes[0][-1]).argmax(1)
                order = order[np.lexsort((sorted_rows[np.arange(n), side[node]], node))]
        return cls(order, *(np.concatenate(x) for x in nodes), depth)

    def at(self, level: int, nodes: np.ndarray) -> np.ndarray:
        return nodes + (1 << level) - 1


class Book:
    """Entries of one part position and the tree over them."""

    def __init__(self, entries: np.ndarray):
        self.entries, self.tree = entries, Tree.over(entries, 1)
        self.squares = (entries**2).sum(1)

    def last(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each leaf of the tree, its entries: the first, and how many."""
        ends = borders(len(self.entries), self.tree.depth)
        return ends[:-1], np.diff(ends)


def firsts(nodes: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]]))


def near_pairs(low, high, nodes, other_low, other_high) -> np.ndarray:
    """Which pairs of boxes may hold nearest neighbours; pairs of a node lie together."""
    gap = np.maximum(0, np.maximum(other_low - high, low - other_high))
    span = np.maximum(other_high - low, high - other_low)
    at = firsts(nodes)
    most = np.minimum.reduceat((span**2).sum(1), at)
    return (gap**2).sum(1) <= np.repeat(most, np.diff(np.append(at, len(nodes))))


def undominated(low, high, nodes, entries, book: Book) -> np.ndarray:
    """Which entries are not, everywhere in the box, behind the one nearest to its centre."""
    values = book.entries[entries]
    centre = (2 * values - low - high) ** 2
    at = firsts(nodes)
    n = np.diff(np.append(at, len(nodes)))
    order = np.lexsort((entries, centre.sum(1), nodes))
    best = np.repeat(entries[order[at]], n)
    apart = values - book.entries[best]
    ahead = 2 * (np.where(apart > 0, high, low) * apart).sum(1) + book.squares[best] - book.squares[entries]
    return (entries == best) | (ahead > 0) | ((ahead == 0) & (entries < best))


def assign(tree: Tree, rows: np.ndarray, book: Book) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The nearest entry of each row, lowest index first; counts and sums by entry; rows settled one by one."""
    n, k = rows.shape[0], len(book.entries)
    in_order, code = rows[tree.order], np.empty(n, np.int64)
    counts, sums = np.zeros(k, np.int64), np.zeros_like(book.entries)
    nodes = groups = np.zeros(1, np.int64)
    level = other = 0
    single = False
    settled = 0
    while len(nodes):
        at = tree.at(level, nodes)
        low, high = tree.low[at], tree.high[at]
        for _ in range(2):
            if single:
                break
            if other < book.tree.depth:
                other += 1
                nodes, groups = np.repeat(nodes, 2), np.repeat(groups * 2, 2) + np.tile([0, 1], len(groups))
                low, high = np.repeat(low, 2, axis=0), np.repeat(high, 2, axis=0)
                below = book.tree.at(other, groups)
                good = near_pairs(low, high, nodes, book.tree.low[below], book.tree.high[below])
            else:
                single = True
                begin, held = book.last()
                m = held[groups]
                place = np.repeat(begin[groups] - (np.cumsum(m) - m), m) + np.arange(m.sum())
                nodes, groups = np.repeat(nodes, m), book.tree.order[place]
                low, high = np.repeat(low, m, axis=0), np.repeat(high, m, axis=0)
                good = near_pairs(low, high, nodes, book.entries[groups], book.entries[groups])
            nodes, groups, low, high = nodes[good], groups[good], low[good], high[good]
        if single:
            good = undominated(low, high, nodes, groups, book)
            nodes, groups = nodes[good], groups[good]
            starts = firsts(nodes)
            alone = np.diff(np.append(starts, len(nodes))) == 1
            ends = borders(n, level)
            for i in starts[alone]:
                node, entry = nodes[i], groups[i]
                code[ends[node] : ends[node + 1]] = entry
                counts[entry] += ends[node + 1] - ends[node]
                sums[entry] += tree.sums[tree.at(level, node)]
            left = np.repeat(~alone, np.diff(np.append(starts, len(nodes))))
            nodes, groups = nodes[left], groups[left]
        if level < tree.depth:
            level += 1
            nodes, groups = np.concatenate([nodes * 2, nodes * 2 + 1]), np.tile(groups, 2)
            order = np.argsort(nodes, kind="stable")
            nodes, groups = nodes[order], groups[order]
        elif single:
            order = np.lexsort((groups, nodes))
            nodes, groups = nodes[order], groups[order]
            starts = np.append(firsts(nodes), len(nodes)) if len(nodes) else np.zeros(1, np.int64)
            ends = borders(n, level)
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                some, entries = slice(ends[nodes[a]], ends[nodes[a] + 1]), groups[a:b]
                near = (book.squares[entries] - 2 * in_order[some] @ book.entries[entries].T).argmin(1)
                code[some] = entries[near]
                np.add.at(counts, code[some], 1)
                np.add.at(sums, code[some], in_order[some])
                settled += len(near)
            break
    out = np.empty(n, np.int64)
    out[tree.order] = code
    return out, counts, sums, settled


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x.cast("double")))
    return F.coalesce(finite, F.lit(False))


def listed(column: pa.Array) -> pa.Array:
    """All values as the list of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)


def in_blocks(rows: DataFrame, width: int) -> DataFrame:
    """Rows ``(id, label, vector)`` in stored blocks with their trees."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                points = whole_numbers(batch.column("vector"), width)
                trees = [Tree.over(p, LEAF) for p in np.split(points, PARTS, axis=1)]
                held = [points.astype("<i4"), *(np.stack([getattr(t, name) for t in trees]).astype(kind) for name, kind in (("order", "<u2"), ("low", "<i4"), ("high", "<i4"), ("sums", "<i8")))]
                columns = [listed(batch.column("id")), listed(batch.column("label")), *(pa.array([x.tobytes()], pa.binary()) for x in held)]
                yield pa.record_batch(columns, ["ids", "labels", "points", "orders", "low", "high", "sums"])

    kinds = {f.name: f.dataType for f in rows.schema}
    schema = T.StructType([T.StructField("ids", T.ArrayType(kinds["id"])), T.StructField("labels", T.ArrayType(kinds["label"]))])
    for name in ("points", "orders", "low", "high", "sums"):
        schema.add(name, T.BinaryType())
    return kept(rows.mapInArrow(build, schema), "vector-blocks")


def opened(batch: pa.RecordBatch, row: int, width: int) -> tuple[np.ndarray, list[Tree]]:
    """The points of a stored block and its trees."""

    def array(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(batch.column(name)[row].as_buffer(), kind)

    step = width // PARTS
    points = array("points", "<i4").reshape(-1, width).astype(np.int64)
    boxes = [array(name, kind).reshape(PARTS, -1, step).astype(np.int64) for name, kind in (("low", "<i4"), ("high", "<i4"), ("sums", "<i8"))]
    orders = array("orders", "<u2").reshape(PARTS, -1)
    return points, [Tree(orders[i], *(b[i] for b in boxes), Tree.depth_of(len(points), LEAF)) for i in range(PARTS)]


def moved(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: every part to its nearest entry, every entry to the floored mean of its parts."""
    step, k = books[0].shape[1], len(books[0])
    sent = send(blocks.sparkSession, books)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Book(b) for b in received(sent)]
        counts, sums = np.zeros((PARTS, k), np.int64), np.zeros((PARTS, k, step), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                points, over = opened(batch, row, step * PARTS)
                for i in range(PARTS):
                    _, more, total, _ = assign(over[i], points[:, i * step : (i + 1) * step], trees[i])
                    counts[i] += more
                    sums[i] += total
        part, entry = np.nonzero(counts)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * step, pa.int32()), pa.array(sums[part, entry].ravel()))
        yield pa.record_batch([pa.array(part), pa.array(entry), pa.array(counts[part, entry]), lists], ["part", "entry", "n", "sums"])

    partial = blocks.select("points", "orders", "low", "high", "sums").mapInArrow(added, "part long, entry long, n long, sums array<long>")
    totals = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(step)))
    after = [b.copy() for b in books]
    for part, entry, n, *total in totals.collect():
        after[part][entry] = np.array(total, np.int64) // n
    return after


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def fit(blocks: DataFrame, first: np.ndarray, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks, one per part position, from the integers of the first vectors."""
    books = [np.ascontiguousarray(b) for b in np.split(first, PARTS, axis=1)]
    for _ in range(rounds):
        books = moved(blocks, books)
    return books


def encoded(blocks: DataFrame, books: list[np.ndarray], id_type: T.DataType, label_type: T.DataType) -> DataFrame:
    """``(vec_id, label, code, error)`` of every row in the blocks."""
    sent = send(blocks.sparkSession, books)
    step = books[0].shape[1]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Book(b) for b in received(sent)]
        for batch in batches:
            for row in range(batch.num_rows):
                points, over = opened(batch, row, step * PARTS)
                codes, error = np.empty((len(points), PARTS), np.uint8), np.zeros(len(points), np.int64)
                for i in range(PARTS):
                    part = points[:, i * step : (i + 1) * step]
                    codes[:, i], *_ = assign(over[i], part, trees[i])
                    error += ((part - trees[i].entries[codes[:, i]]) ** 2).sum(1)
                text = codes.tobytes().hex()
                size = 2 * PARTS
                columns = [batch.column(c)[row].values for c in ("ids", "labels")]
                yield pa.record_batch([*columns, pa.array([text[j : j + size] for j in range(0, len(text), size)], pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    schema = T.StructType([T.StructField("vec_id", id_type), T.StructField("label", label_type), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return blocks.mapInArrow(coded, schema)


def compress(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vectors(vec_id, <vector>, label)`` to ``vec_id, code, error, label_error, codebooks_sha256``."""
    rows = vectors.select(F.col("vec_id").alias("id"), "label", F.col(vector).alias("vector")).where(usable(F.col("vector")))
    lengths = rows.where(F.size("vector") > 0).groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), "length").first()
    length = common.length if common else None
    types = {f.name: f.dataType for f in rows.schema}
    empty = F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    others = rows.where(F.size("vector") != length if common else F.lit(True)).select(F.col("id").alias("vec_id"), "label", *empty)
    if length is None:
        done, books = others, []
    else:
        fitting = rows.where(F.size("vector") == length)
        width = -(-length // PARTS) * PARTS
        chosen = fitting.orderBy(F.col("id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").toArrow()
        first = whole_numbers(chosen.column("vector").combine_chunks(), width)
        blocks = in_blocks(fitting, width)
        books = fit(blocks, first)
        done = encoded(blocks, books, types["id"], types["label"]).unionByName(others)
    done = kept(done, "vector-codes")
    totals = kept(done.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "of")
    return done.join(totals, F.col("label").eqNullSafe(F.col("of")), "left").select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
