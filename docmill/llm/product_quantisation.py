"""Near-duplicate vectors by product quantisation.

Equal vectors of a label are one class, so groups of copies cost one comparison. A coarse
quantiser, the product of one codebook per half of the vector, sends every class to an inverted
list; eight codebooks encode what is left after the list's centre is taken away. Every class asks
the lists nearest to it: table look-ups give the distances to all encoded vectors of a list, and
those that may be near enough, given the error each code is known to have, are compared by exact
cosine in double precision. A pair is found if either side asks the other's list.

Codebooks are fitted on a bounded sample chosen by a hash; every vector is indexed. The number of
lists follows the number of classes, so lists keep their length. Long lists, and lists that very
many ask, are cut into tiles by a hash, and all tiles are compared.

Defined cases: a null label, and a vector that is null, empty, zero or holds null or non-finite
components links with nothing; vectors of different lengths are never linked; repeated rows are
copies and link with each other; an empty table gives no rows. A null vec_id links like any other
and counts as the largest: a component where no vector has an id has null as its id, and all of its
rows are kept. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.llm.ngram_join import runs
from docmill.llm.shared import components, kept, received, send

PARTS, CODES = 8, 256
#: Vectors of a tile on either side.
TILE = 2048
SLACK = 1e-6
#: Most numbers of the vectors that codebooks are fitted on, and of those placed at a time.
SAMPLE_NUMBERS, SLICE_NUMBERS = 1 << 26, 1 << 20


@dataclass(frozen=True)
class Options:
    cosine: float = 0.98
    probes: int = 8
    #: Classes per inverted list, aimed at.
    list_length: int = 256
    #: At most so many centres for each half of the vectors.
    most_centres: int = 1024
    #: Codebooks are fitted on at most so many classes.
    sample: int = 16384
    turns: int = 8


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point, and all squared distances."""
    d = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)
    return d.argmin(1), np.maximum(d, 0)


def means(points: np.ndarray, k: int, turns: int, seed: int) -> np.ndarray:
    """Lloyd's k-means from a random start; empty centres stay where they are."""
    random = np.random.default_rng(seed)
    centres = points[random.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(turns):
        at, _ = nearest(points, centres)
        n = np.bincount(at, minlength=len(centres))
        sums = np.stack([np.bincount(at, points[:, i], len(centres)) for i in range(points.shape[1])], axis=1)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


class Index:
    """Codebooks for unit vectors of one width, zeros added to a multiple of PARTS and of two."""

    def __init__(self, points: np.ndarray, lists: int, options: Options):
        self.width = points.shape[1]
        self.half = self.width // 2
        k = min(options.most_centres, max(1, round(lists**0.5)))
        self.coarse = [means(points[:, : self.half], k, options.turns, 1), means(points[:, self.half :], k, options.turns, 2)]
        left = points - self.centres(self.cells(points, 1)[:, 0])
        step = self.width // PARTS
        self.books = [means(left[:, i * step : (i + 1) * step], CODES, options.turns, 3 + i) for i in range(PARTS)]

    def cells(self, points: np.ndarray, probes: int) -> np.ndarray:
        """The lists nearest to each point, in order; fewer if there are not as many, -1 then."""
        d = [nearest(p, c)[1] for p, c in zip((points[:, : self.half], points[:, self.half :]), self.coarse, strict=True)]
        best = [np.argsort(x, 1, kind="stable")[:, :probes] for x in d]
        sums = np.take_along_axis(d[0], best[0], 1)[:, :, None] + np.take_along_axis(d[1], best[1], 1)[:, None, :]
        names = best[0][:, :, None] * len(self.coarse[1]) + best[1][:, None, :]
        flat = sums.reshape(len(points), -1)
        order = np.argsort(flat, 1, kind="stable")[:, :probes]
        out = np.full((len(points), probes), -1, np.int64)
        out[:, : order.shape[1]] = np.take_along_axis(names.reshape(len(points), -1), order, 1)
        return out

    def centres(self, cells: np.ndarray) -> np.ndarray:
        n = len(self.coarse[1])
        return np.concatenate([self.coarse[0][cells // n], self.coarse[1][cells % n]], axis=1)

    def encode(self, points: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of what is left after the centres, and how far off the coded vectors are."""
        left = points - self.centres(cells)
        step = self.width // PARTS
        codes, error = np.zeros((len(points), PARTS), np.uint8), np.zeros(len(points))
        for i, book in enumerate(self.books):
            part = left[:, i * step : (i + 1) * step]
            codes[:, i], _ = nearest(part, book)
            error += ((part - book[codes[:, i]]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def distances(self, points: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances from points to the coded vectors of one list, by look-up tables."""
        left = points - self.centres(np.array([cell]))
        step = self.width // PARTS
        out = np.zeros((len(points), len(codes)))
        for i, book in enumerate(self.books):
            _, table = nearest(left[:, i * step : (i + 1) * step], book)
            out += table[:, codes[:, i]]
        return out


def units(vectors: pa.Array, width: int) -> np.ndarray:
    """Unit vectors of a list column, zeros added up to the width."""
    flat, n = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(n), width))
    out[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    out /= np.abs(out).max(1, keepdims=True)
    return out / np.sqrt((out**2).sum(1, keepdims=True))


def usable(vector: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def indexed(classes: DataFrame, options: Options) -> tuple[DataFrame, Index | None, int]:
    """Every class with its list, the lists it asks, its codes and their error."""
    facts = classes.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    if not facts.n:
        return classes, None, 0
    width = -(-facts.width // PARTS) * PARTS
    sample = min(options.sample, max(2 * options.probes, SAMPLE_NUMBERS // width, 1))
    chosen = classes.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").toArrow()
    index = Index(units(chosen.column("vector").combine_chunks(), width), -(-facts.n // options.list_length), options)
    sent = send(classes.sparkSession, index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = received(sent)
        step = max(1, min(1024, SLICE_NUMBERS // index.width))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                points = units(batch.column("vector"), index.width)
                cells = index.cells(points, options.probes)
                codes, error = index.encode(points, cells[:, 0])
                asked = [[c for c in row if c >= 0] for row in cells.tolist()]
                sizes = pc.list_value_length(batch.column("vector")).to_pylist()
                columns = [batch.column("id"), batch.column("family"), pa.array(cells[:, 0]), pa.array(asked, pa.list_(pa.int64())), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array([p[:n].tobytes() for p, n in zip(points, sizes, strict=True)], pa.binary())]
                yield pa.record_batch(columns, ["id", "family", "cell", "asked", "codes", "error", "point"])

    family = F.xxhash64(F.col("label"), F.size("vector")).alias("family")
    kind = "id long, family long, cell long, asked array<long>, codes binary, error double, point binary"
    return kept(classes.select("id", family, "vector").mapInArrow(place, kind), "indexed"), index, facts.n


def near_pairs(rows: DataFrame, index: Index, options: Options) -> DataFrame:
    """Linked classes ``(a, b)``, each pair once."""
    lists = rows.groupBy("family", "cell").agg(F.count("*").alias("held"))
    asks = rows.select("family", F.explode("asked").alias("cell")).groupBy("family", "cell").agg(F.count("*").alias("asking"))
    sizes = kept(lists.join(asks, ["family", "cell"]), "list-sizes")
    of = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / TILE)).cast("long")
    cut = lambda n: F.pmod(F.xxhash64("id"), of(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), of(n) - 1))
    held = rows.join(sizes, ["family", "cell"]).select("family", "cell", cut("held").alias("cut"), every("asking").alias("turn"), F.lit(True).alias("held"), "id", "codes", "error", "point")
    asking = rows.select("family", F.explode("asked").alias("cell"), "id", "point").join(sizes, ["family", "cell"])
    asking = asking.select("family", "cell", every("held").alias("cut"), cut("asking").alias("turn"), F.lit(False).alias("held"), "id", F.lit(None).cast("binary").alias("codes"), F.lit(0.0).alias("error"), "point")
    keys = ("family", "cell", "cut", "turn")
    sent = send(rows.sparkSession, index)
    radius = (2 - 2 * options.cosine) ** 0.5 + SLACK

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = received(sent)
        for tile in runs(batches, keys):
            is_held = tile.column("held").to_numpy(zero_copy_only=False)
            there, ask = np.flatnonzero(is_held), np.flatnonzero(~is_held)
            if not len(there) or not len(ask):
                continue
            ids = tile.column("id").to_numpy()
            points = np.frombuffer(b"".join(tile.column("point").to_pylist()), np.float64).reshape(len(ids), -1)
            codes = np.frombuffer(b"".join(tile.column("codes").take(pa.array(there)).to_pylist()), np.uint8).reshape(len(there), PARTS)
            reach = radius + tile.column("error").to_numpy()[there]
            for at in range(0, len(ask), 256):
                some = ask[at : at + 256]
                far = index.distances(np.pad(points[some], ((0, 0), (0, index.width - points.shape[1]))), tile.column("cell")[0].as_py(), codes)
                x, y = np.nonzero(far <= reach**2)
                x, y = some[x], there[y]
                for i in range(0, len(x), 1 << 14):
                    p, q = x[i : i + (1 << 14)], y[i : i + (1 << 14)]
                    good = ((points[p] * points[q]).sum(1) >= options.cosine) & (ids[p] != ids[q])
                    a, b = ids[p[good]], ids[q[good]]
                    if len(a):
                        yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    placed = held.unionByName(asking).repartition(*keys).sortWithinPartitions(*keys)
    return placed.mapInArrow(paired, "a long, b long").distinct()


def near_duplicates(vectors: DataFrame, vector: str = "embedding", options: Options = Options()) -> DataFrame:  # noqa: B008
    """``vectors(vec_id, <vector>, label)`` to one row per vector: n_links, component_id, kept."""
    rows = vectors.select("vec_id", "label", F.col(vector).alias("vector"))
    good = usable(F.col("vector"), F.col("label"))
    classes = kept(rows.where(good).groupBy("label", "vector").agg(F.coalesce(F.min("vec_id"), F.xxhash64("label", "vector")).alias("id"), F.min("vec_id").alias("least"), F.count("*").alias("n")), "vector-classes")
    placed, index, n = indexed(classes, options)
    if n:
        links = kept(near_pairs(placed, index, options), "vector-links")
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        other = both.join(classes.select(F.col("id").alias("b"), "n"), "b").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("more"))
        ends = components(links, "vector-parts").select(F.col("node").alias("id"), "component")
        known = classes.join(other, "id", "left").join(ends, "id", "left")
    else:
        known = classes.withColumn("more", F.lit(0).cast("long")).withColumn("component", F.col("id"))
    if not classes.where("least IS NULL").isEmpty():
        # Classes without an id went by a hash of the vector; components are named by ids alone.
        part = F.coalesce("component", "id")
        names = known.groupBy(part.alias("component")).agg(F.min("least").alias("name"))
        known = known.withColumn("component", part).join(names, "component").drop("id", "component").withColumns({"id": F.col("name"), "component": F.col("name")})
    known = kept(known.select("label", "vector", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id")), "vector-results")
    linked = rows.where(good).join(known, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
