"""Similarity join of word n-gram sets: components of links, pairs of at least a given Jaccard similarity.

A document's set holds its distinct n-word shingles, as sorted 64-bit hashes. Equal sets are one
class. Two sets that are similar enough share a shingle among the first few of each in any common
order, so only those few are keys; shingles found in very many documents come last in the order,
which keeps common passages from being keys. Keys of one class alone lead nowhere, nor do keys that
lie too late in all their sets to be the first shared one of a similar pair. The classes of
a key meet in tiles by size band (a set is compared within its band and, unless its key lies too late
for the smaller of two sets, with the next larger one).
Within a tile, bitmap signatures of the parity of hashed shingles bound the overlap from above,
first short ones, then ones as long as the sets need, before sorted arrays are intersected.

Links are found in two turns. First, in tiles of a class's first shared keys, each class is compared with
the first likely one before it and with the likeliest one. Components of these links are then known, and only keys that still
hold several components are looked at, for pairs across components; each such pair is compared.
So large groups of near copies cost about one comparison a member, and no link between different
components is lost. Large tiles are cut by a hash, and all cuts are compared with each other.
``join`` gives components only and compares few pairs within one; ``with_links`` also counts every
link of a document: the sets of a component then meet once each, again in cuts.

Defined cases: null and empty texts have empty sets and are linked with nothing; a text of fewer
words than a shingle has them all as its one shingle; repeated rows are copies of each other; an
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.llm.shared import components, kept, received, send
from docmill.llm.textops import Hasher, bytes_of, counts_of, grams, lists, mixed, slices

BITS = 1024
#: Rows of a tile that are compared with each other at a time; larger tiles are cut.
TILE = 512
#: A shingle in so many sets of a slice is counted, and one in so many sets overall is common.
COUNTED, COMMON = 4, 16
#: Common shingles that are sent to all executors; the order of the others is as good, only slower.
BROADCAST_SHINGLES = 1 << 17
FILTER_WORDS = 1 << 17
SEEN = 1 << 18


@dataclass(frozen=True)
class Options:
    words: int = 4
    #: Similar: 100 * intersection >= percent * union.
    percent: int = 85
    first_keys: int = 4


def sets_of(hasher: Hasher, data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each document."""
    words_at, _, hashes = hasher.words(data, offsets)
    n = counts_of(words_at, offsets)
    whole, runs = grams(hashes, n, words)
    ends = np.cumsum(runs)
    starts, first = ends - runs, np.cumsum(n) - n
    out = []
    for i in range(len(n)):
        if runs[i]:
            out.append(np.unique(whole[starts[i] : ends[i]]))
        elif n[i]:
            out.append(grams(hashes[first[i] : first[i] + n[i]], n[i : i + 1], int(n[i]))[0])
        else:
            out.append(whole[:0])
    return out


def name_of(shingles: np.ndarray) -> int:
    """A 64-bit name of a set."""
    total = mixed(shingles + np.uint64(len(shingles))).sum(dtype=np.uint64)
    return int(mixed(np.array([total ^ np.uint64(len(shingles))]))[0].view(np.int64))


def described(docs: DataFrame, words: int) -> DataFrame:
    """``(doc_id, n, name)`` per document; rows without ``n`` count a shingle (in ``name``) of many sets."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=True)
        for batch in slices(batches):
            sets = sets_of(hasher, *bytes_of(batch.column("text")), words)
            names = [name_of(s) if len(s) else None for s in sets]
            different = {name: s for name, s in zip(names, sets, strict=True) if name is not None}
            shingles, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *different.values()]), return_counts=True)
            many = n >= COUNTED
            ids, more = batch.column("doc_id"), int(many.sum())
            yield pa.record_batch(
                [
                    pa.concat_arrays([ids, pa.nulls(more, ids.type)]),
                    pa.array([len(s) for s in sets] + [None] * more, pa.int64()),
                    pa.array(names + shingles[many].view(np.int64).tolist(), pa.int64()),
                    pa.array([None] * len(sets) + n[many].tolist(), pa.int64()),
                ],
                ["doc_id", "n", "name", "times"],
            )

    kind = docs.select("doc_id").schema.add("n", "long").add("name", "long").add("times", "long")
    return docs.select("doc_id", "text").mapInArrow(describe, kind)


def common_shingles(rows: DataFrame) -> np.ndarray:
    """Shingles of very many sets, at most BROADCAST_SHINGLES; the threshold rises until they are."""
    counts = kept(rows.where("times IS NOT NULL").groupBy(F.col("name").alias("shingle")).agg(F.sum("times").alias("times")).where(F.col("times") >= COMMON), "common-shingles")
    least = COMMON
    while counts.where(F.col("times") >= least).count() > BROADCAST_SHINGLES:
        least *= 2
    return np.sort(counts.where(F.col("times") >= least).toArrow().column("shingle").to_numpy().view(np.uint64))


def each_set(docs: DataFrame, words: int, kind: str, columns: list[str], made, given=None) -> DataFrame:
    """One row per set of each task's texts: ``made(names, sets, given)`` gives the columns."""
    sent = None if given is None else send(docs.sparkSession, given)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = Hasher(lower=True), set()
        given = None if sent is None else received(sent)
        for batch in slices(batches):
            names, sets = [], []
            for s in sets_of(hasher, *bytes_of(batch.column("text")), words):
                if len(s) and (name := name_of(s)) not in seen:
                    seen.add(name)
                    names.append(name)
                    sets.append(s)
            if len(seen) > SEEN:
                seen.clear()
            if names:
                yield pa.record_batch(made(names, sets, given), columns)

    return docs.select("text").mapInArrow(rows, kind)


def member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def prefix(shingles: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles, common ones last, of which a similar set must share one."""
    late = member(shingles, common)
    length = len(shingles) - -(-percent * len(shingles) // 100) + 1
    return np.concatenate([shingles[~late], shingles[late]])[:length]


def bitmap(shingles: np.ndarray) -> bytes:
    bits = np.bincount((shingles & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(bits.astype(bool)).tobytes()


def keyed(docs: DataFrame, common: np.ndarray, options: Options) -> DataFrame:
    percent = options.percent

    def made(names, sets, common):
        keys = [prefix(s, common, percent) for s in sets]
        return [
            pa.array(names, pa.int64()),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([bitmap(s) for s in sets], pa.binary()),
            pa.array([fine(s) for s in sets], pa.binary()),
            pa.array([fine(s, 1) if len(s) > BITS else b"" for s in sets], pa.binary()),
            lists(np.concatenate(keys).view(np.int64), np.array([len(k) for k in keys]), pa.int64()),
        ]

    return each_set(docs, options.words, "name long, n long, bits binary, fine binary, wide binary, keys array<long>", ["name", "n", "bits", "fine", "wide", "keys"], made, common)


def shingles_of(docs: DataFrame, wanted: DataFrame, options: Options) -> DataFrame:
    """``(name, shingles)`` of the wanted sets. A bitmap of bounded size first keeps others from being moved."""
    place = F.pmod(F.col("name"), F.lit(FILTER_WORDS * 64))
    words = wanted.select(F.floor(place / 64).alias("word"), F.expr("shiftleft(1L, CAST(pmod(name, 64) AS int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(FILTER_WORDS, np.uint64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)

    def made(names, sets, table):
        at = np.array(names, np.int64) % (FILTER_WORDS * 64)
        likely = np.flatnonzero(table[at // 64] >> (at % 64).astype(np.uint64) & np.uint64(1)).tolist()
        return [pa.array([names[i] for i in likely], pa.int64()), pa.array([sets[i].tobytes() for i in likely], pa.binary())]

    rows = each_set(docs, options.words, "name long, shingles binary", ["name", "shingles"], made, table)
    return rows.join(wanted, "name", "left_semi").groupBy("name").agg(F.min("shingles").alias("shingles"))


def early(percent: int) -> Column:
    """Whether a set of ``n`` shingles can be the smaller one of a pair whose first shared key has this ``rank`` in it.

    Before that key the two share nothing, so what follows it bounds their overlap. The smaller one of every
    similar pair is early at the pair's first shared key.
    """
    return (100 + percent) * (F.col("n") - F.col("rank")) >= 2 * percent * F.col("n")


def size_band(percent: int) -> Column:
    return F.floor(F.ln(F.col("n")) / math.log(100 / (percent - 1)))


def tiles(rows: DataFrame, percent: int) -> DataFrame:
    """Rows ``(key, rank, m, name, n, ...)`` to their tiles: that of their own size band, and early ones as guests that of the next.

    Where rows say by a bit each which bands their key has (``held``, bands modulo 64), nobody is a guest of none.
    """
    band, guests = size_band(percent), early(percent)
    if "held" in rows.columns:
        guests &= F.getbit("held", F.pmod(band + 1, F.lit(64)).cast("int")) == 1
    cut = F.pmod(F.xxhash64("name"), F.greatest(F.lit(1), F.ceil(F.col("m") / TILE)))
    home, guest = F.struct(band.alias("band"), F.lit(True).alias("home")), F.struct((band + 1).alias("band"), F.lit(False).alias("home"))
    place = F.explode(F.when(guests, F.array(home, guest)).otherwise(F.array(home)))
    return rows.withColumn("cut", cut).withColumn("place", place).select("*", "place.band", "place.home").drop("place")


def changes(batch: pa.RecordBatch, columns: tuple[str, ...]) -> np.ndarray:
    """Where a row differs from the one before it in any of the columns."""
    change = np.zeros(max(batch.num_rows - 1, 0), bool)
    for c in columns:
        values = batch.column(c).to_numpy(zero_copy_only=False)
        change |= values[1:] != values[:-1]
    return change


def whole_runs(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """The rows, sorted by ``columns``, in batches that never part rows equal in them."""
    left = None
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = pa.Table.from_batches([batch] if left is None else [left, batch]).combine_chunks().to_batches()[0]
        edges = np.flatnonzero(changes(batch, columns))
        cut = int(edges[-1]) + 1 if len(edges) else 0
        if cut:
            yield batch.slice(0, cut)
        left = batch.slice(cut)
    if left is not None and left.num_rows:
        yield left


def runs(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Groups of rows, sorted by ``columns``, as one batch each."""
    for batch in whole_runs(batches, columns):
        edges = [0, *(np.flatnonzero(changes(batch, columns)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            yield batch.slice(a, b - a)


def most_shared(n: int | np.ndarray, bits: np.ndarray, sizes: np.ndarray, signatures: np.ndarray) -> np.ndarray:
    """Bounds from above on the overlaps of sets of n and of ``sizes`` shingles, by sizes and bitmaps."""
    most = (n + sizes - np.bitwise_count(signatures ^ bits).sum(1, dtype=np.int64)) // 2
    return np.minimum(most, np.minimum(n, sizes))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays."""
    if len(a) > len(b):
        a, b = b, a
    return int(member(a, b).sum())


def open_pairs(rows: DataFrame, percent: int, few: bool) -> DataFrame:
    """Pairs across components, within tiles, that sizes and bitmaps allow. Every row meets all cuts of its tile.

    With ``few`` a row is paired with two others only: the first one before it, and the one with the
    highest bound on their similarity. That connects most of a group by a few pairs a member.
    Otherwise rows have the key's ``rank`` in the order of their shingles, and a ``wide`` bitmap where
    the short one says little: before their first shared key two sets share nothing, so what follows
    it bounds their overlap (a pair that this bound excludes at a later key is held to its first one),
    and the wide bitmaps must allow it too. What many unlike sets share then makes hardly any pairs.
    """
    more = () if few else ("rank", "wide")

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in whole_runs(batches, ("tile",)):
            names, sizes, part = (block.column(c).to_numpy() for c in ("name", "n", "component"))
            left, right = (block.column(c).to_numpy(zero_copy_only=False) for c in ("left", "right"))
            signatures = np.frombuffer(b"".join(block.column("bits").to_pylist()), np.uint64).reshape(len(names), -1)
            tile = block.column("tile").to_numpy()
            rank, maps = (None, None) if few else (block.column("rank").to_numpy(), block.column("wide"))
            found, at, claimed = [], np.arange(len(names) - 1), np.zeros(len(names), bool)
            score, partner = np.zeros(len(names)), np.full(len(names), -1)
            for step in range(1, len(names)):
                at = at[at < len(names) - step]
                at = at[tile[at] == tile[at + step]]
                if not len(at):
                    break
                to = at + step
                met = (part[at] != part[to]) & (left[at] & right[to] | left[to] & right[at])
                i, j = at[met], to[met]
                fits = 100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j])
                i, j = i[fits], j[fits]
                most = most_shared(sizes[i], signatures[i], sizes[j], signatures[j])
                good = 100 * most >= percent * (sizes[i] + sizes[j] - most)
                i, j, most = i[good], j[good], most[good]
                if not few and len(i):
                    after = np.minimum(sizes[i] - rank[i], sizes[j] - rank[j])
                    near = (100 + percent) * after >= percent * (sizes[i] + sizes[j])
                    long = np.flatnonzero(near & (np.minimum(sizes[i], sizes[j]) > BITS))
                    near[long] = [may_match(maps[x].as_buffer(), maps[y].as_buffer(), int(sizes[x]), int(sizes[y]), percent) for x, y in zip(i[long].tolist(), j[long].tolist(), strict=True)]
                    i, j = i[near], j[near]
                if few:
                    rate = most / (sizes[i] + sizes[j])
                    for one, other in ((i, j), (j, i)):
                        better = rate > score[one]
                        score[one[better]], partner[one[better]] = rate[better], other[better]
                    new = claim(claimed, j)
                    i, j = i[new], j[new]
                found.append(np.stack([tile[i], np.minimum(names[i], names[j]), np.maximum(names[i], names[j])]))
            one = np.flatnonzero(partner >= 0)
            other = partner[one]
            found.append(np.stack([tile[one], np.minimum(names[one], names[other]), np.maximum(names[one], names[other])]))
            if found and (pairs := np.unique(np.concatenate(found, axis=1), axis=1)).size:
                yield pa.record_batch([pa.array(x) for x in pairs], ["tile", "a", "b"])

    cuts = F.greatest(F.lit(1), F.ceil(F.col("m") / TILE))
    every = F.sequence(F.lit(0), cuts - 1)
    ways = F.concat(
        F.when(F.col("home"), F.transform(every, lambda k: F.struct(F.col("cut").cast("long").alias("cut"), k.cast("long").alias("other"), F.lit(True).alias("left"), (k == F.col("cut")).alias("right")))).otherwise(F.array()),
        F.transform(every, lambda k: F.struct(k.cast("long").alias("cut"), F.col("cut").cast("long").alias("other"), F.lit(False).alias("left"), F.lit(True).alias("right"))),
    )
    once = F.filter(ways, lambda w: ~(F.col("home") & ~w["left"] & (w["cut"] == w["other"])))
    spread = rows.withColumn("way", F.explode(once)).select("key", "band", "way.*", "name", "n", "bits", "component", *more)
    spread = spread.withColumn("tile", F.xxhash64("key", "band", "cut", "other")).drop("key", "band", "cut", "other")
    placed = spread.repartition("tile").sortWithinPartitions("tile", "name")
    return placed.mapInArrow(paired, "tile long, a long, b long").groupBy("a", "b").agg(F.min("tile").alias("tile"))


def claim(claimed: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which of the rows are new; they are noted."""
    new = ~claimed[rows]
    claimed[rows] = True
    return new


def fine(shingles: np.ndarray, bits: int = 4) -> bytes:
    """A bitmap of so many bits a shingle or more, a power of two of them."""
    size = max(256, 1 << (bits * len(shingles) - 1).bit_length())
    bits = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(bool)).tobytes()


def may_match(x, y, n: int, m: int, percent: int) -> bool:
    """The bound on the overlap by fine bitmaps; a longer one is folded to the length of the other."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if len(a) < len(b):
        a, b = b, a
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    most = min(n, m, (n + m - int(np.bitwise_count(a ^ b).sum())) // 2)
    return 100 * most >= percent * (n + m - most)


def match(x: bytes, y: bytes, n: int, m: int, percent: int) -> bool:
    both = overlap(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
    return 100 * both >= percent * (n + m - both)


def by_tile(pairs: DataFrame, values: DataFrame, test, percent: int, connect: bool) -> DataFrame:
    """The pairs ``(tile, a, b)`` that pass a test of both sides' ``values(name, n, value)``.

    A value is brought once to each tile that has pairs of it. With ``connect`` pairs that earlier
    ones of their tile connect are passed over.
    """

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in runs(batches, ("tile",)):
            number, a, b, n = (tile.column(c).to_numpy() for c in ("tile", "a", "b", "n"))
            value = tile.column("value")
            known, part, good = {}, {}, []

            def root(x, part=part):
                while part.setdefault(x, x) != x:
                    part[x] = x = part[part[x]]
                return x

            for i in range(tile.num_rows):
                if value[i].is_valid:
                    known[int(a[i])] = value[i].as_buffer(), int(n[i])
                    continue
                x, y = int(a[i]), int(b[i])
                if connect and root(x) == root(y):
                    continue
                (one, size), (two, other) = known[x], known[y]
                if test(one, two, size, other, percent):
                    part[root(x)] = root(y)
                    good.append((number[i], x, y))
            if good:
                yield pa.record_batch([pa.array(v, pa.int64()) for v in zip(*good, strict=True)], ["tile", "a", "b"])

    ends = pairs.select("tile", F.col("a").alias("name")).unionByName(pairs.select("tile", F.col("b").alias("name"))).distinct()
    members = ends.join(values, "name").select("tile", F.col("name").alias("a"), F.lit(0).cast("long").alias("b"), "n", "value", F.lit(0).alias("turn"))
    rows = members.unionByName(pairs.select("tile", "a", "b", F.lit(0).cast("long").alias("n"), F.lit(None).cast("binary").alias("value"), F.lit(1).alias("turn")))
    placed = rows.repartition("tile").sortWithinPartitions("tile", "turn").select("tile", "a", "b", "n", "value")
    return placed.mapInArrow(compared, "tile long, a long, b long")


def classes_of(docs: DataFrame, options: Options) -> tuple[DataFrame, DataFrame]:
    """``described`` documents, and the smallest document ``(name, component_id)`` reachable from each class by links."""
    rows = kept(described(docs, options.words), "shingle-sets")
    classes = kept(keyed(docs, common_shingles(rows), options), "set-keys")
    keys = classes.select(F.posexplode("keys").alias("rank", "key"), "name", "n").withColumns({"early": early(options.percent), "band": size_band(options.percent).cast("int")}).drop("n")
    shared = kept(keys.groupBy("key").agg(F.min("name").alias("low"), F.max("name").alias("high"), F.count("*").alias("m"), F.max("early").alias("early")).where("low <> high AND early").select("key", "m"), "shared-keys")
    open_keys = kept(keys.join(shared, "key").distinct(), "open-keys")

    def links_of(rows: DataFrame, few: bool) -> DataFrame:
        # Stored, as it is read twice and which pair comes first must not change between the reads.
        pairs = kept(open_pairs(tiles(rows, options.percent), options.percent, few), "likely-pairs")
        pairs = kept(by_tile(pairs, classes.select("name", "n", F.col("fine").alias("value")).dropDuplicates(["name"]), may_match, options.percent, False), "set-pairs")
        wanted = pairs.select(F.col("a").alias("name")).unionByName(pairs.select(F.col("b").alias("name"))).distinct()
        sets = shingles_of(docs, wanted, options).select("name", F.octet_length("shingles").cast("long").alias("bytes"), F.col("shingles").alias("value"))
        sets = sets.withColumn("n", F.expr("bytes div 8")).drop("bytes")
        return kept(by_tile(pairs, sets, match, options.percent, True).select("a", "b"), "set-links")

    facts = classes.select("name", "n", "bits").dropDuplicates(["name"])
    # A class has no more keys than its text has shingles, so they may meet in one row.
    first = F.slice(F.sort_array(F.collect_list(F.struct("key", "m", "rank"))), 1, options.first_keys)
    start = open_keys.groupBy("name").agg(first.alias("first")).select("name", F.inline("first")).join(facts, "name")
    links = links_of(start.withColumn("component", F.col("name")), True)
    parts = components(links, "first-parts")

    part: Column = F.coalesce("component", "name")
    placed = kept(open_keys.join(parts.withColumnRenamed("node", "name"), "name", "left").withColumn("component", part), "placed-keys")
    held = F.expr("bit_or(shiftleft(1L, CAST(pmod(band, 64) AS int)))").alias("held")
    mixed_keys = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max("early").alias("early"), held).where("low <> high AND early").select("key", "held")
    rest = placed.drop("early", "band").join(mixed_keys, "key").join(classes.select("name", "n", "bits", "wide").dropDuplicates(["name"]), "name")
    ends = components(links.unionByName(links_of(rest, False)), "parts")

    known = rows.where("n IS NOT NULL")
    firsts = known.where("n > 0").groupBy("name").agg(F.min("doc_id").alias("first"))
    grouped = kept(firsts.join(ends.withColumnRenamed("node", "name"), "name", "left").withColumn("component", part), "classes")
    least = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    return rows, kept(grouped.join(least, "component").select("name", "component_id", "component"), "class-components")


def join(docs: DataFrame, options: Options = Options()) -> DataFrame:  # noqa: B008
    """``docs(doc_id, text)`` to ``(doc_id, n_shingles, component_id)``: the smallest document reachable by links."""
    rows, by_name = classes_of(docs, options)
    known = rows.where("n IS NOT NULL")
    empty = known.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    full = known.where("n > 0").join(by_name, "name").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.unionByName(empty)


def with_links(docs: DataFrame, options: Options = Options()) -> DataFrame:  # noqa: B008
    """What ``join`` gives, and ``n_links``: how many other rows are linked with a document, copies included.

    Linked sets are in one component, so only its sets are compared, each pair once.
    """
    rows, by_name = classes_of(docs, options)
    known, percent = rows.where("n IS NOT NULL"), options.percent
    times = known.where("n > 0").groupBy("name").agg(F.count("*").alias("times"))
    classes = kept(by_name.join(times, "name"), "class-times")
    many = classes.groupBy("component").agg(F.count("*").alias("m")).where("m > 1")
    open_classes = kept(classes.join(many, "component").select("component", "m", "name", "times"), "open-classes")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in runs(batches, ("component", "low", "high")):
            names, other, cut, low, high = (tile.column(c).to_numpy() for c in ("name", "times", "cut", "low", "high"))
            sets = [np.frombuffer(x, np.uint64) for x in tile.column("shingles").to_pylist()]
            sizes = np.array([len(x) for x in sets], np.int64)
            signatures = np.frombuffer(b"".join(bitmap(x) for x in sets), np.uint64).reshape(len(sets), -1)
            linked = np.zeros(len(sets), np.int64)
            for i in range(len(sets)):
                most = most_shared(sizes[i], signatures[i], sizes[i + 1 :], signatures[i + 1 :])
                good = 100 * most >= percent * (sizes[i] + sizes[i + 1 :] - most)
                if low[0] != high[0]:
                    good &= cut[i + 1 :] != cut[i]
                for j in (np.flatnonzero(good) + i + 1).tolist():
                    both = overlap(sets[i], sets[j])
                    if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                        linked[i] += other[j]
                        linked[j] += other[i]
            yield pa.record_batch([pa.array(names), pa.array(linked)], ["name", "linked"])

    cuts = F.ceil(F.col("m") / TILE)
    placed = (
        open_classes.join(shingles_of(docs, open_classes.select("name"), options), "name")
        .withColumn("cut", F.pmod(F.xxhash64("name"), cuts))
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), cuts - 1)))
        .select("component", F.least("cut", "with").alias("low"), F.greatest("cut", "with").alias("high"), "cut", "name", "times", "shingles")
        .repartition("component", "low", "high")
        .sortWithinPartitions("component", "low", "high")
    )
    sums = placed.mapInArrow(counted, "name long, linked long").groupBy("name").agg(F.sum("linked").alias("linked"))
    by_class = classes.join(sums, "name", "left").select("name", "component_id", (F.col("times") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    empty = known.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    full = known.where("n > 0").join(by_class, "name").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links")
    return full.unionByName(empty)


def one_of_each(docs: DataFrame, options: Options = Options()) -> DataFrame:  # noqa: B008
    """All columns of one document of each component: the one with the smallest id; rows that repeat
    id and text stay once. Rows without an id are in no component and stay."""
    first = join(docs, options).where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where("doc_id IS NULL"))
