"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents become token ids and an end id; longer ones are cut into whole sequences and a shorter
first piece. Pieces that fill a sequence are one. The others are dealt by a hash into blocks of
about BLOCK, and every block lives on several islands, each with a population of its own. A
solution assigns pieces to bins. A child takes whole well-filled bins of one parent into a copy of
the other, gives up that one's bins that hold a piece twice, and puts the displaced pieces, longest
first, where they leave the least room; now and then its emptiest bins are emptied and dealt
again. After an epoch the best solution of each island moves on to the next one. A block is done
as soon as a solution meets the lower bound, which most do at once when there are short pieces.

The emptiest bins of all blocks are then opened again, their pieces dealt into new blocks and
packed in the same way, until one block holds them; the result is taken where it needs fewer bins.
No task holds more than a few blocks, nothing but counts reaches the driver, and blocks and
populations are tables in the shared folder.

Defined cases: a null text is empty; an empty text is the end id alone; repeated rows and null ids
are documents of their own; an empty table gives no rows. Any string is ordinary text, also those
of special tokens. Lengths run from 1 to the size of a sequence.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill.llm.ngram_join import runs
from docmill.llm.shared import kept, received, send
from docmill.llm.textops import slices

END, LENGTH = 2, 1024


@dataclass(frozen=True)
class Options:
    #: Pieces of a block, aimed at.
    block: int = 8192
    islands: int = 3
    population: int = 4
    epochs: int = 2
    generations: int = 6
    #: Bins filled less than this are opened again, at most one in OPENED of a block.
    well_filled: float = 0.97


OPENED = 16
#: Displaced pieces, the longest, that may take the place of a shorter one.
EXCHANGED = 256


class Encoder:
    """Texts to ids by a file of the tokenizers library.

    Plain byte-level BPE goes through tiktoken, which gives the same ids several times as fast (held
    against the library on every code point); other files, and texts whose runs of blanks are too
    long for it, go through the library itself.
    """

    def __init__(self, file: str, pattern: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_str(file)
        self.slow.encode_special_tokens = True
        self.fast = None
        ranks = plain_ranks(json.loads(file))
        if ranks:
            import tiktoken

            self.fast = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast:
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except ValueError:
                pass
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def plain_ranks(file: dict) -> dict[bytes, int] | None:
    """Bytes of every token and its rank, if the file is byte-level BPE that merges in the order of ids and no more."""
    model, before = file["model"], file["pre_tokenizer"] or {}
    wanted = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if file["normalizer"] or any(before.get(k) != v for k, v in wanted.items()) or model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    ids = [model["vocab"].get(a + b) for a, b in merges]
    if len(ids) + 256 != len(model["vocab"]) or None in ids or ids != sorted(set(ids)) or ids[0] < 256 or not set("".join(model["vocab"])) <= set(byte_of):
        return None
    return {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items()}


def pieces(docs: DataFrame, path: str, pattern: str, end: int = END, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` to ``(item, doc_id, piece, start, length, ids_crc32)``, and the ids if wanted; stored."""
    with open(path, encoding="utf-8") as file:  # a vocabulary, read on the driver
        sent = send(docs.sparkSession, (file.read(), pattern))
    kind = docs.select("doc_id").schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    if with_ids:
        kind = kind.add("ids", "binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ready(sent)
        for batch in slices(batches):
            at, rows = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(encode(text or ""), [end]).astype("<u4")
                borders = [0, *range((len(ids) - 1) % length + 1, len(ids) + 1, length)]
                for n, (a, b) in enumerate(zip(borders, borders[1:], strict=False)):
                    held = ids[a:b].tobytes()
                    at.append(i)
                    rows.append((n, a, b - a, zlib.crc32(held), held))
            columns = list(zip(*rows, strict=True))
            made = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=False)]
            if with_ids:
                made.append(pa.array(columns[4], pa.binary()))
            yield pa.record_batch([batch.column("doc_id").take(pa.array(at)), *made], kind.names)

    return kept(docs.select("doc_id", "text").mapInArrow(cut, kind).select(F.monotonically_increasing_id().alias("item"), "*"), "pieces")


def ready(sent) -> Encoder:
    """The encoder of a worker."""
    box = sent.value
    if "encoder" not in box:
        box["encoder"] = Encoder(*received(sent))
    return box["encoder"]


class Room:
    """Open bins by the room left in them; the bits of a number say which rooms there are."""

    def __init__(self, free: list[int], size: int):
        self.free, self.size = free, size
        self.having: list[list[int]] = [[] for _ in range(size + 1)]
        self.rooms = 0
        for i, room in enumerate(free):
            self.having[room].append(i)
            self.rooms |= 1 << room

    def put(self, length: int) -> int:
        """The bin that is left with the least room; a new one if none has enough."""
        rooms = self.rooms >> length
        if rooms:
            room = length + (rooms & -rooms).bit_length() - 1
            held = self.having[room]
            i = held.pop()
            if not held:
                self.rooms &= ~(1 << room)
        else:
            room, i = self.size, len(self.free)
            self.free.append(room)
        left = self.free[i] = room - length
        self.having[left].append(i)
        self.rooms |= 1 << left
        return i


def best_fit(lengths: np.ndarray, bins: np.ndarray, order: np.ndarray, size: int) -> np.ndarray:
    """Put the pieces of ``order``, whose bin is -1, into the bins of the others or new ones."""
    placed = bins >= 0
    n = int(bins.max(initial=-1)) + 1
    room = Room((size - np.bincount(bins[placed], lengths[placed], n).astype(np.int64)).tolist(), size)
    out = bins.copy()
    out[order] = [room.put(x) for x in lengths[order].tolist()]
    return out


def numbered(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1]


def fitness(lengths: np.ndarray, bins: np.ndarray) -> tuple[int, float]:
    """Fewer bins first, then the unevenness of their fill; the least is the best."""
    fill = np.bincount(bins, lengths)
    return len(fill), -float((fill**2).sum())


def fewest(lengths: np.ndarray, size: int) -> int:
    """A lower bound: pieces too long to share a bin, and the rest in the room that is left."""
    number = np.bincount(lengths, minlength=size + 1)
    total = number * np.arange(size + 1)
    above, sums = np.append(np.cumsum(number[::-1])[::-1], 0), np.append(np.cumsum(total[::-1])[::-1], 0)
    short = np.arange(size // 2 + 1)
    half = size // 2 + 1
    alone = above[size - short + 1]
    middle = above[half] - above[np.maximum(size - short + 1, half)]
    room = middle * size - (sums[half] - sums[np.maximum(size - short + 1, half)])
    rest = sums[short] - sums[half]
    return int((alone + middle + np.maximum(0, -(-(rest - room) // size))).max(initial=0))


def crossed(lengths: np.ndarray, one: np.ndarray, other: np.ndarray, size: int, random: np.random.Generator) -> np.ndarray:
    """Whole well-filled bins of ``other`` in ``one``; displaced pieces go where they fit best."""
    fill = np.bincount(other, lengths)
    chosen = random.random(len(fill)) < 0.5 * (fill / size) ** 8
    injected = chosen[other]
    broken = np.zeros(one.max() + 1, bool)
    broken[one[injected]] = True
    out = np.where(broken[one], -1, one)
    out[injected] = other[injected] + one.max() + 1
    return refilled(lengths, out, size)


def mutated(lengths: np.ndarray, bins: np.ndarray, size: int, random: np.random.Generator) -> np.ndarray:
    """The emptiest bins, and a few others, emptied and dealt again."""
    fill = np.bincount(bins, lengths)
    gone = random.random(len(fill)) < 0.02
    gone[np.argsort(fill, kind="stable")[: max(1, len(fill) // 50)]] = True
    return refilled(lengths, np.where(gone[bins], -1, bins), size)


def refilled(lengths: np.ndarray, bins: np.ndarray, size: int) -> np.ndarray:
    """Displaced pieces, whose bin is -1, back in bins: first for shorter ones that leave more room there, then by best fit."""
    held = bins >= 0
    out = bins.copy()
    out[held] = numbered(bins[held])
    free = np.flatnonzero(~held)
    free = free[np.argsort(-lengths[free], kind="stable")]
    if held.any():
        room = size - np.bincount(out[held], lengths[held]).astype(np.int64)
        for i, piece in enumerate(free[:EXCHANGED].tolist()):
            longer = lengths[piece] - lengths
            left = np.where((out >= 0) & (longer > 0), room[out] - longer, -1)
            left[left < 0] = size
            at = int(left.argmin())
            if left[at] < size:
                out[piece], out[at], free[i] = out[at], -1, at
                room[out[piece]] = left[at]
    return best_fit(lengths, out, free[np.argsort(-lengths[free], kind="stable")], size)


def first_population(lengths: np.ndarray, size: int, n: int, random: np.random.Generator) -> list[np.ndarray]:
    """Best fit, longest first, then in orders that are more and more shuffled."""
    empty = np.full(len(lengths), -1)
    orders = [np.argsort(-lengths * (1 + random.random(len(lengths)) * 0.2 * i), kind="stable") for i in range(n)]
    return [best_fit(lengths, empty, order, size) for order in orders]


def evolved(lengths: np.ndarray, population: list[np.ndarray], size: int, generations: int, random: np.random.Generator) -> list[np.ndarray]:
    """The population after some generations, best first; a solution that meets the bound ends it."""
    bound = fewest(lengths, size)
    rated = sorted(((fitness(lengths, b), i, b) for i, b in enumerate(population)), key=lambda x: x[:2])
    for _ in range(generations):
        if rated[0][0][0] <= bound:
            break
        i, j = random.permutation(len(rated))[:2] if len(rated) > 1 else (0, 0)
        a, b = rated[min(i, j)][2], rated[max(i, j)][2]
        for child in (crossed(lengths, a, b, size, random), crossed(lengths, b, a, size, random), mutated(lengths, rated[0][2], size, random)):
            value = fitness(lengths, child)
            if value < rated[-1][0] and all(value != r[0] for r in rated):
                rated[-1] = (value, rated[-1][1], child)
                rated.sort(key=lambda x: x[:2])
    return [b for _, _, b in rated]


def blocks_of(rows: DataFrame, n: int, options: Options, level: int) -> DataFrame:
    """``rows(item, length, ...)`` in about n / block stored rows: the pieces of a block as lists, longest first."""
    number = max(1, -(-n // options.block))
    block = F.pmod(F.xxhash64("item", F.lit(level)), F.lit(number)).alias("block")
    placed = rows.select(block, "*").repartition(min(number, 1 << 16), "block").sortWithinPartitions("block", F.desc("length"), "item")
    schema = T.StructType([T.StructField("block", T.LongType())] + [T.StructField(f.name, T.ArrayType(f.dataType)) for f in rows.schema])

    def collected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ("block",)):
            lists = [pa.ListArray.from_arrays(pa.array([0, run.num_rows], pa.int32()), run.column(c)) for c in run.schema.names[1:]]
            yield pa.record_batch([run.column("block").slice(0, 1), *lists], run.schema.names)

    return kept(placed.mapInArrow(collected, schema), "blocks")


STATE = "block long, island int, lengths binary, population array<binary>, bins int, done boolean"


def epoch(state: DataFrame, number: int, size: int, options: Options, level: int) -> DataFrame:
    """Evolve every island that may still improve; ``guest`` is the best solution of its neighbour."""

    def evolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
                random = np.random.default_rng([level, number, row["block"], row["island"]])
                population = [np.frombuffer(p, "<i4").astype(np.int64) for p in row["population"] or []]
                if not population:
                    population = first_population(lengths, size, options.population, random)
                if row["guest"] is not None:
                    population[-1] = np.frombuffer(row["guest"], "<i4").astype(np.int64)
                population = evolved(lengths, population, size, options.generations, random)
                bins = int(population[0].max()) + 1
                out = {k: row[k] for k in ("block", "island", "lengths")} | {"population": [p.astype("<i4").tobytes() for p in population], "bins": bins, "done": bins <= fewest(lengths, size)}
                yield pa.RecordBatch.from_pylist([out], schema=arrow)

    arrow = pa.schema([("block", pa.int64()), ("island", pa.int32()), ("lengths", pa.binary()), ("population", pa.list_(pa.binary())), ("bins", pa.int32()), ("done", pa.bool_())])
    return state.mapInArrow(evolve, STATE)


def solutions(blocks: DataFrame, size: int, options: Options, level: int) -> DataFrame:
    """``(block, best)``: the bins of the pieces of every block, by epochs and migrations; stored."""

    def lengths_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.array(x.values, "<i4").tobytes() for x in batch.column("length")]
            yield pa.record_batch([batch.column("block"), pa.array(held, pa.binary())], ["block", "lengths"])

    none = F.lit(None)
    first = blocks.select("block", "length").mapInArrow(lengths_only, "block long, lengths binary")
    settled = first.select("block", F.lit(0).alias("island"), "lengths", none.cast("array<binary>").alias("population"), none.cast("binary").alias("guest"))
    state = kept(epoch(settled, 0, size, options, level), "islands")
    for number in range(1, options.epochs + 1):
        open_ = state.where(~F.col("done"))
        if number == 1:
            islands = open_.select("block", F.explode(F.sequence(F.lit(0), F.lit(options.islands - 1))).alias("island"), "lengths", F.lit(None).cast("array<binary>").alias("population"), F.col("population")[0].alias("guest"))
        else:
            guests = open_.select("block", F.pmod(F.col("island") + 1, F.lit(options.islands)).alias("island"), F.col("population")[0].alias("guest"))
            met = open_.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") == options.islands).select("block")
            islands = open_.join(met, "block").join(guests, ["block", "island"]).select("block", "island", "lengths", "population", "guest")
        spread = islands.repartition("block", "island")
        if number == 1:
            state = state.where("done").unionByName(epoch(spread, number, size, options, level))
        else:
            after = epoch(spread, number, size, options, level)
            moved = islands.select("block").distinct()
            state = state.join(moved, "block", "left_anti").unionByName(after)
        state = kept(state, "islands")
    rank = F.struct("bins", "island")
    best = state.groupBy("block").agg(F.min(rank).alias("rank"))
    won = state.join(best, "block").where(rank == F.col("rank"))
    return kept(won.select("block", "bins", F.col("population")[0].alias("best")), "packed-blocks")


def pack(rows: DataFrame, size: int = LENGTH, options: Options = Options(), level: int = 0, before: int = 0) -> DataFrame:  # noqa: B008
    """``rows(item, length, ...)``, items distinct and lengths up to ``size``, with ``sequence_id`` and ``offset``; ``before``: blocks of earlier levels."""
    full = rows.where(F.col("length") == size).select("*", (F.col("item") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = rows.where(F.col("length") < size)
    n = rest.count()
    if not n:
        return full
    blocks = blocks_of(rest, n, options, level)
    number = max(1, -(-n // options.block))
    found = solutions(blocks, size, options, level)
    names = list(rows.columns)
    arrow_names = [*names, "sequence_id", "offset", "room", "opened"]
    schema = T.StructType(list(rest.schema) + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("room", T.LongType()), T.StructField("opened", T.BooleanType())])
    last = number == 1

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                columns = [batch.column(c)[at].values for c in names]
                bins = np.frombuffer(batch.column("best")[at].as_buffer(), "<i4")
                lengths = np.array(columns[names.index("length")]).astype(np.int64)
                order = np.argsort(bins, kind="stable")
                starts = np.cumsum(lengths[order]) - lengths[order]
                firsts = np.flatnonzero(np.diff(bins[order], prepend=-1))
                offset = starts - np.repeat(starts[firsts], np.diff(np.append(firsts, len(order))))
                fill = np.bincount(bins, lengths).astype(np.int64)
                emptiest = np.argsort(fill, kind="stable")[: max(1, len(fill) // OPENED)]
                opened = np.zeros(len(fill), bool)
                opened[emptiest] = fill[emptiest] < options.well_filled * size
                block = batch.column("block")[at].as_py()
                ids = ((before + block << 32) + bins[order].astype(np.int64)) * 2 + 1
                made = [pa.array(ids), pa.array(offset), pa.array(size - fill[bins[order]]), pa.array(opened[bins[order]] & (not last))]
                yield pa.record_batch([*(c.take(pa.array(order)) for c in columns), *made], arrow_names)

    done = kept(blocks.join(found.select("block", "best"), "block").mapInArrow(placed, schema), "packed")
    result = [*names, "sequence_id", "offset"]
    if last:
        return full.unionByName(done.select(result))
    opened = done.where("opened")
    bins = opened.where("offset = 0").count()
    room = opened.where("offset = 0").agg(F.sum("room")).first()[0] or 0
    if room < size:
        return full.unionByName(done.select(result))
    again = kept(pack(opened.select(names), size, options, level + 1, before + number), "packed-again")
    if again.where("offset = 0").count() >= bins:
        return full.unionByName(done.select(result))
    return full.unionByName(done.where("NOT opened").select(result)).unionByName(again)


def pack_documents(docs: DataFrame, path: str, pattern: str, end: int = END, length: int = LENGTH, options: Options = Options(), with_ids: bool = False) -> DataFrame:  # noqa: B008
    """``docs(doc_id, text)`` to one row per piece with its sequence and place in it."""
    cut = pieces(docs, path, pattern, end, length, with_ids)
    if not with_ids:
        return pack(cut, length, options).drop("item")
    placed = pack(cut.select("item", "length"), length, options).drop("length")
    return cut.join(placed, "item").drop("item")
