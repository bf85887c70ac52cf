"""A log-bilinear language model trained by noise-contrastive estimation, and its text scores.

Every text is a sequence of lower-cased (A-Z) words and one end. Frequent words are symbols of
their own; all others share symbols by their last two bytes. The neural part predicts a symbol
from the two before it: context vectors are mapped by one matrix per position, added, and
multiplied with target vectors. Within a rare symbol every training word, however many there are,
is a leaf of a binary tree. Each node has a vector and a bias, which starts at the word counts of
its two sides, and is trained on the same contexts; its logistic unit chooses a side. The share of
words seen once is set aside for unknown words, so the probabilities of all words and the end sum
to one after every context. As a context a rare word is still known by its symbol only.

Training runs over all training tokens: each task makes stochastic gradient steps over its
rows, and parameters are averaged over tasks after each round, weighted by tokens. A symbol has
so few contexts that the normaliser of every one is computed up front, in batched matrix
products; scoring a token is then three table look-ups. The trees grow with the corpus and are
never in one place: the tokens of a rare symbol meet the words of its tree in one task, or in
several by row if they are many, whose trees are then averaged by node.

Defined cases: null texts are empty and score the end alone; repeated rows are scored each; an
empty table gives no rows; without training texts every word is unknown. Columns other than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.ngram_join import runs
from docmill.llm.shared import kept, received, remainder, send
from docmill.llm.textops import MIX_A, Hasher, bytes_of, counts_of, lists, mixed, slices

WORDS, BUCKETS = 1151, 384
END = WORDS + BUCKETS
SYMBOLS = END + 1
BUCKET_BITS = 9
END_KEY = np.uint64((1 << 64) - 1)
#: Counts of at most so many frequent words are sent to all executors; the others are joined.
BROADCAST_WORDS = 1 << 18
#: Distinct words that a task counts before it hands them on.
COUNTED = 1 << 20
CHUNK = 4096
#: Tokens of a rare symbol that one task trains on; with more of them its tree is trained in several.
PART_TOKENS = 1 << 22
NOTHING = 1e-30
#: Levels of a tree whose scores are matrix products, one for each node above so many leaves on average, or more.
BAND, BAND_LEAVES = 6, 16
#: Leaves whose gains are worked out at a time.
GAINS = 4096


@dataclass(frozen=True)
class Options:
    size: int = 24
    noise: int = 48
    batch: int = 1024
    rates: tuple[float, ...] = (0.15, 0.08, 0.04)
    held_out_of: int = 10
    tree_rate: float = 0.1
    tree_batch: int = 4096
    tree_rounds: int = 1


class Keys(Hasher):
    """Lower-cased words to keys, whose low bits are their bucket."""

    def __init__(self):
        super().__init__(lower=True)
        #: The bucket of every two last bytes.
        self.buckets = (mixed(self.values[:, None] * MIX_A + self.values) % np.uint64(BUCKETS)).ravel()


def keys_of(hasher: Keys, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key per word, whose low bits are its bucket, and the words of each document."""
    starts, ends, hashes = hasher.words(data, offsets)
    if not len(starts):
        return hashes, np.diff(offsets) * 0
    last, before = data[ends - 1], data[np.maximum(ends - 2, starts)]
    bucket = hasher.buckets.take(last.astype(np.int64) << 8 | before)
    return hashes >> np.uint64(BUCKET_BITS) << np.uint64(BUCKET_BITS) | bucket, counts_of(starts, offsets)


def bucket_of(keys: np.ndarray) -> np.ndarray:
    return (keys & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64)


class Lookup:
    """Positions of 64-bit keys in a table, -1 for others; most are found in one step."""

    BITS = 21

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.slots = np.full(1 << self.BITS, -1, np.int32)
        self.slots[self.home(keys)] = np.arange(len(keys), dtype=np.int32)
        lost = np.flatnonzero(self.slots[self.home(keys)] != np.arange(len(keys)))
        order = np.argsort(keys[lost])
        self.others, self.at = keys[lost][order], lost[order]

    def home(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.BITS)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        found = self.slots[self.home(keys)].astype(np.int64)
        missed = np.flatnonzero((found < 0) | (self.keys[found] != keys))
        found[missed] = -1
        if len(self.others) and len(missed):
            at = np.minimum(np.searchsorted(self.others, keys[missed]), len(self.others) - 1)
            hit = self.others[at] == keys[missed]
            found[missed[hit]] = self.at[at[hit]]
        return found


def word_counts(training: DataFrame) -> DataFrame:
    """Occurrences ``(word, n)`` of all words and of the end, by key; counted in tasks first."""

    def merged(parts):
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, parts, waiting = Keys(), [], 0

        def handed(keys, n):
            for i in range(0, len(keys), 1 << 16):
                yield pa.record_batch([pa.array(keys[i : i + (1 << 16)].view(np.int64)), pa.array(n[i : i + (1 << 16)])], ["word", "n"])

        for batch in slices(batches):
            keys, _ = keys_of(hasher, *bytes_of(batch.column("text")))
            keys, n = np.unique(keys, return_counts=True)
            parts += [(keys, n), (np.array([END_KEY]), np.array([batch.num_rows]))]
            waiting += len(keys)
            if waiting > 2 * COUNTED:
                parts = [merged(parts)]
                waiting = len(parts[0][0])
                if waiting > COUNTED:
                    yield from handed(*parts[0])
                    parts, waiting = [], 0
        if parts:
            yield from handed(*merged(parts))

    return training.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """What every task knows of the words: bounded tables, whatever the corpus holds."""

    tokens: int
    types: int
    keys: np.ndarray
    counts: np.ndarray
    symbol_counts: np.ndarray
    bucket_tokens: np.ndarray
    bucket_once: np.ndarray
    limit: int

    def unknown_share(self) -> np.ndarray:
        return np.where(self.bucket_tokens > 0, (self.bucket_once + 0.5) / (self.bucket_tokens + 1.0), 1.0)

    def in_bucket(self, counts: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """log10 of the probability of rare words within their buckets."""
        share, total = self.unknown_share()[bucket], np.maximum(self.bucket_tokens[bucket], 1)
        return np.log10(np.where(counts > 0, (1 - share) * counts / total, share) + NOTHING)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.types + 1)))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals, and the counts of the most frequent words down to a threshold that bounds their number."""
    level = F.floor(F.log2("n") * 8).cast("int")
    levels = sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("types"), F.sum("n").alias("n"), F.min("n").alias("least")).collect(), reverse=True)
    taken, limit = 0, 1 << 62
    for row in levels:
        if taken + row.types > BROADCAST_WORDS:
            break
        taken, limit = taken + row.types, row.least
    top = counts.where(F.col("n") >= limit).toArrow() if taken else None
    keys = np.array([], np.int64) if top is None else top.column("word").to_numpy()
    n = np.array([], np.int64) if top is None else top.column("n").to_numpy()
    keys = keys.view(np.uint64)
    order = np.lexsort((keys, -n, keys != END_KEY))
    ends = int(n[order[0]]) if len(order) and keys[order[0]] == END_KEY else 0
    order = order[1:] if ends else order
    short = order[:WORDS]
    low = F.col("word").bitwiseAND((1 << BUCKET_BITS) - 1)
    symbol_counts = np.zeros(SYMBOLS)
    symbol_counts[: len(short)] = n[short]
    symbol_counts[END] = ends
    tokens, once = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counts.where(F.col("word") != -1).groupBy(low.alias("b")).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("once")).collect():
        tokens[row.b], once[row.b] = row.n, row.once
    np.subtract.at(tokens, bucket_of(keys[short]), n[short])
    np.subtract.at(once, bucket_of(keys[short]), n[short] == 1)
    symbol_counts[WORDS:END] = tokens
    return Vocabulary(sum(r.n for r in levels), sum(r.types for r in levels), keys[order], n[order], symbol_counts, tokens, once, limit)


ENCODED = "row long, doc_id string, held_out boolean, n_tokens long, n_known long, base double, rare double, symbols binary, picks binary, words array<long>"


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Symbols of every text, what frequent words add to the scores, and the other words by key.

    ``row`` numbers the rows; it is fixed once the table is written. ``picks`` names the word of each
    rare symbol of a text: its place among the frequent words, or -1 - its place in ``words``.
    """
    known = send(docs.sparkSession, vocab)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = received(known)
        hasher, lookup = Keys(), Lookup(vocab.keys)
        n = vocab.counts.astype(np.float64)
        base = vocab.base(n)
        rare = np.where(np.arange(len(n)) < WORDS, 0.0, vocab.in_bucket(n, bucket_of(vocab.keys)) if len(n) else 0.0)
        symbol = np.where(np.arange(len(n)) < WORDS, np.arange(len(n)), WORDS + bucket_of(vocab.keys)).astype(np.int16)
        end_base = float(vocab.base(np.array([vocab.symbol_counts[END]]))[0])
        end_known = int(vocab.symbol_counts[END] > 0)
        number = TaskContext.get().partitionId() << 36
        for batch in slices(batches):
            keys, per_doc = keys_of(hasher, *bytes_of(batch.column("text")))
            at, doc = lookup(keys), np.repeat(np.arange(len(per_doc)), per_doc)
            seen = at >= 0
            symbols = (WORDS + bucket_of(keys)).astype(np.int16)
            symbols[seen] = symbol[at[seen]]
            total = lambda values: np.bincount(doc[seen], values, len(per_doc))  # noqa: B023, E731
            cut = np.concatenate([[0], np.cumsum(per_doc)])
            others, owner = keys[~seen], doc[~seen]
            order = np.lexsort((others, owner))
            others, owner = others[order], owner[order]
            new = np.ones(len(others), bool)
            new[1:] = (others[1:] != others[:-1]) | (owner[1:] != owner[:-1])
            first = np.flatnonzero(new)
            each = np.bincount(owner[first], minlength=len(per_doc))
            picks = at.astype(np.int32)
            place = np.cumsum(new) - 1
            picks[np.flatnonzero(~seen)[order]] = -1 - (place - (np.cumsum(each) - each)[owner])
            rarely = symbols >= WORDS
            picks = picks[rarely]
            edge = np.concatenate([[0], np.cumsum(rarely)])[cut]
            yield pa.record_batch(
                [
                    pa.array(number + np.arange(len(per_doc))),
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(per_doc + 1),
                    pa.array(np.bincount(doc[seen], minlength=len(per_doc)) + end_known),
                    pa.array(total(base[at[seen]]) + end_base),
                    pa.array(total(rare[at[seen]])),
                    pa.array([symbols[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary()),
                    pa.array([picks[a:b].tobytes() for a, b in zip(edge, edge[1:], strict=False)], pa.binary()),
                    lists(others[first].view(np.int64), each, pa.int64()),
                ],
                ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "rare", "symbols", "picks", "words"],
            )
            number += len(per_doc)

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "held_out", "text").mapInArrow(encoded, ENCODED)


@dataclass
class Model:
    """Context and target vectors, one matrix per context position, biases."""

    context: np.ndarray
    target: np.ndarray
    near: np.ndarray
    far: np.ndarray
    bias: np.ndarray

    NAMES = ("context", "target", "near", "far", "bias")

    @classmethod
    def start(cls, symbol_counts: np.ndarray, size: int) -> Model:
        random = np.random.default_rng(7)
        small = lambda: (random.standard_normal((SYMBOLS, size)) * 0.1).astype(np.float32)
        share = (symbol_counts + 0.5) / (symbol_counts + 0.5).sum()
        eye = np.eye(size, dtype=np.float32)
        return cls(small(), small(), eye, eye * 0.5, np.log(share).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES])

    def filled(self, values: np.ndarray) -> Model:
        parts, at = [], 0
        for k in self.NAMES:
            old = getattr(self, k)
            parts.append(values[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return Model(*parts)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """What the near and the far context symbol add to the score of every symbol."""
        return self.context @ self.near @ self.target.T + self.bias, self.context @ self.far @ self.target.T


def contexts(symbols: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Far and near context and symbol of every token, ends included, and the tokens of each text."""
    n = np.array([len(s) // 2 for s in symbols], np.int64)
    flat = np.frombuffer(b"".join(symbols), np.int16)
    lead = np.cumsum(n + 3) - (n + 3)
    padded = np.full(int((n + 3).sum()), END, np.int64)
    here = np.repeat(lead + 2 - (np.cumsum(n) - n), n) + np.arange(len(flat))
    padded[here] = flat
    tokens = np.repeat(lead + 2 - (np.cumsum(n + 1) - (n + 1)), n + 1) + np.arange(int((n + 1).sum()))
    return padded[tokens - 2], padded[tokens - 1], padded[tokens], n + 1


def falling(x: np.ndarray) -> np.ndarray:
    """The logistic function of -x, in place."""
    np.minimum(x, 30, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Trainer:
    """Adagrad steps on the noise-contrastive loss; all texts of a batch share its noise symbols.

    Gradients are summed by symbol in whole tables, which are small, so that nothing is sorted.
    """

    def __init__(self, model: Model, share: np.ndarray, rate: float, noise: int, seed: int):
        self.m = Model(*(getattr(model, k).copy() for k in Model.NAMES))
        self.shift, self.cut = np.log(share).astype(np.float32) + np.float32(np.log(noise)), np.cumsum(share)
        self.rate, self.noise, self.random = rate, noise, np.random.default_rng(seed)
        self.seen = {k: np.full_like(getattr(self.m, k), 0.1) for k in Model.NAMES}
        #: Numbers lie in pairs where they can, as pairs are added in half the time.
        self.pairs = model.target.shape[1] % 2 == 0
        self.cells = np.arange(self.m.target.size >> self.pairs).reshape(SYMBOLS, -1)

    def gathered(self, index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at hand and the sums of their rows."""
        rows = rows.view(np.complex64) if self.pairs else rows
        sums = np.zeros(self.cells.shape, rows.dtype)  # the same type object, without which numpy adds slowly
        np.add.at(sums.ravel(), self.cells.take(index, 0).ravel(), rows.ravel())
        at = np.flatnonzero(np.bincount(index))
        return at, sums.take(at, 0).view(np.float32)

    def step(self, far: np.ndarray, near: np.ndarray, word: np.ndarray) -> None:
        m, size, dims = self.m, len(word), self.m.target.shape[1]
        noise = np.minimum(np.searchsorted(self.cut, self.random.random(self.noise) * self.cut[-1]), SYMBOLS - 1)
        drop = self.shift - m.bias
        f, n, t, q = m.context.take(far, 0), m.context.take(near, 0), m.target.take(word, 0), m.target.take(noise, 0)
        hidden = n @ m.near
        hidden += f @ m.far
        up = falling(np.einsum("ij,ij->i", hidden, t) - drop.take(word))
        down = hidden @ -q.T
        down += drop.take(noise)
        falling(down)
        g_hidden = np.multiply(t, up[:, None], out=t)
        g_hidden -= down @ q
        rows = np.empty((size + len(noise), dims), np.float32)
        np.matmul(down.T, hidden, out=rows[size:])
        np.negative(rows[size:], out=rows[size:])
        np.multiply(hidden, up[:, None], out=rows[:size])
        ends = np.concatenate([word, noise])
        words, target = self.gathered(ends, rows)
        bias = np.bincount(ends, np.concatenate([up, -(np.ones(size, np.float32) @ down)]), SYMBOLS).astype(np.float32)
        rows = np.empty((2 * size, dims), np.float32)
        np.matmul(g_hidden, m.near.T, out=rows[:size])
        np.matmul(g_hidden, m.far.T, out=rows[size:])
        around, context = self.gathered(np.concatenate([near, far]), rows)
        for k, at, g in (("context", around, context), ("target", words, target), ("near", None, n.T @ g_hidden), ("far", None, f.T @ g_hidden), ("bias", None, bias)):
            values, seen = getattr(m, k), self.seen[k]
            now, then = (values, seen) if at is None else (values.take(at, 0), seen.take(at, 0))
            g /= np.float32(np.sqrt(size))
            then += g * g
            g *= np.float32(self.rate)
            g /= np.sqrt(then)
            now += g
            if at is not None:
                values[at], seen[at] = now, then


def trained(encoded: DataFrame, vocab: Vocabulary, options: Options) -> Model:
    """Rounds of steps in every task over its share of the training texts, then averages."""
    model = Model.start(vocab.symbol_counts, options.size)
    share = (vocab.symbol_counts + 0.5) / (vocab.symbol_counts + 0.5).sum()
    rounds = len(options.rates)
    for turn, rate in enumerate(options.rates):
        sent = send(encoded.sparkSession, (model, share))

        def steps(batches: Iterator[pa.RecordBatch], sent=sent, rate=rate, turn=turn) -> Iterator[pa.RecordBatch]:
            start, share = received(sent)
            task = TaskContext.get().partitionId()
            trainer = Trainer(start, share, rate, options.noise, seed=task * rounds + turn)
            left, tokens = None, 0
            for batch in batches:
                far, near, word, _ = contexts(batch.column("symbols").to_pylist())
                order = trainer.random.permutation(len(word))
                now = np.stack([far[order], near[order], word[order]])
                left = now if left is None else np.concatenate([left, now], axis=1)
                whole = left.shape[1] // options.batch * options.batch
                for i in range(0, whole, options.batch):
                    trainer.step(*left[:, i : i + options.batch])
                tokens, left = tokens + whole, left[:, whole:]
            if left is not None and left.shape[1]:
                trainer.step(*left)
                tokens += left.shape[1]
            if tokens:
                flat = (trainer.m.flat() * np.float64(tokens)).astype(np.float64)
                cuts = range(0, len(flat), CHUNK)
                yield pa.record_batch(
                    [pa.array([i // CHUNK for i in cuts], pa.int32()), pa.array([task % 32] * len(cuts), pa.int32()), pa.array([tokens] * len(cuts), pa.int64()), pa.array([flat[i : i + CHUNK].tobytes() for i in cuts], pa.binary())],
                    ["chunk", "lane", "tokens", "sums"],
                )

        def added(frame):
            import pandas

            sums = np.sum([np.frombuffer(x) for x in frame["sums"]], axis=0)
            return pandas.DataFrame({"chunk": frame["chunk"][:1], "lane": frame["lane"][:1], "tokens": [frame["tokens"].sum()], "sums": [sums.tobytes()]})

        kind = "chunk int, lane int, tokens long, sums binary"
        rows = encoded.where(~F.col("held_out") & (F.col("row") % rounds == turn)).select("symbols").mapInArrow(steps, kind)
        lanes = rows.groupBy("chunk", "lane").applyInPandas(added, kind).withColumn("lane", F.lit(0))
        done = sorted(lanes.groupBy("chunk", "lane").applyInPandas(added, kind).collect())
        if done:
            model = model.filled(np.concatenate([np.frombuffer(r.sums) for r in done]) / done[0].tokens)
    return model


def normalisers(spark, model: Model) -> np.ndarray:
    """The log of the sum over all symbols after every pair of context symbols ``[far, near]``."""
    sent = send(spark, model)

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, far = received(sent).tables()
        near_exp = np.exp(near)
        for batch in batches:
            for i in batch.column("id").to_pylist():
                top = far[i].max()
                row = np.log(np.maximum(near_exp @ np.exp(far[i] - top), NOTHING)) + top
                yield pa.record_batch([pa.array([i]), pa.array([row.astype(np.float32).tobytes()], pa.binary())], ["far", "row"])

    rows = spark.range(0, SYMBOLS, 1, 6).mapInArrow(computed, "far long, row binary").collect()
    return np.stack([np.frombuffer(r.row, np.float32) for r in sorted(rows)])


class Tree:
    """The words of one rare symbol below a binary tree of logistic units; leaves are in order of keys."""

    def __init__(self, counts: np.ndarray, size: int):
        self.depth = max(len(counts) - 1, 0).bit_length()
        width = 1 << self.depth
        sums = np.zeros(2 * width)
        sums[width : width + len(counts)] = counts
        for level in range(self.depth - 1, -1, -1):
            sums[1 << level : 2 << level] = sums[2 << level : 4 << level].reshape(-1, 2).sum(1)
        left, right = sums[0::2][:width], sums[1::2][:width]
        self.live = (left > 0) & (right > 0)
        self.live[0] = False
        bias = np.where(self.live, np.log(np.maximum(left, NOTHING)) - np.log(np.maximum(right, NOTHING)), 0.0)
        self.start = np.log(np.maximum(counts, NOTHING) / max(counts.sum(), 1))
        #: Vector and bias of every node, side by side, as hidden vectors end with a one.
        self.units = np.concatenate([np.zeros((width, size)), bias[:, None]], axis=1).astype(np.float32)
        self.seen = np.ones((width, size + 1), np.float32)
        self.visits = np.zeros(width)

    def at(self, level: int, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of a level above the leaves, and whether the right side is taken."""
        return (1 << level) + (leaves >> (self.depth - level)), (leaves >> (self.depth - level - 1) & 1).astype(bool)

    def bands(self, leaves: np.ndarray) -> Iterator[Band | int]:
        """Levels from the root on, ``BAND`` of them at a time while the leaves lie below few nodes, then one by one."""
        level = 0
        while level < self.depth:
            edges = np.flatnonzero(np.diff(leaves >> (self.depth - level))) + 1
            if len(edges) >= len(leaves) // BAND_LEAVES:
                yield from range(level, self.depth)
                return
            band = Band(self, level, min(BAND, self.depth - level), leaves, [0, *edges.tolist(), len(leaves)])
            yield band
            level += band.levels

    def gain(self, hidden: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        """What the contexts add to the log of the words' shares of the symbol.

        ``hidden`` ends with a one; the leaves are sorted, so few units are at hand at a time.
        """
        total = np.empty(len(leaves))
        for i in range(0, len(leaves), GAINS):
            some, below = hidden[i : i + GAINS], leaves[i : i + GAINS]
            logs, product = np.zeros(len(below)), np.ones(len(below))
            for level in range(self.depth):
                node, right = self.at(level, below)
                score = some @ self.units[node[0]] if node[0] == node[-1] else np.einsum("ij,ij->i", some, self.units.take(node, 0))
                score *= right * np.float32(2) - np.float32(1)
                np.minimum(score, 30, out=score)
                np.exp(score, out=score)
                score *= self.live.take(node)
                score += 1
                product *= score
                if level % 16 == 15:  # at most 16 factors of e^30 before a logarithm
                    logs -= np.log(product)
                    product[:] = 1
            total[i : i + GAINS] = logs - np.log(product)
        return total - self.start[leaves]

    def step(self, hidden: np.ndarray, leaves: np.ndarray, rate: float) -> None:
        """One Adagrad step of all nodes above the leaves, which are sorted, on the logistic loss."""
        cells = np.arange(hidden.size).reshape(hidden.shape)
        for band in self.bands(leaves):
            if isinstance(band, Band):
                up = falling(band.scores(hidden))
                up -= band.right
                up *= self.live.take(band.node)
                self.learn(*band.sums(hidden, up), rate)
                continue
            node, right = self.at(band, leaves)
            new = np.append(True, node[1:] != node[:-1])
            first = np.flatnonzero(new)
            up = falling(np.einsum("ij,ij->i", hidden, self.units.take(node, 0)))
            up -= right
            up *= self.live.take(node)
            rows = hidden * up[:, None]
            g = np.zeros((len(first), hidden.shape[1]), rows.dtype)  # the same type object, without which numpy adds slowly
            np.add.at(g.ravel(), cells.take(np.cumsum(new) - 1, 0).ravel(), rows.ravel())
            self.learn(node[first], g, np.diff(np.append(first, len(node))), rate)

    def learn(self, nodes: np.ndarray, g: np.ndarray, times: np.ndarray, rate: float) -> None:
        g /= np.sqrt(times, dtype=np.float32)[:, None]
        seen = self.seen.take(nodes, 0)
        seen += g * g
        self.seen[nodes] = seen
        g *= np.float32(rate)
        g /= np.sqrt(seen, out=seen)
        g += self.units.take(nodes, 0)
        self.units[nodes] = g
        self.visits[nodes] += times

    def flat(self) -> np.ndarray:
        """Visits of every node, and its vector and bias times these."""
        return np.concatenate([self.visits[:, None], self.visits[:, None] * self.units], axis=1)

    def fill(self, first: int, sums: np.ndarray) -> None:
        """Means of the nodes from ``first``, from sums of ``flat``; nodes without visits stay."""
        sums = sums.reshape(-1, self.units.shape[1] + 1)
        node = first + np.flatnonzero(sums[:, 0])
        self.units[node] = sums[node - first, 1:] / sums[node - first, :1]


class Band:
    """Some levels of a tree above sorted leaves, whose units are a small matrix below each node of the first level."""

    def __init__(self, tree: Tree, first: int, levels: int, leaves: np.ndarray, edges: list[int]):
        self.tree, self.levels, self.width, self.spans = tree, levels, 1 << levels, list(zip(edges, edges[1:]))
        level = np.arange(levels)
        below = leaves[:, None] >> (tree.depth - first - level)
        self.node = (1 << (first + level)) + below
        self.right = (leaves[:, None] >> (tree.depth - first - level - 1) & 1).astype(bool)
        self.inner = (1 << level) + (below & ((1 << level) - 1))
        #: Cell of a leaf and level in the matrix of all scores.
        self.cell = self.inner + np.arange(len(leaves))[:, None] * self.width
        each = np.arange(1, self.width)
        height = np.frexp(each)[1] - 1
        tops = leaves[edges[:-1]] >> (tree.depth - first)
        #: Nodes in the order of the matrices; the first of each is none.
        self.nodes = np.zeros((len(tops), self.width), np.int64)
        self.nodes[:, 1:] = (1 << (first + height)) + (tops[:, None] << height) + each - (1 << height)

    def scores(self, hidden: np.ndarray) -> np.ndarray:
        """The score on every level."""
        units, out = self.tree.units.take(self.nodes, 0), np.empty((len(hidden), self.width), np.float32)
        for (a, b), u in zip(self.spans, units):
            np.matmul(hidden[a:b], u.T, out=out[a:b])
        return out.take(self.cell)

    def sums(self, hidden: np.ndarray, up: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nodes at hand, the sums of the hidden vectors below them times ``up``, and how many these are."""
        wide = np.zeros((len(hidden), self.width), np.float32)
        wide.ravel()[self.cell.ravel()] = up.ravel()
        out = np.empty((len(self.spans), self.width, hidden.shape[1]), np.float32)
        for (a, b), g in zip(self.spans, out):
            np.matmul(wide[a:b].T, hidden[a:b], out=g)
        place = np.repeat(np.arange(len(self.spans)) * self.width, [b - a for a, b in self.spans])
        times = np.bincount((self.inner + place[:, None]).ravel(), minlength=self.nodes.size)
        here = np.flatnonzero(times)
        return self.nodes.take(here), out.reshape(-1, hidden.shape[1]).take(here, 0), times.take(here)


def by_bucket(keys: np.ndarray) -> np.ndarray:
    """The order of keys by bucket, then key; equal keys stay in their order.

    The bucket's bits go to the front of one number, which is sorted fast but not stably; then places
    of equal keys, as numbers of group and place, are sorted.
    """
    keys = keys << np.uint64(64 - BUCKET_BITS) | keys >> np.uint64(BUCKET_BITS)
    order = np.argsort(keys)
    keys = keys[order]
    group = np.cumsum(np.append(False, keys[1:] != keys[:-1])[: len(keys)])
    return np.sort(group << 32 | order) & ((1 << 32) - 1)


def packed(*arrays: np.ndarray) -> bytes:
    return pa.compress(b"".join(x.tobytes() for x in arrays), codec="zstd", asbytes=True)


def tree_gains(encoded: DataFrame, counts: DataFrame, vocab: Vocabulary, model: Model, options: Options) -> DataFrame:
    """``(row, gain, more, base, rare)``: log10 of what contexts add to the probabilities of a text's known rare words.

    The others are of its words that were not sent to all executors, whose counts are here anyway: how many
    of them are known, their base scores, and their probabilities within their symbols.
    """
    spark = encoded.sparkSession
    parts = np.maximum(1, -(-vocab.bucket_tokens.astype(np.int64) // PART_TOKENS))
    firsts = np.cumsum(parts) - parts
    one, zero_at = np.ones((SYMBOLS, 1), np.float32), np.zeros((SYMBOLS, 1), np.float32)
    sent = send(spark, (vocab, np.hstack([model.context @ model.near, one]), np.hstack([model.context @ model.far, zero_at])))
    token = np.dtype([("key", np.uint64), ("row", np.int64), ("far", np.int16), ("near", np.int16), ("held_out", bool)])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = received(sent)[0].keys
        for batch in batches:
            if not batch.num_rows:
                continue
            far, near, word, n = contexts(batch.column("symbols").to_pylist())
            rare = (word >= WORDS) & (word < END)
            owner = np.repeat(np.arange(len(n)), n)[rare]
            picks = np.frombuffer(b"".join(batch.column("picks").to_pylist()), np.int32)
            words = batch.column("words")
            others = words.flatten().to_numpy().view(np.uint64)
            base = np.concatenate([[0], np.cumsum(words.value_lengths().to_numpy())])
            key = np.empty(len(picks), np.uint64)
            top = picks >= 0
            key[top] = keys[picks[top]]
            key[~top] = others[base[owner[~top]] - 1 - picks[~top]]
            row = batch.column("row").to_numpy()[owner]
            bucket = word[rare] - WORDS
            place = firsts[bucket] + row % parts[bucket]
            order = by_bucket(key)
            if (parts > 1).any():
                order = order[np.argsort(place[order], kind="stable")]
            key, row, far, near, place = key[order], row[order], far[rare][order].astype(np.int16), near[rare][order].astype(np.int16), place[order]
            held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)[owner][order]
            edges = np.flatnonzero(np.append(np.ones(min(len(place), 1), bool), place[1:] != place[:-1])).tolist()
            ends = [*edges[1:], len(place)]
            if edges:
                yield pa.record_batch(
                    [
                        pa.array(place[edges], pa.int64()),
                        pa.array(np.subtract(ends, edges), pa.int64()),
                        pa.array([packed(key[a:b], row[a:b], far[a:b], near[a:b], held[a:b]) for a, b in zip(edges, ends, strict=True)], pa.binary()),
                    ],
                    ["place", "n", "data"],
                )

    def unpacked(n: int, data: bytes) -> np.ndarray:
        whole, out, at = pa.decompress(data, n * token.itemsize, codec="zstd"), np.empty(n, token), 0
        for name in token.names:
            out[name] = np.frombuffer(whole, token[name], n, at)
            at += n * token[name].itemsize
        return out

    def grown(ready: bool):
        """Trees of the places at hand: trained, and used or handed on to be averaged; ``ready`` ones are used."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocab, near_part, far_part = received(sent)
            top = np.sort(vocab.keys[:WORDS])
            for group in runs(batches, ("place",)):
                turn, n, word = (group.column(c).to_numpy() for c in ("turn", "n", "word"))
                place, data = int(group.column("place")[0].as_py()), group.column("data")
                bucket = int(np.searchsorted(firsts, place, side="right")) - 1
                words, times = word[turn == 0].view(np.uint64), n[turn == 0]
                own = ~np.isin(words, top)
                words, times = words[own], times[own]
                order = np.argsort(words)
                words, times = words[order], times[order]
                blocks = [unpacked(int(n[i]), data[i].as_py()) for i in np.flatnonzero(turn == 2).tolist()]
                if not blocks:
                    continue
                every = np.concatenate(blocks)
                leaves = np.searchsorted(words, every["key"])
                known = np.append(words, np.uint64(0))[leaves] == every["key"]
                known &= leaves < len(words)
                counts = np.where(known, np.append(times, 0)[leaves], 0)
                tokens, leaves = every[known], leaves[known]
                tree = Tree(times.astype(np.float64), near_part.shape[1] - 1)
                near, far = tokens["near"].astype(np.int64), tokens["far"].astype(np.int64)
                hidden = lambda at, near=near, far=far: near_part.take(near.take(at), 0) + far_part.take(far.take(at), 0)
                if ready:
                    for i in np.flatnonzero(turn == 1).tolist():
                        tree.fill(int(word[i]), np.frombuffer(data[i].as_py()))
                else:
                    random = np.random.default_rng(place)
                    training = np.flatnonzero(~tokens["held_out"])
                    for _ in range(options.tree_rounds):
                        training = random.permutation(training)
                        for i in range(0, len(training), options.tree_batch):
                            at = training[i : i + options.tree_batch]
                            at = at[np.argsort(leaves[at])]
                            tree.step(hidden(at), leaves[at], options.tree_rate)
                if ready or parts[bucket] == 1:
                    gain, order = np.zeros(len(tokens)), np.argsort(leaves)
                    for i in range(0, len(tokens), GAINS):
                        at = order[i : i + GAINS]
                        gain[at] = tree.gain(hidden(at), leaves[at])
                    texts, owner = np.unique(every["row"], return_inverse=True)
                    tail = np.flatnonzero(counts < vocab.limit)
                    counts, whose = counts[tail], owner[tail]
                    sums = (
                        np.bincount(owner[known], gain, len(texts)) / np.log(10),
                        np.bincount(whose[counts > 0], minlength=len(texts)),
                        np.bincount(whose, vocab.base(counts), len(texts)),
                        np.bincount(whose, vocab.in_bucket(counts, np.full(len(counts), bucket)), len(texts)),
                    )
                    none = pa.nulls(len(texts), pa.int64())
                    sums = [pa.array(x.astype(t)) for x, t in zip(sums, (float, np.int64, float, float), strict=True)]  # an empty bincount is of whole numbers
                    yield pa.record_batch([pa.array(texts), *sums, none, none, pa.nulls(len(texts), pa.binary())], ["row", "gain", "more", "base", "rare", "bucket", "word", "data"])
                else:
                    flat = tree.flat()
                    for i in range(0, len(flat), CHUNK):
                        if flat[i : i + CHUNK, 0].any():
                            yield pa.record_batch(
                                [
                                    pa.nulls(1, pa.int64()),
                                    pa.nulls(1, pa.float64()),
                                    pa.nulls(1, pa.int64()),
                                    pa.nulls(1, pa.float64()),
                                    pa.nulls(1, pa.float64()),
                                    pa.array([bucket]),
                                    pa.array([i]),
                                    pa.array([flat[i : i + CHUNK].tobytes()], pa.binary()),
                                ],
                                ["row", "gain", "more", "base", "rare", "bucket", "word", "data"],
                            )

        return run

    def added(frame):
        import pandas

        return pandas.DataFrame({"bucket": frame["bucket"][:1], "word": frame["word"][:1], "data": [np.sum([np.frombuffer(x) for x in frame["data"]], axis=0).tobytes()]})

    def spread(rows: DataFrame) -> DataFrame:
        """Rows of a bucket to all of its places."""
        first, many = (F.element_at(F.lit([int(x) for x in v]).cast("array<long>"), (F.col("bucket") + 1).cast("int")) for v in (firsts, parts))
        return rows.withColumn("place", F.explode(F.sequence(first, first + many - 1)))

    def placed(*rows: DataFrame) -> DataFrame:
        columns = ("place", "turn", "word", "n", "data")
        all_rows = rows[0].select(*columns)
        for more in rows[1:]:
            all_rows = all_rows.unionByName(more.select(*columns))
        return all_rows.repartition("place").sortWithinPartitions("place", "turn")

    none, zero = F.lit(None).cast("binary"), F.lit(0).cast("long")
    words = spread(counts.where(F.col("word") != -1).withColumn("bucket", F.col("word").bitwiseAND((1 << BUCKET_BITS) - 1))).withColumns({"turn": F.lit(0), "data": none})
    tokens = encoded.select("row", "held_out", "symbols", "picks", "words").mapInArrow(blocks, "place long, n long, data binary").withColumns({"turn": F.lit(2), "word": zero})
    kind = "row long, gain double, more long, base double, rare double, bucket long, word long, data binary"
    done = placed(words, tokens).mapInArrow(grown(False), kind)
    if (parts > 1).any():
        done = kept(done, "lm-trees")
        means = done.where("bucket IS NOT NULL").groupBy("bucket", "word").applyInPandas(added, "bucket long, word long, data binary")
        many = F.col("place").isin([int(f + i) for f, p in zip(firsts, parts, strict=True) if p > 1 for i in range(p)])
        trees = spread(means).withColumns({"turn": F.lit(1), "n": zero})
        done = done.where("row IS NOT NULL").unionByName(placed(words.where(many), trees, tokens.where(many)).mapInArrow(grown(True), kind))
    return done.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("gain", "more", "base", "rare")])


def score_texts(docs: DataFrame, options: Options = Options()) -> DataFrame:  # noqa: B008
    """Scores of all ``docs(doc_id, text)``; see the module for the model and its odd cases."""
    spark = docs.sparkSession
    split = docs.select("doc_id", "text", (remainder(F.col("doc_id"), options.held_out_of) == 0).alias("held_out"))
    counts = kept(word_counts(split.where(~F.col("held_out"))), "lm-words")
    vocab = vocabulary(counts)
    encoded = kept(encode(split, vocab), "lm-texts")
    model = trained(encoded, vocab, options)
    sent = send(spark, (model, normalisers(spark, model)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, log_z = received(sent)
        near_table, far_table = model.tables()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                far, near, word, n = contexts(part.column("symbols").to_pylist())
                each = near_table[near, word] + far_table[far, word] - log_z[far, near]
                sums = np.add.reduceat(each.astype(np.float64), np.cumsum(n) - n) / np.log(10)
                yield pa.record_batch([part.column(k) for k in ("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "rare")] + [pa.array(sums)], ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "rare", "neural"])

    kind = "row long, doc_id string, held_out boolean, n_tokens long, n_known long, base double, rare double, neural double"
    texts = encoded.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "rare", "symbols").mapInArrow(scored, kind)

    tail = tree_gains(encoded, counts, vocab, model, options).withColumnsRenamed({"base": "base_tail", "rare": "rare_tail"})
    none = lambda c: F.coalesce(c, F.lit(0))
    return texts.join(tail, "row", "left").select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "held_out",
        "n_tokens",
        (F.col("n_known") + none("more")).alias("n_known"),
        F.lit(int(vocab.tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + none("base_tail")).alias("base_score"),
        (F.col("neural") + F.col("rare") + none("rare_tail") + none("gain")).alias("score"),
    )
