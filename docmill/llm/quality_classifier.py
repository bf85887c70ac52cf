"""A document classifier over hashed subword vectors: averages, softmax, stochastic gradient descent.

Features of a text are its words, its pairs of adjacent words, words that repeat the one before
them, and the runs of 3, 4 and 5 bytes inside words with one blank at either side. Each is hashed
to a row of vectors; the vectors of all occurrences are averaged, and a softmax over the average
gives the classes. Training takes a bounded sample of the labelled rows, chosen by a hash of their
ids: tasks make Adagrad steps over their parts and the parameters are averaged after each round.
As the average is linear, scoring needs one number per row of vectors.

Defined cases: null texts are empty and score what the biases give; labels that are null or
belong to no document are not used, of several labels of a document the largest counts; without
labels of both classes every score is 0.5 or above or below it by the shares; repeated rows are
scored each; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.shared import kept, received, remainder, send
from docmill.llm.textops import Hasher, bytes_of, counts_of, grams, mixed, slices

ROWS = 1 << 16
SIZES = (3, 4, 5)
REPEATED = 0


@dataclass(frozen=True)
class Options:
    #: At most so many labelled documents are trained on.
    sample: int = 8192
    parts: int = 4
    size: int = 8
    rounds: int = 6
    epochs: int = 2
    batch: int = 32
    rate: float = 0.1
    fold: int = 3
    held_out: int = 1


class Features:
    """Rows of the vector table for whole slices of text."""

    def __init__(self):
        self.hasher = Hasher(lower=False)
        self.values = (self.hasher.values >> np.uint64(32)).astype(np.uint32)
        blank = self.values[32]
        self.values[[9, 10, 11, 12, 13]] = blank

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Several arrays of rows, each with how many belong to each text."""
        starts, _, words = self.hasher.words(data, offsets)
        n = counts_of(starts, offsets)
        yield self.rows(words), n
        pairs, runs = grams(words, n, 2)
        rows = self.rows(pairs)
        at = np.repeat((np.cumsum(n) - n) - (np.cumsum(runs) - runs), runs) + np.arange(len(pairs))
        rows[words[at] == words[np.minimum(at + 1, len(words) - 1)]] = REPEATED
        yield rows, runs
        texts = len(offsets) - 1
        spaced = np.full(len(data) + texts + 1, 32, np.uint8)
        spaced[np.arange(len(data)) + np.repeat(np.arange(texts), np.diff(offsets)) + 1] = data
        borders = offsets + np.arange(texts + 1)
        space = np.concatenate([[0], np.cumsum((spaced == 32) | ((spaced >= 9) & (spaced <= 13)), dtype=np.int32)])
        values, total = self.values[spaced], None
        factor = 1
        for i in range(max(SIZES)):
            length = len(spaced) - i
            total = values[:length].copy() if total is None else total[:length] + values[i:] * np.uint32(factor)
            factor = factor * 0x9E3779B1 % (1 << 32)
            if i + 1 in SIZES and length > 0:
                inside = np.flatnonzero(space[i : i + length] == space[1 : 1 + length])
                h = total[inside]
                h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
                yield ((h >> np.uint32(15)) & np.uint32(ROWS - 1)).astype(np.int32), np.diff(np.searchsorted(inside, borders))

    @staticmethod
    def rows(hashes: np.ndarray) -> np.ndarray:
        return np.maximum(mixed(hashes) >> np.uint64(48), np.uint64(1)).astype(np.int32)


def bags(features: Features, data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct rows and their shares."""
    parts = list(features(data, offsets))
    ends = [np.concatenate([[0], np.cumsum(n)]) for _, n in parts]
    out = []
    for i in range(len(offsets) - 1):
        rows, n = np.unique(np.concatenate([r[e[i] : e[i + 1]] for (r, _), e in zip(parts, ends, strict=True)]), return_counts=True)
        out.append((rows, (n / max(n.sum(), 1)).astype(np.float32)))
    return out


class Softmax:
    """Vectors, class weights and biases, with one Adagrad sum per parameter."""

    def __init__(self, size: int, classes: int = 2):
        random = np.random.default_rng(5)
        self.vectors = (random.random((ROWS, size)) - 0.5).astype(np.float32) / np.float32(size)
        self.weights = ((random.random((size, classes)) - 0.5) * 0.5).astype(np.float32)
        self.bias = np.zeros(classes, np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.vectors.ravel(), self.weights.ravel(), self.bias])

    def fill(self, values: np.ndarray) -> None:
        at = 0
        for k in ("vectors", "weights", "bias"):
            old = getattr(self, k)
            setattr(self, k, values[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size

    def train(self, texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, options: Options, seed: int) -> None:
        random = np.random.default_rng(seed)
        sums = [np.full_like(x, 1e-10) for x in (self.vectors, self.weights, self.bias)]
        size = self.vectors.shape[1]
        for _ in range(options.epochs):
            order = random.permutation(len(texts))
            for i in range(0, len(order), options.batch):
                chosen = order[i : i + options.batch]
                rows = np.concatenate([texts[j][0] for j in chosen])
                shares = np.concatenate([texts[j][1] for j in chosen])
                doc = np.repeat(np.arange(len(chosen)), [len(texts[j][0]) for j in chosen])
                used, place = np.unique(rows, return_inverse=True)
                vectors = self.vectors[rows] * shares[:, None]
                hidden = np.stack([np.bincount(doc, vectors[:, k], len(chosen)) for k in range(size)], axis=1).astype(np.float32)
                scores = hidden @ self.weights + self.bias
                odds = np.exp(scores - scores.max(1, keepdims=True))
                error = odds / odds.sum(1, keepdims=True)
                error[np.arange(len(chosen)), labels[chosen]] -= 1
                error /= len(chosen)
                back = (error @ self.weights.T)[doc] * shares[:, None]
                step = np.stack([np.bincount(place, back[:, k], len(used)) for k in range(size)], axis=1).astype(np.float32)
                sums[0][used] += step * step
                self.vectors[used] -= options.rate * step / np.sqrt(sums[0][used])
                for value, total, g in ((self.weights, sums[1], hidden.T @ error), (self.bias, sums[2], error.sum(0))):
                    total += g * g
                    value -= np.float32(options.rate) * g / np.sqrt(total)


def sample(docs: DataFrame, labels: DataFrame, column: str, options: Options) -> DataFrame:
    """At most ``sample`` labelled texts outside the held-out fold, the same ones on every run."""
    known = labels.where(F.col(column).isNotNull() & (remainder(F.col("doc_id"), options.fold) != options.held_out))
    chosen = known.groupBy("doc_id").agg(F.max(column).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(options.sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(kept(chosen, "labels")), "doc_id")
    return kept(rows.repartition(options.parts, F.xxhash64("doc_id")).select("text", "label"), "labelled-texts")


def trained(texts: DataFrame, options: Options) -> Softmax:
    """Rounds of steps over the parts of the sample, then averages weighted by documents."""
    model = Softmax(options.size)
    chunk = 1 << 16
    for turn in range(options.rounds):
        sent = send(texts.sparkSession, model)

        def steps(batches: Iterator[pa.RecordBatch], sent=sent, turn=turn) -> Iterator[pa.RecordBatch]:
            mine = Softmax(options.size)
            mine.fill(received(sent).flat())
            features, rows, labels = Features(), [], []
            for batch in slices(batches):
                rows += bags(features, *bytes_of(batch.column("text")))
                labels += batch.column("label").to_pylist()
            if rows:
                mine.train(rows, np.array(labels), options, TaskContext.get().partitionId() * options.rounds + turn)
                flat = mine.flat() * np.float32(len(rows))
                for i in range(0, len(flat), chunk):
                    yield pa.record_batch([pa.array([i // chunk], pa.int32()), pa.array([len(rows)], pa.int64()), pa.array([flat[i : i + chunk].tobytes()], pa.binary())], ["chunk", "n", "sums"])

        def added(frame):
            import pandas

            sums = np.sum([np.frombuffer(x, np.float32) for x in frame["sums"]], axis=0) / frame["n"].sum()
            return pandas.DataFrame({"chunk": frame["chunk"][:1], "mean": [sums.astype(np.float32).tobytes()]})

        rows = texts.mapInArrow(steps, "chunk int, n long, sums binary").groupBy("chunk").applyInPandas(added, "chunk int, mean binary")
        done = sorted(rows.collect())
        if done:
            model.fill(np.concatenate([np.frombuffer(r["mean"], np.float32) for r in done]))
    return model


def classify(docs: DataFrame, labels: DataFrame, column: str = "quality", options: Options = Options()) -> DataFrame:  # noqa: B008
    """Score all ``docs(doc_id, text)``: the probability of label 1, learnt from ``labels(doc_id, <column>)``."""
    model = trained(sample(docs, labels, column, options), options)
    slope = model.weights[:, 1] - model.weights[:, 0]
    sent = send(docs.sparkSession, (model.vectors @ slope, float(model.bias[1] - model.bias[0])))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worth, start = received(sent)
        features = Features()
        for batch in slices(batches):
            sums, n = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for rows, each in features(*bytes_of(batch.column("text"))):
                running = np.concatenate([[0.0], np.cumsum(worth[rows], dtype=np.float64)])
                cut = np.concatenate([[0], np.cumsum(each)])
                sums += running[cut[1:]] - running[cut[:-1]]
                n += each
            score = 1 / (1 + np.exp(-np.clip(sums / np.maximum(n, 1) + start, -50, 50)))
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    kind = docs.select("doc_id").schema.add("held_out", "boolean").add("score", "double").add("predicted", "integer")
    held = remainder(F.col("doc_id"), options.fold) == options.held_out
    return docs.select("doc_id", held.alias("held_out"), "text").mapInArrow(scored, kind)
