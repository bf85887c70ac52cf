"""Rules on single texts and on lines that many documents of a host share.

A line is normalised (A-Z lower-cased, digits to 0, words joined by one blank) and hashed with
its host. Every document of a host, copies of others included, counts once for each of its lines.
A line found in more than ``documents`` documents of its host is above the limit, however large
the host is: it is removed. A document is depleted, and rejected, when less than ``remaining`` of
its words are left; it also fails when it has few words or mostly repeats itself.

Defined cases: null texts have no words and fail; a null host is a host of its own; lines without
words are never removed; rows with one id are one document in line counts, rows without an id one
for each text, and all rows are decided each; an empty table gives no rows. All input columns pass
through; a column named like a result, in any case, is replaced.
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
from docmill.llm.textops import Hasher, bytes_of, counts_of, grams, mixed, slices

WINDOW_WORDS = 8
NOT_COUNTED = bytes([9, 10, 11, 12, 13, 32, *range(0x80, 0xC0)])
SYMBOLS = b"#*$%&|<>"
ZEROS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")
#: Lines above the limit that are sent to all executors (8 bytes each); with more of them they are joined.
BROADCAST_LINES = 1 << 20
RESULTS = {
    "n_words": T.LongType(),
    "word_chars": T.LongType(),
    "n_symbols": T.LongType(),
    "n_dup_lines": T.LongType(),
    "n_repeat_words": T.LongType(),
    "n_removed_words": T.LongType(),
    "base_failed": T.BooleanType(),
    "kept": T.BooleanType(),
    "cleaned": T.StringType(),
}


@dataclass(frozen=True)
class Limits:
    documents: int = 20
    remaining: float = 0.2
    words: int = 20
    repeated_percent: int = 30


def line_key(host: bytes, words: list[bytes]) -> int:
    return int.from_bytes(hashlib.md5(host + b"\0" + b" ".join(words)).digest()[:8], "little", signed=True)


def host_of(source: str | None) -> bytes:
    return b"-" if source is None else b"+" + source.encode()


def shared_lines(docs: DataFrame, host: str, limits: Limits) -> DataFrame:
    """Keys of the lines above the limit of their host; distinct documents are counted, in two steps."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, names = [], []
            for source, text, name in zip(*(batch.column(c).to_pylist() for c in ("host", "text", "name")), strict=True):
                source, data = host_of(source), (text or "").encode()
                mine = {line_key(source, w) for line in data.translate(ZEROS).split(b"\n") if (w := line.split())}
                keys += mine
                names += [line_key(b"id", [name.encode()]) if name is not None else line_key(b"text", [data])] * len(mine)
            yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(names, pa.int64())], ["line", "name"])

    rows = docs.select(F.col(host).alias("host"), "text", F.col("doc_id").cast("string").alias("name")).mapInArrow(found, "line long, name long").distinct()
    return rows.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") > limits.documents).select("line")


def decided(docs: DataFrame, host: Column, removed: Column, common, limits: Limits) -> DataFrame:
    """Measure, clean and judge every text in one pass. ``removed`` has a row's own lines above the limit, or null for ``common``."""
    passed = [f for f in docs.schema.fields if f.name.lower() not in RESULTS]
    schema = T.StructType([*passed, *(T.StructField(k, v) for k, v in RESULTS.items())])
    text_at = [f.name for f in passed].index("text")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=False)
        sent = frozenset() if common is None else frozenset(received(common).tolist())
        for batch in slices(batches, batch_text):
            texts = batch.column(text_at)
            data, offsets = bytes_of(texts)
            starts, _, hashes = hasher.words(data, offsets)
            n = counts_of(starts, offsets)
            repeated = repeat_words(hashes, n)
            out = {k: [] for k in RESULTS}
            whole = data.tobytes()
            for i, (source, own) in enumerate(zip(batch.column("__host").to_pylist(), batch.column("__removed").to_pylist(), strict=True)):
                text = whole[offsets[i] : offsets[i + 1]]
                chars = text.translate(None, NOT_COUNTED)
                lines = text.split(b"\n")
                filled = [x for x in lines if x.strip()]
                above = sent if own is None else frozenset(own)
                lost, left = 0, lines
                if above:
                    left, source = [], host_of(source)
                    for line in lines:
                        words = line.translate(ZEROS).split()
                        if words and line_key(source, words) in above:
                            lost += len(words)
                        else:
                            left.append(line)
                words = int(n[i])
                failed = words < limits.words or 100 * int(repeated[i]) > limits.repeated_percent * words
                values = (words, len(chars), len(chars) - len(chars.translate(None, SYMBOLS)), len(filled) - len(set(filled)), int(repeated[i]), lost, failed, not failed and words - lost >= limits.remaining * words)
                for k, v in zip(RESULTS, (*values, b"\n".join(left).decode() if texts[i].is_valid else None), strict=True):
                    out[k].append(v)
            arrow = {T.LongType(): pa.int64(), T.BooleanType(): pa.bool_(), T.StringType(): pa.string()}
            yield pa.record_batch([*batch.columns[: len(passed)], *(pa.array(out[k], arrow[v]) for k, v in RESULTS.items())], schema.names)

    batch_text = text_at
    return docs.select(*(F.col(f"`{f.name}`") for f in passed), host.alias("__host"), removed.alias("__removed")).mapInArrow(judged, schema)


def repeat_words(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text, the words inside windows that are found twice or more in it."""
    windows, runs = grams(hashes, counts, WINDOW_WORDS)
    doc = np.repeat(np.arange(len(counts)), runs)
    windows = windows ^ mixed(doc.astype(np.uint64))
    order = np.argsort(windows)
    same = windows[order][1:] == windows[order][:-1]
    twice = np.zeros(len(windows), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    at = (np.repeat((np.cumsum(counts) - counts) - (np.cumsum(runs) - runs), runs) + np.arange(len(windows)))[twice]
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW_WORDS, -1)
    owner = np.repeat(np.arange(len(counts)), counts)
    return np.bincount(owner[np.cumsum(edge)[:-1] > 0], minlength=len(counts))


def apply_rules(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:  # noqa: B008
    """``docs(doc_id, text, <host>, ...)`` with the measures of each text, ``kept``, and its ``cleaned`` text.

    Lines above the limit are sent to all executors if they are at most BROADCAST_LINES in all, so
    no text is moved; with more, each text is joined with its own.
    """
    above = kept(shared_lines(docs, host, limits), "shared-lines")
    if above.count() <= BROADCAST_LINES:
        common = send(docs.sparkSession, above.toArrow().column("line").to_numpy())
        return decided(docs, F.col(host), F.lit(None).cast("array<long>"), common, limits)
    return decided(joined(docs, host, above), F.col(host), F.col("__own"), None, limits).drop("__own")


def joined(docs: DataFrame, host: str, above: DataFrame) -> DataFrame:
    """Every row with its own lines above the limit; they are found per distinct text of a host."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names, keys = [], []
            for source, text in zip(batch.column("host").to_pylist(), batch.column("text").to_pylist(), strict=True):
                source, data = host_of(source), (text or "").encode()
                mine = {line_key(source, w) for line in data.translate(ZEROS).split(b"\n") if (w := line.split())}
                names += [hashlib.md5(source + b"\0" + data).hexdigest()] * len(mine)
                keys += mine
            yield pa.record_batch([pa.array(names, pa.string()), pa.array(keys, pa.int64())], ["__text", "line"])

    source = F.coalesce(F.concat(F.lit("+"), F.col(host)), F.lit("-"))
    name = F.md5(F.concat(source.cast("binary"), F.lit(b"\0"), F.coalesce("text", F.lit("")).cast("binary")))
    lines = docs.select(F.col(host).alias("host"), "text").mapInArrow(own, "__text string, line long").distinct()
    mine = lines.join(above, "line").groupBy("__text").agg(F.collect_list("line").alias("__own"))
    rows = docs.withColumn("__text", name).join(mine, "__text", "left").drop("__text")
    return rows.withColumn("__own", F.coalesce("__own", F.expr("CAST(array() AS array<long>)")))
