"""Packing: ids against the library, solutions against trying all, results against the rules."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docmill.llm import packing

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_library(library):
    with open(PATH, encoding="utf-8") as file:
        encode = packing.Encoder(file.read(), PATTERN)
    assert encode.fast
    r = random.Random(1)
    texts = ["", " ", "  a  b ", "<|endoftext|> x", "it's we'LL", "a\r\n\tb\x85c d　e", " " * 300_000 + "x", "\n" * 200_000, "q" * 5000, "…" * 999, "\U0001f600‍" * 9]
    for _ in range(300):
        texts.append("".join(chr(r.choice([r.randrange(32, 127), r.randrange(0, 0x250), r.randrange(0, 0xD800), r.randrange(0xE000, 0x110000), 32, 10])) for _ in range(r.randint(0, 60))))
    for text in texts:
        assert encode(text).tolist() == library(text)


def test_only_plain_files_take_the_short_way():
    import json

    with open(PATH, encoding="utf-8") as file:
        data = json.load(file)
    ranks = packing.plain_ranks(data)
    assert len(ranks) == 50_256 and ranks[b" t"] == data["model"]["vocab"]["Ġt"]
    assert packing.plain_ranks(data | {"normalizer": {"type": "NFC"}}) is None
    assert packing.plain_ranks(data | {"pre_tokenizer": {"type": "Whitespace"}}) is None
    assert packing.plain_ranks(data | {"model": data["model"] | {"merges": data["model"]["merges"][::-1]}}) is None


def fewest_by_hand(lengths, size):
    best = len(lengths)

    def put(i, free):
        nonlocal best
        if len(free) >= best:
            return
        if i == len(lengths):
            best = len(free)
            return
        for j in range(len(free)):
            if free[j] >= lengths[i]:
                put(i + 1, [*free[:j], free[j] - lengths[i], *free[j + 1 :]])
        put(i + 1, [*free, size - lengths[i]])

    put(0, [])
    return best


@pytest.mark.parametrize("seed", range(4))
def test_bounds_and_solutions_of_small_cases(seed):
    r = random.Random(seed)
    for _ in range(40):
        size = r.choice([10, 20, 31])
        lengths = np.array(sorted((r.randint(1, size) for _ in range(r.randint(1, 8))), reverse=True))
        best = fewest_by_hand(lengths.tolist(), size)
        assert packing.fewest(lengths, size) <= best
        rng = np.random.default_rng(seed)
        found = packing.evolved(lengths, packing.first_population(lengths, size, 4, rng), size, 60, rng)[0]
        assert np.bincount(found, lengths).max() <= size
        assert found.max() + 1 == best


def test_children_keep_all_pieces_and_improve():
    rng = np.random.default_rng(2)
    parts = []
    for _ in range(12):  # three that fill a bin, which best fit alone does not find
        a, b = rng.integers(26, 48, 2)
        parts += [a, b, 100 - a - b] if 100 - a - b > 25 else [50, 25, 25]
    lengths = np.sort(np.array(parts))[::-1]
    population = packing.first_population(lengths, 100, 6, rng)
    for one in population:
        for other in population:
            child = packing.crossed(lengths, one, other, 100, rng)
            assert len(child) == len(lengths) and child.min() >= 0 and np.bincount(child, lengths).max() <= 100
            assert set(child.tolist()) == set(range(child.max() + 1))
    first = min(p.max() + 1 for p in population)
    found = packing.evolved(lengths, population, 100, 200, rng)[0].max() + 1
    assert packing.fewest(lengths, 100) <= found < first


def checked(rows, texts, library, size, end=2):
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` against every rule; the number of sequences."""
    want = []
    for text in texts:
        ids = [*library(text or ""), end]
        first = (len(ids) - 1) % size + 1
        cuts = [0, *range(first, len(ids) + 1, size)]
        want += [(n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert sorted(tuple(r)[1:5] for r in rows) == sorted(want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


@pytest.mark.parametrize("block", [8192, 16])
def test_documents_are_packed(spark, odd_docs, odd_rows, library, block):
    options = packing.Options(block=block)
    rows = packing.pack_documents(odd_docs, PATH, PATTERN, length=64, options=options).collect()
    n = checked(rows, [r[1] for r in odd_rows], library, 64)
    lengths = np.array([r.length for r in rows])
    assert n <= packing.fewest(lengths, 64) * 1.03 + 1
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, set()).add((r.piece, r.start, r.length))
    assert by_doc[0] == by_doc[1] == {(0, 0, 1)}


def test_pooling_joins_what_blocks_leave_open(spark):
    frame = spark.range(600).select(F.col("id").alias("item"), (F.col("id") % 7 + 3).alias("length"), F.lit("odd").alias("room"))
    options = packing.Options(block=20)
    placed = packing.pack(frame.drop("room"), 100, options).collect()
    bins = {}
    for r in placed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(placed) == 600 and all(sum(x for _, x in b) <= 100 for b in bins.values())
    assert all(o == sum(x for p, x in b if p < o) for b in bins.values() for o, _ in b)
    total = sum(r.length for r in placed)
    assert len(bins) <= -(-total // 100) + 4


def test_ids_null_ids_and_empty_tables(spark, no_docs, library):
    docs = spark.createDataFrame([(None, "some text here", "x", 1), (None, "some text here", "x", 1), (3, None, "y", 2)], "doc_id long, text string, item string, length int")
    rows = packing.pack_documents(docs, PATH, PATTERN, with_ids=True).collect()
    assert sorted(r.ids for r in rows) == sorted([np.array([*library(t), 2], "<u4").tobytes() for t in ("some text here", "some text here", "")])
    assert len({r.sequence_id for r in rows}) == 1
    assert packing.pack_documents(no_docs, PATH, PATTERN).count() == 0
    assert packing.pack_documents(no_docs, PATH, PATTERN).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
