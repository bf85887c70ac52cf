"""Vector codes against plain code: every part with every entry, in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from docmill.llm import vector_codes

KIND = "vec_id long, embedding array<float>, label string, code string, error int, part int"


def by_hand(rows, rounds=4, entries=256, parts=4):
    """``(vec_id, vector, label)`` of one length to sorted result rows."""
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(1024 * float(np.float32(x))) for x in v] for _, v, _ in good]
    step = len(whole[0]) // parts
    cut = [[v[p * step : (p + 1) * step] for p in range(parts)] for v in whole]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), e) for e, y in enumerate(books[p]))

    for _ in range(rounds):
        after = [list(b) for b in books]
        for p in range(parts):
            of = {}
            for v in cut:
                of.setdefault(nearest(p, v[p])[1], []).append(v[p])
            for e, xs in of.items():
                after[p][e] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
        books = after
    found = [[nearest(p, v[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, label), e in zip(good, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    text = hashlib.sha256(",".join(str(c) for b in books for y in b for c in y).encode()).hexdigest()
    return sorted(((i, "".join(f"{e:02x}" for _, e in f), err, by_label[label], text) for (i, _, label), f, err in zip(good, found, errors, strict=True)), key=repr)


def compressed(spark, rows):
    frame = spark.createDataFrame([(i, v, label, "odd", 7, 9) for i, v, label in rows], KIND).repartition(3)
    return sorted((tuple(r) for r in vector_codes.compress(frame).collect()), key=repr)


@pytest.mark.parametrize("leaf", [1, 2, 7])
@pytest.mark.parametrize("kind", ["spread", "clusters", "copies", "ties"])
def test_trees_find_the_nearest_entry(kind, leaf):
    r = np.random.default_rng(leaf)
    rows = {
        "spread": r.integers(-1000, 1000, (230, 3)),
        "clusters": r.integers(-9, 9, (230, 3)) + 1000 * r.integers(0, 5, (230, 1)),
        "copies": np.repeat(r.integers(-50, 50, (5, 3)), 46, axis=0),
        "ties": r.integers(0, 3, (230, 3)),
    }[kind]
    for k in (1, 2, 3, 61, 230):
        entries = rows[r.permutation(230)[:k]]
        book, tree = vector_codes.Book(entries), vector_codes.Tree.over(rows, leaf)
        code, counts, sums, settled = vector_codes.assign(tree, rows, book)
        near = ((rows[:, None] - entries[None]) ** 2).sum(2).argmin(1)
        assert (code == near).all()
        assert (counts == np.bincount(near, minlength=k)).all()
        assert all((sums[e] == rows[near == e].sum(0)).all() for e in range(k))
        if kind == "copies" or k == 1:
            assert settled <= 4 * 2 * leaf  # whole nodes by their cached sums, but for leaves with two kinds


def test_codes_equal_plain_code(spark):
    r = random.Random(3)
    rows = [(i, [r.gauss(0, 0.2) for _ in range(8)], r.choice(["a", "b", None])) for i in range(700)]
    rows += [(1000 + i, list(rows[i % 3][1]), "copies") for i in range(60)]
    rows += [(2000, None, "a"), (2001, [0.1] * 7 + [None], "a"), (2002, [0.1] * 7 + [math.nan], "b"), (2003, [math.inf] * 8, None), (2004, [0.0] * 8, None), (2005, [-0.0] * 8, "a")]
    rows += [(None, [0.25] * 8, None), (None, [0.5] * 8, "only"), (5, [0.125] * 8, "a"), (5, [0.125] * 8, "a")]
    assert compressed(spark, rows) == by_hand(rows)


def test_few_vectors_blocks_and_lengths(spark, monkeypatch):
    few = [(i, [float(i), 1.0, -2.0, 0.5], "x") for i in range(5)] + [(7, [0.0, 0.0, 0.0, 0.0], None)]
    assert compressed(spark, few) == by_hand(few)
    others = [(50, [1.0] * 5, "x"), (51, [], None), (52, [9.0], "y")]
    got = {r[0]: r for r in compressed(spark, few + others)}
    assert [got[i][1:3] for i in (50, 51, 52)] == [(None, None)] * 3
    assert {tuple(v) for k, v in got.items() if k < 50} == set(by_hand(few))
    assert got[51][3] == got[7][3] and got[52][3] is None
    monkeypatch.setattr(vector_codes, "BLOCK", 7)
    monkeypatch.setattr(vector_codes, "LEAF", 1)
    r = random.Random(5)
    rows = [(i, [r.random() for _ in range(4)], None) for i in range(400)]
    assert compressed(spark, rows) == by_hand(rows)


def test_empty_odd_widths_and_huge_components(spark):
    assert compressed(spark, []) == []
    assert compressed(spark, [(1, None, "a"), (2, [], "b")]) == [(2, None, None, None, hashlib.sha256(b"").hexdigest())]
    five = [(i, [0.1 * i, 0.2, 0.3, 0.4, 0.5], "a") for i in range(9)]
    assert [r[:4] for r in compressed(spark, five)] == [r[:4] for r in by_hand([(i, v + [0.0] * 3, label) for i, v, label in five])]
    held = vector_codes.largest(4) / 1024
    huge = [(1, [3e38, 1.0, 1.0, 1.0], "a"), (2, [-3e38, 1.0, 1.0, 1.0], "a")] + [(3 + i, [float(i), 0.0, 0.0, 0.0], "a") for i in range(300)]
    assert compressed(spark, huge) == by_hand([(i, [max(-held, min(held, x)) for x in v], label) for i, v, label in huge])
