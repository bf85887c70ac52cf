"""Operators over many rows against plain code: shards, mixes, near-duplicates, the pipeline."""

import math
import random
from collections import Counter
from hashlib import md5
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from docmill.llm import mixing, ngram_join, product_quantisation, resharding
from docmill.llm.shared import components


def groups(nodes, links):
    part = {n: n for n in nodes}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        part[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    r = random.Random(1)
    links = [(0, i) for i in range(1, 300)] + [(1000 + i, 1001 + i) for i in range(40)] + [(r.randrange(2000, 2200), r.randrange(2000, 2200)) for _ in range(150)] + [(5000, 5000), (5001, 5002), (5002, 5001)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long"), "test").collect()))
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == groups(nodes, [x for x in links if x[0] != x[1]])
    assert components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


def test_least_cost_flow_equals_trying_all():
    r = random.Random(2)
    for _ in range(40):
        supply = [r.randint(0, 4) for _ in range(2)]
        total = sum(supply)
        first = r.randint(0, total)
        second = r.randint(0, total - first)
        demand = [first, second, total - first - second]
        cost = [[r.randint(0, 5) for _ in range(3)] for _ in range(2)]
        flow = resharding.least_cost_flow(supply, demand, cost)
        assert [sum(x) for x in flow] == supply and [sum(x[j] for x in flow) for j in range(3)] == demand
        best = min(
            sum(c * x for c, x in zip(cost[0] + cost[1], row + tuple(d - x for d, x in zip(demand, row, strict=True)), strict=True))
            for row in product(*(range(d + 1) for d in demand))
            if sum(row) == supply[0]
        )
        assert sum(c * x for cs, xs in zip(cost, flow, strict=True) for c, x in zip(cs, xs, strict=True)) == best


def test_resharding(spark, odd_docs, odd_rows, no_docs):
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")).alias("text"), (F.col("id") % 3 == 0).alias("source"))
    old = F.when(F.col("source"), 0).otherwise(F.col("doc_id") % 5)
    rows = resharding.sized(many, old)
    plan = resharding.planned(rows, 8)
    sizes = Counter()
    for r in rows.groupBy("old_shard").agg(F.sum("size").alias("n")).collect():
        sizes[r.old_shard] = r.n
    total = sum(sizes.values())
    least = sum(max(0, n - total / 8) for n in sizes.values())
    assert plan.moved_bytes < 1.02 * least + 90
    got = resharding.reshard(many, old, 8).collect()
    assert sorted(r.doc_id for r in got) == list(range(4000))
    by_shard = {j: [r for r in got if r.shard == j] for j in range(8)}
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by_shard.values())
    assert all(abs(sum(r["size"] for r in x) - total / 8) < 0.01 * total for x in by_shard.values())
    odd = resharding.reshard(odd_docs.select("doc_id", "text", "source"), F.lit(3), [1, 1])
    facts = sorted((r.doc_id, r["size"]) for r in odd.collect())
    assert facts == sorted((i, len((t or "").encode()) + 1) for i, t, *_ in odd_rows)
    assert resharding.reshard(no_docs.select("doc_id", "text"), F.lit(0), 4).count() == 0


def test_a_plan_without_moves_rewrites_nothing(spark):
    docs = spark.createDataFrame([(i, "x") for i in range(8)], "doc_id long, text string")
    rows = resharding.sized(docs, F.col("doc_id") % 2)
    plan = resharding.planned(rows, 2)
    assert plan.moved_bytes == 0 and plan.affected == []
    assert resharding.rewritten(rows, plan).count() == 8


def mix_by_hand(rows, weights, seed):
    import re

    facts, sizes = [], Counter()
    for i, t, _, s, _ in rows:
        n = len((t or "").encode().split())
        u = (int(md5(f"{seed}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        w = max(0.05, len(re.sub("[^a-z]+", "", t)) / len(t)) if t else 0.05
        facts.append((i, s, n, -math.log(u) / w))
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    held, total = set(), sum(sizes.values())
    while True:
        free = [s for s in order if s not in held]
        level = (total - sum(3 * sizes[s] for s in held)) / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            break
        held |= over
    target = {s: 3 * sizes[s] if s in held else level * weight[s] for s in order}
    out = []
    for s in order:
        epochs = min(3, int(target[s] / sizes[s])) if sizes[s] else 0
        rest, upto = target[s] - epochs * sizes[s], 0
        for key, i, n in sorted((k, i, n) for i, x, n, k in facts if x == s):
            upto += n
            out.append((i, s, key, n, epochs, n > 0 and 2 * upto - n <= 2 * rest))
    return target, out


@pytest.mark.parametrize("weights", [(5, 2, 1), (40, 1), (1,)])
def test_mixing(odd_docs, odd_rows, weights, no_docs):
    target, want = mix_by_hand(odd_rows, weights, 11)
    got = mixing.mix(odd_docs, weights).collect()
    assert len(got) == len(odd_rows)
    cut = {}
    for i, s, key, n, _, chosen in want:
        if chosen:
            cut[s] = max(cut.get(s, (0, 0, 0)), (key, i, n))
    by = {(i, s): (key, n, epochs) for i, s, key, n, epochs, _ in want}
    for r in got:
        key, n, epochs = by[r.doc_id, r.source]
        assert math.isclose(r.target, target[r.source], rel_tol=1e-12) and r["size"] == n
        assert r.taken == n * epochs + (n if n and r.source in cut and (key, r.doc_id, n) <= cut[r.source] else 0)
        assert r.taken <= 3 * n
    assert mixing.mix(no_docs).count() == 0
    times = Counter(r.doc_id for r in mixing.repeated(mixing.mix(odd_docs, weights)).collect())
    whole = Counter()
    for r in got:
        if r.taken:
            whole[r.doc_id] += r.taken // r["size"]
    assert times == whole


def test_vectors(spark):
    r = np.random.default_rng(3)
    rows, n = [], 0
    for label in (0, 1, 2, None):
        for _ in range(60):
            base = r.normal(size=16)
            for noise in (0, 0, 0.02, 0.06, 0.09, 0.12):
                rows.append((n, (base + noise * r.normal(size=16)).tolist(), label))
                n += 1
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * 16, 1), (n + 3, [float("nan")] * 16, 1), (n + 4, [None, 1.0], 1), (n + 5, [float("inf"), 1.0], 1), (n + 6, [1.0, 2.0], 1), (n + 7, [2.0, 4.0], 1), (n + 8, [1e300, 2e300], 1)]
    rows.append(rows[0])
    good = [(i, np.array(v), lab) for i, v, lab in rows if lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, n_links = [], Counter()
    for i in range(len(good)):
        for j in range(i):
            (a, x, p), (b, y, q) = good[i], good[j]
            if p == q and len(x) == len(y):
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links.append((a, b))
                    n_links[a] += 1
                    n_links[b] += 1
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n", F.lit("odd")).repartition(3)
    got = product_quantisation.near_duplicates(frame, options=product_quantisation.Options(list_length=8)).collect()
    assert len(got) == len(rows)
    want = groups([i for i, *_ in rows], links)
    found = sum(r.n_links for r in got if r.vec_id) / sum(v for k, v in n_links.items() if k)
    assert 0.97 <= found <= 1
    assert sum(r.component_id == want[r.vec_id] for r in got) >= 0.97 * len(rows)
    assert all(r.n_links <= n_links[r.vec_id] and r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id)
    assert all(r.n_links == 0 for r in got if n <= r.vec_id < n + 6)
    assert {r.vec_id: r.component_id for r in got if r.vec_id >= n + 6} == {n + 6: n + 6, n + 7: n + 6, n + 8: n + 6}
    assert product_quantisation.near_duplicates(frame.where("vec_id < 0")).count() == 0


def test_vectors_without_an_id_and_of_many_lengths(spark):
    near = [1.0, 0.01, 0.0]
    rows = [(None, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0, 0.0], 1), (None, near, 2), (7, [1.0, 0.0, 0.0], 2), (None, [0.0, 5.0, 0.0], 3)]
    rows += [(8, [1.0] * 3000, 4), (9, [1.0] * 2999 + [1.01], 4), (10, [1.0] * 3, 4), (None, None, 4)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = product_quantisation.near_duplicates(frame).collect()
    found = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got)
    assert found == Counter({(None, 1, None, True): 2, (None, 1, 7, False): 1, (7, 1, 7, True): 1, (None, 0, None, True): 2, (8, 1, 8, True): 1, (9, 1, 8, False): 1, (10, 0, 10, True): 1})
    only = product_quantisation.near_duplicates(frame.where("vec_id IS NULL AND label = 1")).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in only] == [(None, 1, None, True)] * 2


def test_table_distances_and_errors():
    r = np.random.default_rng(1)
    points = r.normal(size=(500, 16))
    points /= np.linalg.norm(points, axis=1)[:, None]
    index = product_quantisation.Index(points, 9, product_quantisation.Options())
    cells = index.cells(points, 4)
    assert (cells[:, 0] >= 0).all()
    cell = int(cells[0, 0])
    there = np.flatnonzero(cells[:, 0] == cell)
    codes, error = index.encode(points[there], cells[there, 0])
    far = np.sqrt(np.maximum(index.distances(points, cell, codes), 0))
    true = np.linalg.norm(points[:, None] - points[there][None], axis=2)
    assert (far <= true + error + 1e-6).all() and (far >= true - error - 1e-6).all()


def test_rows_without_an_old_shard_move(spark):
    docs = spark.createDataFrame([(i, "x" * 9, None if i % 3 else i % 2) for i in range(90)], "doc_id long, text string, at int")
    rows = resharding.reshard(docs, F.col("at"), 2).collect()
    assert sorted(r.doc_id for r in rows) == list(range(90))
    assert {r.old_shard for r in rows} == {resharding.NO_SHARD, 0, 1}
    for shard in (0, 1):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(45))
    assert all(r.shard == r.old_shard for r in rows if r.old_shard >= 0)
    none = resharding.reshard(docs, F.lit(None).cast("int"), 2).collect()
    assert len(none) == 90 and {r.old_shard for r in none} == {resharding.NO_SHARD}


def join_by_hand(rows, words, percent):
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    part = groups(ids, links)
    return {i: (len(sets[i]), part[i]) for i in ids}


def test_late_keys_make_no_guests(spark):
    rows = [(1, 0, 4, "early", 100), (1, 8, 4, "edge", 100), (1, 9, 4, "late", 100), (1, 14, 4, "last", 100)]
    placed = ngram_join.tiles(spark.createDataFrame(rows, "key long, rank int, m long, name string, n long"), 85).collect()
    homes, guests = ({r.name for r in placed if r.home is home} for home in (True, False))
    assert homes == {"early", "edge", "late", "last"} and guests == {"early", "edge"}
    # With n = 100 and 85 % a smaller set shares at least 92 shingles from its first shared key on.
    assert {r.band for r in placed if not r.home} == {r.band + 1 for r in placed if r.home}


def test_no_guests_of_bands_that_a_key_has_not(spark):
    """Bands of 85 %: 100 shingles are in band 26, 120 in band 27, 80,000 in band 64 and 100,000 in band 66."""
    key = lambda k, sizes: [(k, 0, len(sizes), n, n, sum({1 << b % 64 for _, b in sizes}) - (1 << 64) * any(b % 64 == 63 for _, b in sizes)) for n, _ in sizes]
    rows = key(1, [(100, 26)]) + key(2, [(100, 26), (120, 27)]) + key(3, [(70_000, 63), (80_000, 64)]) + key(4, [(100, 26), (100_000, 66)])
    placed = ngram_join.tiles(spark.createDataFrame(rows, "key long, rank int, m long, name long, n long, held long"), 85).collect()
    assert {(r.key, r.n, r.band) for r in placed if r.home} == {(1, 100, 26), (2, 100, 26), (2, 120, 27), (3, 70_000, 63), (3, 80_000, 64), (4, 100, 26), (4, 100_000, 66)}
    assert {(r.key, r.n, r.band) for r in placed if not r.home} == {(2, 100, 27), (3, 70_000, 64)}



@pytest.mark.parametrize("tile,common", [(512, 64), (3, 2)])
@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80), (1, 60)])
def test_ngram_join(odd_docs, odd_rows, tile, common, words, percent, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", tile)
    monkeypatch.setattr(ngram_join, "COMMON", common)
    monkeypatch.setattr(ngram_join, "COUNTED", 2)
    got = ngram_join.join(odd_docs, ngram_join.Options(words=words, percent=percent)).collect()
    want = join_by_hand(odd_rows, words, percent)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((i, *want[i]) for i, *_ in odd_rows)


@pytest.mark.parametrize("tile", [512, 3])
def test_every_link_of_a_document_is_counted(odd_docs, odd_rows, tile, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", tile)
    sets = []
    for i, t, *_ in odd_rows:
        w = (t or "").encode().lower().split()
        sets.append((i, {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()))
    want = []
    for k, (i, a) in enumerate(sets):
        want.append((i, sum(bool(a) and 100 * len(a & b) >= 85 * len(a | b) for m, (_, b) in enumerate(sets) if m != k)))
    got = ngram_join.with_links(odd_docs)
    parts = join_by_hand(odd_rows, 4, 85)
    rows = got.collect()
    assert sorted((r.doc_id, r.n_links) for r in rows) == sorted(want)
    assert all((r.n_shingles, r.component_id) == parts[r.doc_id] for r in rows)
    assert max(n for _, n in want) >= 5


def test_a_shared_passage_makes_no_pairs(spark, monkeypatch):
    """Documents that share one passage and nothing else, more of them than a common shingle is found in."""
    made = []
    plain = ngram_join.open_pairs

    def noted(rows, percent, few):
        out = plain(rows, percent, few)
        if not few:
            made.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "open_pairs", noted)
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [(d, f"{' '.join(f'w{d}x{i}' for i in range(900))} {passage} {' '.join(f'v{d}x{i}' for i in range(900))}") for d in range(60)]
    rows += [(100, rows[3][1] + " one more"), (101, rows[3][1] + " another")]
    got = {r.doc_id: r.component_id for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: 3 if d >= 100 else d for d, _ in rows}
    assert made[0] <= 60  # 1,770 pairs share the passage


def test_one_of_each(odd_docs, odd_rows, no_docs):
    want = join_by_hand(odd_rows, 5, 80)
    got = ngram_join.one_of_each(odd_docs, ngram_join.Options(words=5, percent=80))
    assert got.columns == odd_docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i, (_, part) in want.items() if i == part)
    assert ngram_join.join(no_docs).count() == 0


def test_pipeline(spark, odd_docs, tmp_path):
    import corpus_pipeline

    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
        path = str(tmp_path / name.replace(" ", "-"))
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    assert 0 < docs.count()
    done = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert len(done) == docs.count() and all(len(r.ids) == 4 * r.n_tokens for r in done)
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(r.ids_sha256 for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted(r.ids_sha256 for r in done)
