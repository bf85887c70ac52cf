"""Operators on single texts against plain code: language model, rules, tokens, personal data, classes."""

import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from docmill.llm import byte_bpe, lm_scoring, pii, quality_classifier, quality_rules, warc
from docmill.llm.textops import Hasher, bytes_of, counts_of

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def split(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def test_words_and_hashes():
    texts = ["a b  c", None, "", "x", "  y z\n", "\t", "é à\x0bb A a", "q" * 600_000 + " z", "A B"]
    data, offsets = bytes_of(pa.array(texts))
    starts, ends, hashes = Hasher(lower=True).words(data, offsets)
    want = [w for t in texts for w in split(t)]
    assert [bytes(data[a:b]) for a, b in zip(starts, ends, strict=True)] == want
    names = {}
    assert all(names.setdefault(w.lower(), h) == h for w, h in zip(want, hashes.tolist(), strict=True))
    assert len(set(names.values())) == len(names)
    assert counts_of(starts, offsets).tolist() == [len(split(t)) for t in texts]


def test_language_model(spark, odd_docs, odd_rows, no_docs):
    counts = Counter()
    for i, t, *_ in odd_rows:
        if zlib.crc32(str(i).encode()) % 10:
            counts.update([*split(t, True), None])
    total, types = sum(counts.values()), len(counts)
    got = lm_scoring.score_texts(odd_docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in odd_rows)
    by_id = {r.doc_id: r for r in got}
    for i, t, *_ in odd_rows:
        tokens, r = [*split(t, True), None], by_id[i]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in tokens)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[w] > 0 for w in tokens), total)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 10 == 0) and math.isfinite(r.score) and r.score < 0
    assert lm_scoring.score_texts(no_docs).count() == 0


def test_language_model_learns_from_context(spark):
    r = random.Random(8)
    tongues = [[f"{c}{k}" for k in range(60)] for c in "abcd"]
    rows = [(i, " ".join(r.choice(tongues[i % 4]) for _ in range(150))) for i in range(600)]
    got = lm_scoring.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).where("held_out").collect()
    assert sum(x.score for x in got) > sum(x.base_score for x in got)


def test_language_model_probabilities_sum_to_one(spark):
    model = lm_scoring.Model.start(np.arange(lm_scoring.SYMBOLS, dtype=float), 8)
    near, far = model.tables()
    log_z = lm_scoring.normalisers(spark, model)
    for a, b in ((0, 0), (5, 900), (lm_scoring.END, 17)):
        assert math.isclose(np.exp(near[b] + far[a] - log_z[a, b]).sum(), 1, rel_tol=1e-4)
    counts = np.array([5.0, 3.0, 1.0])
    vocab = lm_scoring.Vocabulary(9, 3, np.zeros(3, np.uint64), counts, np.zeros(lm_scoring.SYMBOLS), np.array([9.0]), np.array([1.0]), 0)
    known = 10 ** vocab.in_bucket(counts, np.zeros(3, int))
    assert math.isclose(known.sum() + vocab.unknown_share()[0], 1, rel_tol=1e-9)


def test_trees_give_probabilities():
    r = np.random.default_rng(5)
    for n in (1, 2, 5, 8, 13):
        counts = r.integers(1, 9, n).astype(float)
        tree, every = lm_scoring.Tree(counts, 4), np.arange(n)
        assert np.allclose(tree.gain(np.repeat([[0, 0, 0, 0, 1]], n, axis=0).astype(np.float32), every), 0, atol=1e-5)
        tree.units[:] = r.normal(size=tree.units.shape)
        hidden = np.repeat(np.append(r.normal(size=(1, 4)), [[1]], axis=1).astype(np.float32), n, axis=0)
        assert math.isclose((np.exp(tree.gain(hidden, every)) * counts / counts.sum()).sum(), 1, rel_tol=1e-5)


def test_tree_steps_are_those_of_single_nodes():
    """Bands of levels, levels one by one, and many leaves below a node of any level."""
    r = np.random.default_rng(6)
    for n, tokens in ((1, 9), (2, 40), (40, 500), (300, 70), (3000, 900), (3000, 4096)):
        counts = r.integers(1, 9, n).astype(float)
        tree = lm_scoring.Tree(counts, 4)
        tree.units[1:] += r.normal(size=tree.units[1:].shape).astype(np.float32)
        leaves = np.sort((r.random(tokens) ** 3 * n).astype(np.int64))
        hidden = r.normal(size=(tokens, 5)).astype(np.float32)
        units, seen, visits = tree.units.astype(float), tree.seen.astype(float), np.zeros(len(tree.visits))
        sums = np.zeros(units.shape)
        for h, leaf in zip(hidden.astype(float), leaves.tolist(), strict=True):
            for level in range(tree.depth):
                node, right = (1 << level) + (leaf >> (tree.depth - level)), leaf >> (tree.depth - level - 1) & 1
                visits[node] += 1
                if tree.live[node]:
                    sums[node] += h * ((1 - right) - 1 / (1 + math.exp(-(h @ units[node]))))
        sums /= np.sqrt(np.maximum(visits, 1))[:, None]
        seen += sums * sums
        tree.step(hidden, leaves, 0.1)
        assert (tree.visits == visits).all()
        assert np.allclose(tree.units, units + 0.1 * sums / np.sqrt(seen), atol=1e-4)
        gains = tree.gain(hidden, leaves)
        for i in range(0, tokens, 7):
            total = -math.log(counts[leaves[i]] / counts.sum())
            for level in range(tree.depth):
                (node,), (right,) = tree.at(level, leaves[i : i + 1])
                if tree.live[node]:
                    total -= math.log1p(math.exp((hidden[i] @ tree.units[node]) * (1 if right else -1)))
            assert math.isclose(gains[i], total, abs_tol=1e-3)


@pytest.mark.parametrize("size", [5, 8])
def test_language_model_steps(size):
    """One step against sums over tokens and symbols in plain code."""
    r = np.random.default_rng(7)
    counts = r.integers(0, 50, lm_scoring.SYMBOLS).astype(float)
    share = (counts + 0.5) / (counts + 0.5).sum()
    model = lm_scoring.Model.start(counts, size)
    trainer = lm_scoring.Trainer(model, share, 0.1, 6, seed=3)
    far, near, word = r.integers(0, 20, (3, 64))
    noise = np.minimum(np.searchsorted(np.cumsum(share), np.random.default_rng(3).random(6) * np.cumsum(share)[-1]), lm_scoring.SYMBOLS - 1)
    trainer.step(far, near, word)
    old = {k: getattr(model, k).astype(float) for k in model.NAMES}
    g = {k: np.zeros(v.shape) for k, v in old.items()}
    for a, b, w in zip(far, near, word, strict=True):
        hidden, back = old["context"][b] @ old["near"] + old["context"][a] @ old["far"], np.zeros(size)
        for symbol, true in [(w, 1), *[(x, 0) for x in noise]]:
            score = hidden @ old["target"][symbol] + old["bias"][symbol] - math.log(share[symbol] * 6)
            up = true - 1 / (1 + math.exp(-score))
            g["target"][symbol] += up * hidden
            g["bias"][symbol] += up
            back += up * old["target"][symbol]
        g["context"][b] += old["near"] @ back
        g["context"][a] += old["far"] @ back
        g["near"] += np.outer(old["context"][b], back)
        g["far"] += np.outer(old["context"][a], back)
    for k in model.NAMES:
        step = g[k] / math.sqrt(64)
        assert np.allclose(getattr(trainer.m, k), old[k] + 0.1 * step / np.sqrt(0.1 + step * step), atol=1e-5), k


def test_keys_by_bucket():
    r = np.random.default_rng(9)
    for n in (0, 1, 2, 5000):
        keys = r.integers(0, 1 << 63, max(n // 4, 1), dtype=np.uint64)[r.integers(0, max(n // 4, 1), n)] * np.uint64(2)
        assert (lm_scoring.by_bucket(keys) == np.lexsort((np.arange(n), keys, lm_scoring.bucket_of(keys)))).all()


@pytest.mark.parametrize("most, part_tokens", [(5, 1 << 22), (40, 4), (1 << 18, 1 << 22)])
def test_language_model_with_few_words_sent(spark, most, part_tokens, monkeypatch):
    """Counts of words beyond the broadcast ones come with their trees, without a join of their own."""
    monkeypatch.setattr(lm_scoring, "BROADCAST_WORDS", most)
    monkeypatch.setattr(lm_scoring, "PART_TOKENS", part_tokens)
    r = random.Random(most)
    rows = [(i, " ".join(f"{r.choice('Ab')}{int(r.random() ** 4 * 60)}z" for _ in range(i % 13))) for i in range(60)] + [(7, "once a0z a0z"), (8, None), (9, "")]
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 10:
            counts.update([*split(t, True), None])
    total, types = sum(counts.values()), len(counts)
    found = lm_scoring.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert len(re.findall(r"\b\w*Join\b", found._jdf.queryExecution().optimizedPlan().toString())) == 1
    got = found.collect()
    expected = []
    for i, t in rows:
        tokens = [*split(t, True), None]
        expected.append((i, len(tokens), sum(counts[w] > 0 for w in tokens), round(sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in tokens), 9)))
    assert sorted((x.doc_id, x.n_tokens, x.n_known, round(x.base_score, 9)) for x in got) == sorted(expected)
    assert all(math.isfinite(x.score) and x.score < 0 for x in got)


@pytest.mark.parametrize("part_tokens", [1 << 22, 1500])
def test_rare_words_follow_their_contexts(spark, part_tokens, monkeypatch):
    """Words that share a symbol, each after one of two cues; half of the held-out texts have the cues swapped."""
    monkeypatch.setattr(lm_scoring, "PART_TOKENS", part_tokens)
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    fill = [f"f{k}q{k % 90 + 10}" for k in range(lm_scoring.WORDS - 2)]
    rows = [(i, " ".join(fill * 2)) for i in range(100_000, 100_040)]
    for i in range(1600):
        swapped = held(i) and i % 2
        words = [(i * 7 + k * 3) % 60 for k in range(20)]
        rows.append((i, " ".join(f"{'ab'[w % 2 ^ swapped] * 2}cue r{w}zz" for w in words)))
    got = lm_scoring.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).where("held_out AND doc_id < 100000").collect()
    per = [[x.score for x in got if x.doc_id % 2 == odd] for odd in (0, 1)]
    assert sum(per[0]) / len(per[0]) > sum(per[1]) / len(per[1]) + 2


def test_context_symbols():
    pack = lambda *x: np.array(x, np.int16).tobytes()
    far, near, word, n = lm_scoring.contexts([pack(1, 2, 3), pack(), pack(7)])
    end = lm_scoring.END
    assert far.tolist() == [end, end, 1, 2, end, end, end]
    assert near.tolist() == [end, 1, 2, 3, end, end, 7]
    assert word.tolist() == [1, 2, 3, end, end, 7, end]
    assert n.tolist() == [4, 1, 2]


def rules_by_hand(rows, limits):
    norm = lambda line: tuple(w.translate(quality_rules.ZEROS) for w in line.encode().split())
    lines = {}
    for i, t, _, s, _ in rows:
        for line in (t or "").split("\n"):
            lines.setdefault((s, norm(line)), set()).add((i, "" if i is not None else t))
    out = []
    for i, t, _, s, _ in rows:
        t, words = t or "", split(t)
        marked = set()
        seen = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        for k in range(len(words) - 7):
            if seen[tuple(words[k : k + 8])] > 1:
                marked |= set(range(k, k + 8))
        full = [x for x in t.split("\n") if x.encode().strip()]
        gone = 0
        for x in t.split("\n"):
            n = len(lines[s, norm(x)])
            if norm(x) and n > limits.documents:
                gone += len(norm(x))
        failed = len(words) < limits.words or 100 * len(marked) > limits.repeated_percent * len(words)
        chars = sum(len(w.decode()) for w in words)
        out.append((i, len(words), chars, len(re.findall(r"[#*$%&|<>]", t)), len(full) - len(set(full)), len(marked), gone, failed, not failed and len(words) - gone >= limits.remaining * len(words)))
    return sorted(out)


@pytest.mark.parametrize("sent", [True, False])
def test_quality_rules(odd_docs, odd_rows, no_docs, sent, monkeypatch):
    if not sent:
        monkeypatch.setattr(quality_rules, "BROADCAST_LINES", -1)
    limits = quality_rules.Limits(documents=1)
    done = quality_rules.apply_rules(odd_docs, limits=limits)
    assert done.columns.count("kept") == 1 and "size" in done.columns
    got = sorted(tuple(r) for r in done.select("doc_id", *list(quality_rules.RESULTS)[:-1]).collect())
    assert got == rules_by_hand(odd_rows, limits)
    texts = {r.doc_id: (r.text, r.cleaned, r.n_removed_words) for r in done.collect()}
    assert any(n for *_, n in texts.values())
    assert all((a is None) == (b is None) and (n or a == b) for a, b, n in texts.values())
    assert all(len(split(a)) - len(split(b)) == n for a, b, n in texts.values())
    assert quality_rules.apply_rules(no_docs).count() == 0


def test_copies_lift_a_line_over_the_limit_of_any_host(spark):
    body = " ".join(f"word{i}" for i in range(40))
    rows = [(i, f"{body} {i // 21}\nfooter of a page", "a" if i < 21 else "b") for i in range(41)]
    rows += [(100 + i, " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}{k}" for k in range(30)), "a") for i in range(2000)] + [(None, "no id at all " * 3, "c")] * 30 + [(7, rows[7][1], "a")] * 5
    docs = spark.createDataFrame([(*r, True, "odd") for r in rows], "doc_id long, text string, source string, Kept boolean, CLEANED string").repartition(3)
    done = quality_rules.apply_rules(docs, limits=quality_rules.Limits(documents=20, words=5, repeated_percent=100))
    assert [c.lower() for c in done.columns].count("kept") == 1
    lost = {r.doc_id for r in done.where("n_removed_words > 0").collect()}
    assert lost == set(range(21))
    assert done.where("kept AND source = 'b'").count() == 20 and done.where("kept AND source = 'a'").count() == 2000
    assert done.where("kept AND doc_id IS NULL").count() == 30


def test_tokens_equal_the_library():
    ranks = byte_bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder, decoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN), byte_bpe.Decoder(ranks)
    r = random.Random(5)
    parts = [" ", "\n", "a", "é", "the", "ing", " un", "'s", "23", "!", "\t", "　", "中", "🙂", "ion", "  ", "\x1c", "Ω", "don't"]
    texts = ["", " a\n\nb ", "x" * 4000, "é" * 500, "a\x1cb \x1c c", "🙂🙃   x", "\x00\x7f", "the thing. " * 50]
    texts += ["".join(r.choice(parts) for _ in range(r.randint(1, 40))) for _ in range(1500)]
    texts += [" ".join("".join(r.choice("ertionahwsdl") for _ in range(r.randint(1, 14))) for _ in range(200)) for _ in range(20)]
    for text in texts:
        ids = encoder(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), text
        assert "".join(decoder(ids, 3)) == text


def test_tables_of_the_transducer_may_be_begun_anew(monkeypatch):
    monkeypatch.setattr(byte_bpe, "STATES", 20)
    monkeypatch.setattr(byte_bpe, "PIECES", 5)
    ranks = byte_bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    text = "Threst stblees tiones thretion, ansheable thst eantea; thonst " * 3
    assert np.frombuffer(encoder(text), "<u4").tolist() == library.encode_ordinary(text)


def test_decoding_holds_back_unfinished_characters():
    decoder = byte_bpe.Decoder(byte_bpe.read_ranks(RANKS))
    byte = {b: i for i, b in enumerate(decoder.bytes_of) if len(b) == 1}
    ids = lambda data: np.array([byte[bytes([x])] for x in data])
    smile = "🙂".encode()
    assert [decoder.push(ids(smile[:2])), decoder.push(ids(smile[2:] + b"a"))] == ["", "🙂a"]
    assert decoder.push(ids(b"a\xc3")) == "a" and decoder.finish() == "�"
    assert decoder.push(ids(b"\xff\xe2\x82")) == b"\xff\xe2\x82".decode("utf-8", "replace")
    assert decoder.push(ids(b"ok")) == "ok"
    for code in (*range(0x80, 0x900, 7), 0xD7FF, 0xE000, 0xFFFF, 0x10000, 0x10FFFF):
        assert decoder.run(decoder.WHOLE, chr(code).encode()) == decoder.WHOLE
    for bad in (b"\xc0\x80", b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b"\x80", b"\xe0\x80\x80"):
        assert decoder.run(decoder.WHOLE, bad) is None


def test_token_digests(odd_docs, odd_rows, no_docs):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    want = []
    for i, t, *_ in odd_rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, byte_bpe.digests(odd_docs, RANKS, public_tokenizers.PATTERN).collect())) == sorted(want)
    back = byte_bpe.decode_ids(byte_bpe.encode_texts(odd_docs, RANKS, public_tokenizers.PATTERN), RANKS)
    assert Counter(map(tuple, back.collect())) == Counter((r[0], r[1] or "") for r in odd_rows)
    assert byte_bpe.digests(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


PLAIN = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def spans_by_hand(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if (True, kind == 1 and all(int(x) <= 255 for x in m.group().split(".")), 12 <= len(digits) <= 19 and pii.luhn(digits), 9 <= len(digits) <= 15)[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_patterns_equal_plain_search():
    r = random.Random(9)
    parts = ["1", "2", "0", "9", "a", "@", "@", ".", ".", "-", "+", "(", ")", " ", " ", "é", "12", "255", "256", "4111111111111111", "_", "\n", "x@y.z", "10.0.0.1"]
    for _ in range(20_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(1, 25)))
        assert pii.patterns(text)[0] == spans_by_hand(text), text
    assert pii.patterns("1" * 200_000 + "." * 10)[0] == [] and pii.patterns("a" * 200_000 + "@")[0] == []


@pytest.fixture(scope="module")
def field():
    return pii.Field()


def found(field, text, reach):
    batch = pa.record_batch([pa.array([text])], ["text"])
    return pii.joined(next(iter(pii.each_text(iter([batch]), field, reach)))[1][0][2])


def test_the_field_adds_forms_the_patterns_miss(field):
    assert field.reach() is not None
    cases = {
        "see (415) 555-0123 now": "phone:4:18",
        "é mail bob@host and 415-555-0199.": "email:7:15,phone:20:32",
        "nothing 12 13 AKIAX7ZQ12MNB45 password=123abc99ff 2024-01-02 version 4.0.": "",
        "card 4111 1111 1111 1112 fails its check": "",
        "+1 (988) 555-2485": "phone:0:17",
    }
    for text, want in cases.items():
        assert found(field, text, field.reach()) == want


def test_skipping_plain_words_keeps_the_best_path(field):
    r = random.Random(2)
    parts = ["word", "the", "(415)", "555-0123", "12", "a@b", "10.0.0.300", "x", "call", "4.5/5", "+1", "é", "9f86d0", "415-555-0101"]
    for _ in range(400):
        text = " ".join(r.choice(parts) if r.random() < 0.3 else r.choice(["plain", "words", "only,"]) for _ in range(r.randint(1, 40)))
        assert found(field, text, field.reach()) == found(field, text, None), text


def test_viterbi_equals_all_paths(field):
    from itertools import product

    r = np.random.default_rng(4)
    scores = r.normal(size=(6, 4, len(pii.LABELS)))
    lengths = np.array([4, 3, 2, 1, 4, 3])
    got = field.best(scores, lengths)
    for i, n in enumerate(lengths):
        score = lambda path, i=i: sum(scores[i, t, y] for t, y in enumerate(path)) + sum(field.pairs[a, b] for a, b in zip((0, *path), (*path, 0), strict=True))
        assert tuple(got[i, :n]) == max(product(range(len(pii.LABELS)), repeat=int(n)), key=score)


def test_personal_data(spark, odd_docs, odd_rows, no_docs):
    for r in pii.find(odd_docs).collect():
        base = spans_by_hand(next(t or "" for i, t, *_ in odd_rows if i == r.doc_id))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in base) for kind in range(4)]
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert set(filter(None, pii.joined(base).split(","))) <= set(r.spans.split(","))
    docs = spark.createDataFrame([(1, "é a.b@c.de, 10.0.0.1!", 5), (2, None, 6), (3, "", 7)], "doc_id long, text string, size long")
    assert sorted(map(tuple, pii.redacted(docs).collect())) == [(1, "é <email>, <ip>!", 5), (2, None, 6), (3, "", 7)]
    assert pii.find(no_docs).count() == 0


def test_classifier(spark, odd_docs, no_docs):
    r = random.Random(3)
    good, bad = ["river", "stone", "meadow", "cloud", "walk"], ["BUY!!", "NOW!!", "CLICK!!", "WIN!!", "CASH!!"]
    rows = [(i, " ".join(r.choice(bad if i % 3 == 0 else good) + r.choice(["", "s", "ed"]) for _ in range(40)), int(i % 3 != 0)) for i in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (5, None), (99999, 0)], "doc_id long, quality int")
    got = quality_classifier.classify(docs, labels).collect()
    assert len(got) == 300
    held = [x for x in got if x.held_out]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in got)
    assert sum(x.predicted == rows[x.doc_id][2] for x in held) >= 0.95 * len(held)
    odd = quality_classifier.classify(odd_docs, labels)
    assert odd.count() == odd_docs.count() and all(0 <= x.score <= 1 for x in odd.collect())
    assert quality_classifier.classify(no_docs, labels).count() == 0
    assert all(x.score == 0.5 or 0 <= x.score <= 1 for x in quality_classifier.classify(docs.limit(3), labels.where("quality > 5")).collect())


def test_subword_rows_of_a_text_do_not_depend_on_its_neighbours():
    features = quality_classifier.Features()
    one = quality_classifier.bags(features, *bytes_of(pa.array(["ab cd cd", "héllo wörld x"])))
    two = quality_classifier.bags(features, *bytes_of(pa.array(["zzz", None, "ab cd cd", "", "héllo wörld x", " "])))
    for a, b in ((one[0], two[2]), (one[1], two[4])):
        assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()
    assert two[1][0].size == 0 and quality_classifier.REPEATED in one[0][0]


def test_archives(spark):
    long = "<p>" + "x" * 200 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n</p>"
    rows = [(1, "http://a.example/x?y", long), (2, "http://b.example", long), (3, None, None), (4, "http://c/\r\nz", "small"), (5, "u", "small"), (7, "é", "é" * 80), (6, "é", "é" * 80), (None, "n", long), (1, "http://a.example/x?y", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    got = Counter(map(tuple, warc.captures(warc.read_records(spark, warc.write_archives(pages))).collect()))
    first = {long: 1, "é" * 80: 6}
    want = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and page != first[html]
        want[page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[html] if again else None] += 1
    assert got == want
    assert warc.captures(warc.read_records(spark, warc.write_archives(pages.where("page_id > 90")))).count() == 0


def test_records_gzipped_one_by_one(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nhello\r\n\r\nthere"
    head = lambda kind, n, more="": f"WARC/1.0\r\nWARC-Type: {kind}\r\n{more}Content-Length: {n}\r\n\r\n".encode()
    records = [
        head("warcinfo", 3) + b"x:y",
        head("response", len(block), "WARC-Record-ID: <a>\r\ncontent-type: application/http\r\n") + block,
        head("request", 4, "WARC-Record-ID: <b>\r\nWARC-Concurrent-To: <a>\r\n") + b"GET\n",
        head("metadata", 0, "WARC-Record-ID: <c>\r\nWARC-Concurrent-To: <a>\r\nWARC-Concurrent-To: <b>\r\n"),
        head("request", 0, "WARC-Record-ID: <d>\r\nWARC-Concurrent-To: <lost>\r\n"),
    ]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(r + b"\r\n\r\n") for r in records))
    done = {r.capture_id: r for r in warc.assemble(warc.read_records(spark, str(tmp_path))).where("capture_id IS NOT NULL").collect()}
    assert done["<a>"].capture.payload_bytes == 14 and done["<a>"].request.record_id == "<b>" and done["<a>"].n_metadata == 1
    assert done["<lost>"].capture is None and done["<lost>"].n_requests == 1


def test_broken_archives_cost_their_own_records_only(spark, tmp_path):
    def one(name, block=b"hello", length=None, kind="resource"):
        size = "" if length == "" else f"Content-Length: {len(block) if length is None else length}\r\n"
        return f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{name}>\r\n{size}\r\n".encode() + block + b"\r\n\r\n"

    big = bytes(range(256)) * 1000
    cases = {
        "length.warc": one("a") + one("b", length="") + one("c", length="x") + one("d"),
        "noise.warc": b"noise\r\n\r\n" + one("e") + b"more noise\r\n" + one("f", big),
        "header.warc": one("g") + b"WARC/1.1\r\nWARC-Type: resour\r\n" + one("h") + b"WARC/1.1\r\nWARC-Ty",
        "short.warc": one("i", length=2) + one("j"),
        "cut.warc": one("k") + one("l")[:-6],
        "empty.warc": b"",
        "other.warc": b"\x00\x01" * 40_000,
        "members.warc.gz": gzip.compress(one("m")) + gzip.compress(one("n", big))[:-300] + gzip.compress(one("o")),
        "tail.warc.gz": gzip.compress(one("p") + one("q")) + b"xyz",
        "bent.warc.gz": gzip.compress(one("r")) + b"\x1f\x8b\x08\x00junk that is no member" + gzip.compress(one("s")),
        "padded.warc.gz": gzip.compress(one("t")) + b"\0" * 1000,
    }
    for name, data in cases.items():
        (tmp_path / name).write_bytes(data)
    rows = warc.read_records(spark, str(tmp_path)).collect()
    good = {r.record_id.strip("<>"): r.payload_bytes for r in rows if r.status == "ok"}
    assert set(good) >= set("adefghijkmopqrst") and good["f"] == len(big) and good["i"] == 2 and good["a"] == 5
    rest = Counter((r.status, (r.record_id or "").strip("<>"), r.file.rpartition("/")[2]) for r in rows if r.status not in ("ok", "skipped"))
    assert rest[("no_length", "b", "length.warc")] == rest[("no_length", "c", "length.warc")] == rest[("cut", "l", "cut.warc")] == 1
    assert not {"l", "n"} & set(good)
    lost = {r.file.rpartition("/")[2]: r for r in rows if r.status == "skipped"}
    assert set(lost) >= {"length.warc", "noise.warc", "header.warc", "short.warc", "other.warc"} and not {"empty.warc", "padded.warc.gz"} & {r.file.rpartition("/")[2] for r in rows if r.status != "ok"}
    assert lost["other.warc"].payload_bytes == 80_000 and lost["other.warc"].block is None
    assert {r.capture_id for r in warc.assemble(warc.read_records(spark, str(tmp_path))).collect()} == {f"<{c}>" for c in good}


@pytest.mark.parametrize("step", [1, 2, 3, 7, 1 << 16])
def test_records_do_not_depend_on_pieces(step):
    data = b"x\r\n" + b"".join(b"WARC/1.1\r\nA: %d\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, i, b"\n" * i) for i in range(9)) + b"WARC/1.1\r\nContent-Length: 9\r\n\r\nend"
    got = list(warc.parsed(data[at : at + step] for at in range(0, len(data), step)))
    assert [s for _, _, s in got] == ["skipped 3"] + ["ok"] * 9 + ["cut"]
    assert [b for _, b, _ in got[1:]] == [b"\n" * i for i in range(9)] + [b"end"]


def test_the_shape_of_a_long_word_is_that_of_all_of_it():
    field = pii.Field()
    found = []
    for lead in (0, 300, 70_000):
        data, offsets = bytes_of(pa.array(["call me at " + "(" * lead + "555-123-4567 today"]))
        found.append([kind for _, kind, _ in pii.tagged(field, field.reach(), data, offsets).get(0, [])])
    assert found[0] and found[0] == found[1] == found[2]


def test_encoder_tables_are_compact(monkeypatch):
    """The workers of an executor hold these tables at the same time."""
    encoder = byte_bpe.Encoder(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    rng = random.Random(5)
    for _ in range(500):
        encoder.later["".join(rng.choices("abcdefghijklmnop", k=9))]
    transducer = encoder.later.transducer
    assert all(type(x) in (int, bytes) for state in transducer.states for x in state)
    assert {type(x) for x in transducer.moves.values()} == {int, tuple}
    monkeypatch.setattr(transducer, "encode", lambda piece: b"")
    for i in range(300_000):
        encoder.later["".join("abcdefghij"[int(d)] for d in str(1_000_000 + i))]
    assert len(encoder.later) + len(encoder.later.older) < 300_000
