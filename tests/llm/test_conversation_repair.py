"""Conversation repair against plain code that tries every edit."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from docmill.llm import conversation_repair as repair

KIND = "conv_id long, turn long, role string, text string, audit string, cost int, kind int, digest string"
LEGAL = re.compile("(s?(ua)+)?")


@cache
def best_by_hand(letters: str) -> tuple[int, str]:
    """All edits of cost 0, 1, 2, ... until some are legal; the least audit of those."""

    def tries(i, made, audit, left):
        if i == len(letters) and not left and LEGAL.fullmatch(made):
            yield audit
        if left >= 3:
            for role in "ua":
                yield from tries(i, made + role, audit + "I", left - 3)
        if i < len(letters):
            letter = letters[i]
            if left >= 4:
                yield from tries(i + 1, made, audit + "D", left - 4)
            if letter != "d":
                more = 3 if letter.isupper() else 0
                if letter not in "xX" and left >= more:
                    yield from tries(i + 1, made + letter.lower(), audit + "K", left - more)
                if left >= more + 3:
                    for role in "ua":
                        yield from tries(i + 1, made + role, audit + "R", left - more - 3)

    cost = 0
    while True:
        found = min(tries(0, "", "", cost), default=None)
        if found is not None:
            return cost, found
        cost += 1


def by_hand(rows):
    """``(conv_id, turn, role, text)`` to one result per conversation."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, lines in convs.items():
        lines.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, letters, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in lines:
            stripped = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            letters += "d" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        turns = {t for t, _, _ in lines if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(lines, lines[1:], strict=False))
        cost, audit = best_by_hand(letters)
        made, at, size = [], 0, len(audit.replace("D", ""))
        for edit in audit:
            if edit != "D":
                role = ("user", "assistant")[(len(made) + size % 2) % 2] if edit != "K" else lines[at][1]
                made.append((role, "" if edit == "I" else lines[at][2]))
            at += edit != "I"
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[conv] = (conv, gaps, *counts.values(), illegal, cost, audit, digest), made
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "odd", 1, 2, "odd") for r in rows], KIND).repartition(3)


def odd_rows(seed, n=120):
    r = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(r.randint(0, 5)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", "", None, "usher"])
            text = r.choice(["Yes.", "No!", "Why?  \n", "cut off", "", " \t", None, "Ümlaut… ok.", "\x85", "a" * 200 + ".", "a" * 200 + "!"])
            rows.append((conv, r.choice([turn, turn, turn * 2, None, -turn]), role, text))
    return rows + [(None, 0, "user", "Hi."), (None, 1, "assistant", "Hello."), (None, None, None, None)] + rows[5:9] * 2


@pytest.mark.parametrize("seed", range(3))
def test_lightest_derivation_equals_trying_all(seed):
    r = random.Random(seed)
    for _ in range(150):
        letters = "".join(r.choice("suaxSUAXduaua") for _ in range(r.randint(0, 4)))
        found = repair.lightest(letters, repair.NOTHING, repair.ACCEPTED)
        assert min(found.values()) == best_by_hand(letters), letters


def test_joined_pieces_equal_the_whole():
    r = random.Random(9)
    for _ in range(200):
        letters = "".join(r.choice("suaxSUAXduaua") for _ in range(r.randint(0, 40)))
        joined = repair.Joined()
        at = 0
        while at < len(letters):
            to = at + r.randint(1, 9)
            joined.join(repair.spans(letters[at:to]))
            at = to
        assert joined.goal() == min(repair.lightest(letters, repair.NOTHING, repair.ACCEPTED).values()), letters


@pytest.mark.parametrize("piece", [2048, 3])
def test_report_equals_plain_code(spark, monkeypatch, piece):
    monkeypatch.setattr(repair, "PIECE", piece)
    rows = odd_rows(piece)
    ids = frame(spark, [*rows, (9000, 0, "user", "gone.")])
    got = {r.conv_id: tuple(r) for r in repair.repair_report(frame(spark, rows), ids).collect()}
    want = {c: r for c, (r, _) in by_hand(rows).items()}
    assert got.pop(9000) == (9000, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == want


def test_repaired_rows_are_legal(spark):
    rows = odd_rows(8, 60)
    got = {}
    for conv, place, role, text in sorted(map(tuple, repair.repair(frame(spark, rows)).collect()), key=lambda r: (repr(r[0]), r[1])):
        got.setdefault(conv, []).append((role, text))
        assert place == len(got[conv]) - 1
    assert got == {c: made for c, (_, made) in by_hand(rows).items() if made}
    assert all(LEGAL.fullmatch("".join(r[0] for r, _ in lines)) for lines in got.values())


def test_a_conversation_over_many_pieces_and_a_run_of_copies(spark, monkeypatch):
    monkeypatch.setattr(repair, "PIECE", 16)
    r = random.Random(4)
    rows = [(7, i, r.choice(["user", "assistant"]), f"Turn {i}" + r.choice([".", ""])) for i in range(600)] + [(7, 300, "user", "Copy.")] * 100 + [(1, 0, "user", "A."), (9, 0, "assistant", "B.")]
    got = {x.conv_id: x for x in repair.repair_report(frame(spark, rows), frame(spark, rows)).collect()}
    lines = sorted(((t, role, text) for c, t, role, text in rows if c == 7))
    letters, seen = "", set()
    for _, role, text in lines:
        letters += "d" if (role, text) in seen else role[0] if text[-1] == "." else role[0].upper()
        seen.add((role, text))
    assert (got[7].cost, got[7].audit) == min(repair.lightest(letters, repair.NOTHING, repair.ACCEPTED).values())
    assert (got[7].duplicate, got[7].gaps, got[1].audit, got[9].audit) == (99, 0, "IK"[::-1], "IK")


def test_damage_and_empty_tables(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"Text {t}. And! more?") for c in range(40) for t in range(4)] + [(None, None, None, None)]
    want = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        row = (conv, turn, "user" if fault == 4 else role, "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text)
        want += [row] * {0: 0, 3: 2}.get(fault, 1)
    assert sorted(map(tuple, repair.damaged(frame(spark, rows)).collect()), key=repr) == sorted(want, key=repr)
    none = frame(spark, rows).where(F.lit(False))
    assert repair.repair_report(repair.damaged(none), none).count() == 0
    assert repair.repair(none).count() == 0
