"""Repair of conversations by the lightest derivation of a legal one.

The rows of a conversation, in the order of their turns, are edited into one whose role initials
are ``(s?(ua)+)?``: keep a row, give it another role, delete it, or insert an empty one. An item
``[i, q]`` says that the first i rows have been edited and what they give leaves the grammar in
state q; its weight is ``(cost, audit)``, the edits' initials in order. Every edit is a deduction
from one item to another, and its weight function adds a cost and appends an initial, so it is
monotone and never lighter than what it starts from. Knuth's agenda pops the lightest item, which
is then final, until the goal is. Where a conversation is cut, each piece has an item ``[q, r]`` for
every pair of states, and deductions with two antecedents join the items of neighbouring pieces.

All decisions are taken on narrow facts of the rows: a digest, one letter for role and fault. Facts
lie in ranges of (conversation, turn, ...), so a conversation with a third of all rows is spread over
many tasks; only items of its pieces meet. Texts move once, beside the audit that is read along
with them; they stream through a task and are never held, whatever the length of a conversation.

Defined cases: a null role or text is one space; such a role is neither kept nor legal, and so is
any role whose first character is not s, u or a. Rows of one turn go by the first HEAD characters
of their role, then of their text, then by a digest; null turns come first and count neither for
gaps nor as turns. Rows with a null id are one conversation. Equal rows are duplicates of each
other. A conversation without rows, or all of whose rows go, is empty. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill.llm.shared import kept

BLANKS = " \t\n\x0b\x0c\r"
HEAD = 64
#: Letters of a piece of a conversation at most, and decisions kept by a task.
PIECE, KNOWN = 2048, 1 << 16
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}
#: States: nothing yet, after the system's row, after the user's, after the assistant's.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (NOTHING, ASSISTANT)
STEP = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
ROLE = {"u": "user", "a": "assistant"}
ORDER = ("turn", "role_head", "text_head", "digest")


def edits_of(letter: str) -> list[tuple[int, str, str]]:
    """``(cost, initial, role given)`` for a row: s, u, a, x by its role, upper case if cut off, d if it must go."""
    out = [(DELETE, "D", "")]
    if letter != "d":
        more = CUT_OFF if letter.isupper() else 0
        out += [(KEEP + more, "K", letter.lower())] * (letter not in "xX") + [(REROLE + more, "R", role) for role in "ua" if role != letter.lower()]
    return out


def deductions() -> dict[str, list[list[tuple[int, str, int]]]]:
    """By letter and state before: ``(cost, initial, state after)``; the letter "" inserts a row."""
    table = {x: edits_of(x) for x in "suaxSUAXd"} | {"": [(INSERT, "I", "u"), (INSERT, "I", "a")]}
    return {x: [[(c, i, q if not role else STEP[q, role]) for c, i, role in edits if not role or (q, role) in STEP] for q in range(4)] for x, edits in table.items()}


RULES = deductions()


def lightest(letters: str, start: int, goals: tuple[int, ...], every: bool = False) -> dict[int, tuple[int, str]]:
    """Knuth's agenda from ``[0, start]``: the lightest derivation of the first goal ``[n, q]``, or of every one."""
    n, final, found = len(letters), set(), {}
    agenda = [(0, "", 0, start)]
    while agenda:
        cost, audit, i, q = heapq.heappop(agenda)
        if (i, q) in final:
            continue
        final.add((i, q))
        if i == n and q in goals:
            found[q] = (cost, audit)
            if not every or len(found) == len(goals):
                break
        if i < n:
            for more, initial, after in RULES[letters[i]][q]:
                if (i + 1, after) not in final:
                    heapq.heappush(agenda, (cost + more, audit + initial, i + 1, after))
        for more, initial, after in RULES[""][q]:
            if (i, after) not in final:
                heapq.heappush(agenda, (cost + more, audit + initial, i, after))
    return found


def spans(letters: str) -> list[tuple[int, int, int, str]]:
    """The items ``[q, r]`` of a piece: state before, state after, cost, audit."""
    every = tuple(range(4))
    return [(q, r, cost, audit) for q in every for r, (cost, audit) in lightest(letters, q, every, every=True).items()]


class Joined:
    """Items from the beginning of a conversation, joined with those of one piece after the other.

    What all audits begin with is settled and put aside, so comparing them stays short.
    """

    def __init__(self):
        self.settled: list[str] = []
        self.open: dict[int, tuple[int, str]] = {NOTHING: (0, "")}

    def join(self, items: list[tuple[int, int, int, str]]) -> None:
        after: dict[int, tuple[int, str]] = {}
        for q, r, more, edits in items:
            if q in self.open:
                cost, audit = self.open[q]
                weight = (cost + more, audit + edits)
                if r not in after or weight < after[r]:
                    after[r] = weight
        common = os.path.commonprefix([audit for _, audit in after.values()])
        self.settled.append(common)
        self.open = {r: (cost, audit[len(common) :]) for r, (cost, audit) in after.items()}

    def goal(self) -> tuple[int, str]:
        cost, audit = min(self.open[q] for q in ACCEPTED if q in self.open)
        return cost, "".join(self.settled) + audit


class Edits:
    """Follows an audit along the rows and gives what they become."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, NOTHING

    def given(self, initial: str) -> str:
        self.state = STEP[self.state, initial]
        return initial

    def missing(self) -> Iterator[str]:
        """Roles of the rows inserted here."""
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield ROLE[self.given("a" if self.state == USER else "u")]

    def row(self, role: str) -> str | None:
        """The role a row gets; None if it goes."""
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "D":
            return None
        if edit == "K":
            self.given(role[0])
            return role
        return ROLE[self.given("a" if self.state == USER else "u")]


def damaged(conversations: DataFrame) -> DataFrame:
    """Faults by crc32 of ``conv_id:turn``: rows lost, emptied, without stops, repeated, with a wrong role."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.crc32(name.cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(fault == 0, F.array().cast("array<int>")).when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def described(rows: DataFrame) -> DataFrame:
    """Rows with the columns that order them; null roles and texts are one space."""
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    head = [F.substring(c, 1, HEAD).alias(f"{name}_head") for name, c in (("role", role), ("text", text))]
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest")
    return rows.select("conv_id", "turn", *head, digest, role.alias("role"), text.alias("text"))


def facts(rows: DataFrame) -> DataFrame:
    """Equal rows once, with their number, first fault and whether they are the first of that role and text."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role_head", 1, 1)
    narrow = described(rows).select(
        "conv_id",
        *ORDER,
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("cut_off"),
    )
    runs = narrow.groupBy("conv_id", *ORDER, "initial", "blank", "cut_off").agg(F.count("*").alias("n"))
    first = runs.groupBy(F.col("conv_id").alias("of"), F.col("digest").alias("same")).agg(F.min(F.struct("turn")).alias("earliest"))
    met = runs.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("same")))
    return met.select("conv_id", *ORDER, "initial", "blank", "cut_off", "n", F.col("turn").eqNullSafe(F.col("earliest.turn")).alias("first"))


ITEMS = T.ArrayType(T.StructType([T.StructField("q", T.IntegerType()), T.StructField("r", T.IntegerType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())]))
SUMS = ("blank", "duplicate", "truncated", "illegal", "turns")
ENDS = ("first_turn", "last_turn", "first_initial", "last_initial", "first_known", "last_known")


class Piece:
    """A stretch of one conversation: its letters and what is counted in it."""

    def __init__(self, conv, order: tuple, no: int):
        self.conv, self.order, self.no = conv, order, no
        self.letters: list[str] = []
        self.size = 0
        self.sums = dict.fromkeys(SUMS, 0)
        self.ends = dict.fromkeys(ENDS)

    def add(self, turn, initial: str, blank: bool, cut_off: bool, n: int, first: bool) -> None:
        new = first and not blank
        self.letters.append(((initial.upper() if cut_off else initial) if new else "") + "d" * (n - new))
        self.size += n
        self.sums["blank"] += n if blank else 0
        self.sums["duplicate"] += 0 if blank else n - new
        self.sums["truncated"] += new and cut_off
        self.sums["illegal"] += n - 1 + (bool(self.ends["last_initial"]) and self.ends["last_initial"] + initial not in LEGAL)
        if turn is not None and turn != self.ends["last_known"]:
            self.sums["turns"] += 1
            self.ends["last_known"] = turn
            if self.ends["first_known"] is None:
                self.ends["first_known"] = turn
        if self.ends["first_initial"] is None:
            self.ends["first_initial"], self.ends["first_turn"] = initial, turn
        self.ends["last_initial"], self.ends["last_turn"] = initial, turn


def solved(rows: DataFrame) -> DataFrame:
    """Pieces of conversations, from facts in ranges, each with its items."""
    placed = rows.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)
    types = {f.name: f.dataType for f in placed.schema}
    schema = T.StructType([T.StructField(c, types[c]) for c in ("conv_id", *ORDER)] + [T.StructField("no", T.LongType()), T.StructField("items", ITEMS)])
    for c in SUMS:
        schema.add(c, T.LongType())
    for c in ENDS:
        schema.add(c, T.StringType() if "initial" in c else types["turn"])
    arrow = None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Piece, bool]]:
        """Pieces, and whether they are known to be a whole conversation."""
        now, entered = None, 0
        for batch in batches:
            for conv, *order, initial, blank, cut_off, n, first in zip(*(batch.column(c).to_pylist() for c in ("conv_id", *ORDER, "initial", "blank", "cut_off", "n", "first")), strict=True):
                if now is None or conv != now.conv or now.size >= PIECE:
                    same = now is not None and conv == now.conv
                    if now is not None:
                        yield now, entered > 1 and not same and now.no == 0
                    entered += not same
                    now = Piece(conv, tuple(order), now.no + 1 if same else 0)
                while now.size + n > PIECE:
                    part = PIECE - now.size
                    if part:
                        now.add(order[0], initial, blank, cut_off, part, first)
                        n, first = n - part, False
                    yield now, False
                    now = Piece(conv, tuple(order), now.no + 1)
                now.add(order[0], initial, blank, cut_off, n, first)
        if now is not None:
            yield now, False

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*done, strict=True), arrow, strict=True)], schema=arrow)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        done = []
        for piece, whole in cut(batches):
            letters = "".join(piece.letters)
            if whole:
                items = known.get(letters)
                if items is None:
                    items = [(NOTHING, r, cost, audit) for r, (cost, audit) in lightest(letters, NOTHING, ACCEPTED).items()]
                    if len(known) < KNOWN and len(letters) <= HEAD:
                        known[letters] = items
            else:
                items = spans(letters)
            held = [dict(zip(("q", "r", "cost", "audit"), x, strict=True)) for x in items]
            done.append((piece.conv, *piece.order, piece.no, held, *piece.sums.values(), *piece.ends.values()))
            if len(done) >= 256:
                yield batch_of(done)
                done = []
        if done:
            yield batch_of(done)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return placed.mapInArrow(solve, schema)


RESULTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def decided(pieces: DataFrame) -> DataFrame:
    """One row per conversation that has rows: counts, cost and audit of its lightest repair."""
    columns = ("conv_id", "items", *SUMS, *ENDS)
    placed = pieces.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER, "no").select(*columns)
    conv_type = placed.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", conv_type), *(T.StructField(c, T.LongType()) for c in RESULTS), T.StructField("audit", T.StringType())])

    def close(conv, joined: Joined, sums: dict, low, high) -> dict:
        cost, audit = joined.goal()
        gaps = 0 if low is None else high - low + 1 - sums["turns"]
        return {"conv_id": conv, "gaps": gaps, **{c: sums[c] for c in SUMS[:-1]}, "cost": cost, "audit": audit}

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None
        done = []
        for batch in batches:
            for row in batch.to_pylist():
                if open_ is None or open_[0] != row["conv_id"]:
                    if open_:
                        done.append(close(*open_))
                    open_ = [row["conv_id"], Joined(), dict.fromkeys(SUMS, 0), None, None]
                    before = None
                _, joined, sums, low, high = open_
                joined.join([tuple(x.values()) for x in row["items"]])
                for c in SUMS:
                    sums[c] += row[c]
                if before is not None:
                    sums["illegal"] += before["last_initial"] + row["first_initial"] not in LEGAL
                if high is not None and row["first_known"] == high:
                    sums["turns"] -= 1
                open_[3] = row["first_known"] if low is None else low
                open_[4] = high if row["last_known"] is None else row["last_known"]
                before = row
            if done:
                yield pa.RecordBatch.from_pylist(done)
                done = []
        if open_:
            yield pa.RecordBatch.from_pylist([close(*open_)])

    return placed.mapInArrow(in_schema(join, schema), schema)


def in_schema(function, schema: T.StructType):
    """The batches of a function as the schema has them."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in function(batches):
            yield pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in arrow], schema=arrow)

    return run


def beside_rows(rows: DataFrame, results: DataFrame, ids: DataFrame) -> DataFrame:
    """Every conversation in order: its id, its result, then its rows."""
    lines = described(rows).withColumn("kind", F.lit(2))
    found = results.withColumn("kind", F.lit(1))
    named = ids.select("conv_id").distinct().withColumn("kind", F.lit(0))
    every = named.unionByName(found, allowMissingColumns=True).unionByName(lines, allowMissingColumns=True)
    return every.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER).select("conv_id", "kind", "role", "text", *RESULTS, "audit")


def events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, object, object]]:
    """``(id, conv)`` and ``(result, row)`` of each conversation, then ``(row, (role, text))`` of what it becomes."""
    edits, began = None, False
    for batch in batches:
        kinds = batch.column("kind").to_pylist()
        ids, roles, texts = (batch.column(c) for c in ("conv_id", "role", "text"))
        for at, kind in enumerate(kinds):
            if kind < 2:
                if kind == 0:
                    if edits:
                        yield from (("row", role, "") for role in edits.missing())
                    edits, began = Edits(""), True
                    yield "id", ids[at].as_py(), None
                else:
                    row = batch.slice(at, 1).to_pylist()[0]
                    edits = Edits(row["audit"])
                    yield "result", row, None
                continue
            yield from (("row", role, "") for role in edits.missing())
            role = edits.row(roles[at].as_py())
            if role is not None:
                yield "row", role, texts[at].as_py()
    if began:
        yield from (("row", role, "") for role in edits.missing())


def summaries(rows: DataFrame, results: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per id: counts, cost, audit and the SHA-256 of the repaired ``role:text`` lines."""
    conv_type = ids.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", conv_type), *(T.StructField(c, T.LongType()) for c in RESULTS), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hashed, n, done = None, None, 0, []
        for kind, value, text in events(batches):
            if kind == "row":
                hashed.update(f"\n{value}:{text}".encode() if n else f"{value}:{text}".encode())
                n += 1
                continue
            if kind == "id":
                if now:
                    done.append(now | {"repaired_sha256": hashed.hexdigest()})
                now, hashed, n = {"conv_id": value, **dict.fromkeys(RESULTS, 0), "audit": ""}, hashlib.sha256(), 0
            else:
                now |= {c: value[c] for c in (*RESULTS, "audit")}
            if len(done) >= 4096:
                yield pa.RecordBatch.from_pylist(done)
                done = []
        if now:
            yield pa.RecordBatch.from_pylist([*done, now | {"repaired_sha256": hashed.hexdigest()}])

    return beside_rows(rows, results, ids).mapInArrow(in_schema(summed, schema), schema)


def repaired_rows(rows: DataFrame, results: DataFrame) -> DataFrame:
    """``(conv_id, place, role, text)``: the rows of the repaired conversations, places from 0."""
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("place", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, n, held, done = None, 0, 0, []
        for kind, value, text in events(batches):
            if kind == "id":
                conv, n = value, 0
            elif kind == "row":
                done.append({"conv_id": conv, "place": n, "role": value, "text": text})
                n, held = n + 1, held + len(text)
                if len(done) >= 4096 or held > 1 << 22:
                    yield pa.RecordBatch.from_pylist(done)
                    held, done = 0, []
        if done:
            yield pa.RecordBatch.from_pylist(done)

    return beside_rows(rows, results, rows).mapInArrow(in_schema(written, schema), schema)


def lightest_repairs(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` to counts of faults, cost and audit per conversation; stored."""
    return kept(decided(kept(solved(facts(rows)), "conversation-pieces")), "conversation-repairs")


def repair(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` to legal conversations ``(conv_id, place, role, text)``."""
    return repaired_rows(rows, lightest_repairs(rows))


def repair_report(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for each ``conv_id`` in ids: faults, cost, audit and a digest of the repaired conversation."""
    return summaries(rows, lightest_repairs(rows), ids)
