"""Byte-level BPE by a finite-state transducer, and streaming decoding.

The merges say which two tokens may stand side by side: a pair may if merging the joined bytes
gives back that pair. A text's tokens are the one split in which all neighbours may stand so. The
nondeterministic transducer keeps, for every open start, the token before it and the place in a
trie of all tokens. It is made deterministic as texts need it: a state is the set of open starts
with the tokens not yet emitted, and a token is emitted as soon as all open starts agree on it,
which is after at most the longest token. States and finished pieces are kept, up to a limit.

Decoding runs a UTF-8 state machine over tokens, a step for each token that is not whole
characters by itself, and hands on complete characters only.

Defined cases: null texts are empty and have no tokens; every text decodes to its own bytes;
repeated rows are encoded each; an empty table gives no rows. Special tokens are never made.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import batched, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.shared import received, send
from docmill.llm.textops import slices

ROOT = 0
#: Open starts are packed as the token before them and the trie node; before the first token there is NOTHING.
LOW, NOTHING = (1 << 20) - 1, (1 << 20) - 1
#: Tokens tried when asking whether a start may still become one.
TRIES = 96
#: Entries of a worker's tables before they are begun anew.
STATES, PIECES = 1 << 18, 1 << 17
NO_END = 1 << 40
#: Below this character a word of letters is one piece whatever the version of the character tables.
LETTERS_END = "\u0250"
#: White space other than single blanks and line ends between other characters; such texts take the slower way.
IRREGULAR = "[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]|[ \n][ \n]|^[ \n]|[ \n]$"


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of base64 tokens and their ranks; it is read on the driver and bounded by the vocabulary."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Transducer:
    """Bytes of a piece to token ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.child: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        self.below: list[list[int]] = [[0, 0]]
        self.in_order = sorted(ranks)
        for place, token in enumerate(self.in_order):
            node = ROOT
            for b in token:
                key = node << 8 | b
                if key not in self.child:
                    self.child[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.below.append([place, place])
                node = self.child[key]
                self.below[node][1] = place + 1
            self.token_at[node] = ranks[token]
            self.below[node][0] = place + 1
        self.live: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.edges: tuple[dict, dict] = {}, {}
        self.reachable: dict[int, bool] = {}
        self.begin()

    def begin(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: dict[int, int | tuple[int, bytes]] = {}
        self.start = self.number((NOTHING << 20 | ROOT, b""))

    def number(self, state: tuple) -> int:
        """States are flat, each open start followed by its tokens; a worker holds very many of them."""
        known = self.numbers.get(state)
        if known is None:
            known = self.numbers[state] = len(self.states)
            self.states.append(state)
        return known

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte, or for a token that merges never make."""
        if token not in self.halves:
            whole = self.bytes_of[token]
            parts = [whole[i : i + 1] for i in range(len(whole))]
            while len(parts) > 2:
                rank, at = min((self.ranks.get(a + b, NO_END), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if rank >= token:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.halves[token]

    def made(self, token: int) -> bool:
        known = self.reachable.get(token)
        if known is None:
            known = self.reachable[token] = len(self.bytes_of[token]) == 1 or self.split(token) is not None
        return known

    def edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """What stands at one end while this token is built, each with the rank of the merge that takes it in."""
        known = self.edges[side]
        if token not in known:
            out, part, until = [], token, NO_END
            while True:
                out.append((self.bytes_of[part], until))
                halves = self.split(part) if len(self.bytes_of[part]) > 1 else None
                if halves is None:
                    break
                part, until = halves[side], part
            known[token] = out
        return known[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether no merge across the border comes before those that build the two sides."""
        pair = left << 20 | right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) > 4 * STATES:
                self.pairs.clear()
            known, ends, rank_of = True, self.edge(right, 0), self.ranks.get
            for a, until_a in self.edge(left, 1):
                for b, until_b in ends:
                    rank = rank_of(a + b)
                    if rank is not None and rank < until_a and rank <= until_b:
                        known = False
                        break
                if not known:
                    break
            self.pairs[pair] = known
        return known

    def open(self, place: int) -> bool:
        """Whether a start may still become a token; after some tries without an answer it is said to."""
        known = self.live.get(place)
        if known is None:
            if len(self.live) > 4 * STATES:
                self.live.clear()
            last, (low, high) = place >> 20, self.below[place & LOW]
            known = low < high and (last == NOTHING or high - low > TRIES)
            if low < high and not known:
                known = any(self.made(t) and self.fits(last, t) for t in map(self.ranks.__getitem__, self.in_order[low:high]))
            self.live[place] = known
        return known

    def move(self, state: int, byte: int) -> int | tuple[int, bytes]:
        """Determinise one step: the next state, with the tokens on which all open starts agree if there are any."""
        after = []
        for place, out in batched(self.states[state], 2, strict=True):
            node = self.child.get((place & LOW) << 8 | byte)
            if node is None:
                continue
            last = place >> 20
            if self.open(last << 20 | node):
                after.append((last << 20 | node, out))
            token = self.token_at[node]
            if token >= 0 and self.made(token) and (last == NOTHING or self.fits(last, token)):
                after.append((token << 20 | ROOT, out + token.to_bytes(4, "little")))
        agreed = after[0][1]
        for _, out in after:
            while not out.startswith(agreed):
                agreed = agreed[:-4]
        if agreed:
            cut = len(agreed)
            after = [(place, out[cut:]) for place, out in after]
        after.sort()
        to = self.number(tuple(chain.from_iterable(after)))
        step = self.moves[state << 8 | byte] = (to, agreed) if agreed else to
        return step

    def encode(self, piece: bytes) -> bytes:
        """Ids as little-endian 32-bit integers."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return whole.to_bytes(4, "little")
        if len(self.states) > STATES:
            self.begin()
        ids, state, before, moves = b"", self.start, self.start, self.moves
        for byte in piece:
            state = moves.get(state << 8 | byte, -1)
            if state == -1:
                state = self.move(before, byte)
            if state.__class__ is tuple:
                state, agreed = state
                ids += agreed
            before = state
        for place, out in batched(self.states[state], 2, strict=True):
            if not place & LOW:
                return ids + out
        raise ValueError("the ranks have no token for a byte")


class Pieces(dict):
    """Ids, as bytes, of text that starts with a given prefix; new text goes through the transducer."""

    def __init__(self, transducer: Transducer, pattern, prefix: str):
        self.transducer, self.pattern, self.prefix = transducer, pattern, prefix
        self.older: dict[str, bytes] = {}

    def known(self, piece: str) -> bytes:
        """Ids of one piece, which may have been a text of its own."""
        text = piece[len(self.prefix) :] if piece.startswith(self.prefix) else ""
        return (text and (self.get(text) or self.older.get(text))) or self.transducer.encode(piece.encode())

    def __missing__(self, text: str) -> bytes:
        value = self.older.get(text)
        if value is not None:
            self[text] = value
            return value
        whole = self.prefix + text
        if text.isalpha() and max(text) < LETTERS_END:
            value = self.transducer.encode(whole.encode())
        else:
            value = b"".join([self.known(piece) for piece in self.pattern.findall(whole)])
        if len(self) > PIECES:
            self.older = dict(self)
            self.clear()
        if len(text) < 64:
            self[text] = value
        return value


class Encoder:
    """Whole texts to ids as little-endian 32-bit integers.

    A blank or line end between two other characters begins a new piece, whatever is around it,
    so regular texts are cut there and repeated words are looked up.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import re

        import regex

        transducer, compiled = Transducer(ranks), regex.compile(pattern)
        self.first, self.later = Pieces(transducer, compiled, ""), Pieces(transducer, compiled, " ")
        self.line_end = self.first["\n"]
        self.irregular, self.pattern = re.compile(IRREGULAR), compiled

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if self.irregular.search(text):
            return b"".join(self.first[m.group()] for m in self.pattern.finditer(text))
        lines = []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            lines.append(self.first[head] + b"".join(map(self.later.__getitem__, rest)))
        return self.line_end.join(lines)


def utf8_step(state: tuple[int, int, int], byte: int) -> tuple[int, int, int] | None:
    """One step of the machine. A state is how many bytes are missing and the range of the next one; None: not UTF-8."""
    missing, low, high = state
    if missing:
        return ((missing - 1, 0x80, 0xBF) if missing > 1 else (0, 0, 0)) if low <= byte <= high else None
    if byte < 0x80:
        return (0, 0, 0)
    if 0xC2 <= byte <= 0xDF:
        return (1, 0x80, 0xBF)
    if 0xE0 <= byte <= 0xEF:
        return (2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF)
    if 0xF0 <= byte <= 0xF4:
        return (3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF)
    return None


class Decoder:
    """Ids to characters, a stretch at a time; bytes of an unfinished character wait for the next one."""

    WHOLE = (0, 0, 0)

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.whole = np.array([self.run(self.WHOLE, t) == self.WHOLE for t in self.bytes_of])
        self.reset()

    def reset(self) -> None:
        self.state, self.waiting = self.WHOLE, b""

    def run(self, state, data: bytes):
        for byte in data:
            if state is None:
                return None
            state = utf8_step(state, byte)
        return state

    def push(self, ids: np.ndarray) -> str:
        """The characters that these ids complete; bytes that are no UTF-8 become U+FFFD."""
        data = self.waiting + b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        state, at, good = self.state, 0, True
        odd = np.flatnonzero(~self.whole[ids]).tolist()
        turn = 0
        while good and (state != self.WHOLE or turn < len(odd)):
            if state == self.WHOLE:
                while turn < len(odd) and odd[turn] < at:
                    turn += 1
                if turn == len(odd):
                    break
                at = odd[turn]
            if at == len(ids):
                break
            state = self.run(state, self.bytes_of[ids[at]])
            at += 1
            good = state is not None
        if not good:
            self.reset()
            return data.decode("utf-8", "replace")
        cut = len(data)
        if state[0]:
            while data[cut - 1] & 0xC0 == 0x80:
                cut -= 1
            cut -= 1
        self.state, self.waiting = state, data[cut:]
        return data[:cut].decode()

    def finish(self) -> str:
        tail = self.waiting.decode("utf-8", "replace")
        self.reset()
        return tail

    def __call__(self, ids: bytes, stretch: int = 1 << 16) -> Iterator[str]:
        whole = np.frombuffer(ids, "<u4")
        for at in range(0, len(whole), stretch):
            yield self.push(whole[at : at + stretch])
        yield self.finish()


class Tools:
    """What a Python worker builds once from the ranks and then keeps for all its tasks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern, self.made = ranks, pattern, {}

    def encoder(self) -> Encoder:
        if "encoder" not in self.made:
            self.made["encoder"] = Encoder(self.ranks, self.pattern)
        return self.made["encoder"]

    def decoder(self) -> Decoder:
        if "decoder" not in self.made:
            self.made["decoder"] = Decoder(self.ranks)
        self.made["decoder"].reset()
        return self.made["decoder"]


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, ids)``; ids are little-endian unsigned 32-bit integers."""
    tools = send(docs.sparkSession, Tools(read_ranks(ranks_path), pattern))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = received(tools).encoder()
        for batch in slices(batches):
            ids = [encoder(t or "") for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    kind = docs.select("doc_id").schema.add("ids", "binary")
    return docs.select("doc_id", "text").mapInArrow(encoded, kind)


def decode_ids(rows: DataFrame, ranks_path: str) -> DataFrame:
    """``rows(doc_id, ids)`` to ``(doc_id, text)``."""
    tools = send(rows.sparkSession, Tools(read_ranks(ranks_path), ""))

    def sliced(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield batch.slice(at, 256)

    def decoded_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = received(tools).decoder()
        for batch in sliced(batches):
            texts = ["".join(decoder(i or b"")) for i in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = rows.select("doc_id").schema.add("text", "string")
    return rows.select("doc_id", "ids").mapInArrow(decoded_rows, kind)


def digests(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass: number of tokens, digests of the ids and of the decoded bytes, the ids if wanted."""
    tools = send(docs.sparkSession, Tools(read_ranks(ranks_path), pattern))
    kind = docs.select("doc_id").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if with_ids:
        kind = kind.add("ids", "binary")

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = received(tools).encoder(), received(tools).decoder()
        for batch in slices(batches):
            n, sums, texts, tokens = [], [], [], []
            for text in batch.column("text").to_pylist():
                ids = encoder(text or "")
                decoded = hashlib.sha256()
                for part in decoder(ids):
                    decoded.update(part.encode())
                n.append(len(ids) // 4)
                sums.append(hashlib.sha256(ids).hexdigest())
                texts.append(decoded.hexdigest())
                if with_ids:
                    tokens.append(ids)
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sums, pa.string()), pa.array(texts, pa.string())]
            yield pa.record_batch(columns + [pa.array(tokens, pa.binary())] * with_ids, kind.names)

    return docs.select(F.col("doc_id"), "text").mapInArrow(both, kind)
