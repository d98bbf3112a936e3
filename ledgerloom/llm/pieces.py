"""SentencePiece encoding and decoding by a streaming Viterbi search.

The vocabulary, its scores and its text rules come from a public model file, never trained here. A text is normalised as the model
says (a dummy prefix, spaces written as U+2581), and the best path of pieces maximises the sum of scores.

The search reads a text once, from the left. An automaton of all pieces, completed as it is used, tells those that end at each character; of each boundary only the best score and the last piece
are kept, and scores only for a window as long as the longest piece, as no piece reaches further back. Every few windows the paths that
can still win, one for each boundary in the window, are followed back; where they all go through one boundary, the ids before it are final, are committed and
forgotten. A character no piece spells costs ten less than the lowest score and is written as bytes, or as the unknown id where the model has no bytes. Of
equal paths the one whose last piece is longest wins. Scores are whole numbers of 2^-20, so they add up exactly.

A model of merges has ranks where a unigram model has log-probabilities. A rank r then scores -ln(r + 1), as in Zipf's law, less ``PIECE_COST``, so that
fewer pieces win; it is set so that most words get the ids that merging gives (README has the figure).

A text goes through the search as it is, many words at a time; only around characters that no piece holds, which all paths must spell alone, does it begin anew.

Decoding joins the pieces, turns marks into spaces, drops the dummy prefix and decodes the bytes.

Null text: null ids (the query counts none); empty text: no ids, whatever the prefix. Lone byte pieces that make no
UTF-8 decode to U+FFFD. A text's own U+2581 decodes to a space, as the format has it. Repeated rows are encoded each; null doc ids are kept; texts
are encoded whole; extra columns pass where rows are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from ledgerloom.llm.common import arrow_map

MARK = "▁"
# Scores are rounded to this part of one and kept as whole numbers, so that sums are exact.
UNIT = 1 << 20
# Added to the cost of each piece of a model of merges.
PIECE_COST = 6.0
# So many lengths of the longest piece are read between two attempts to commit.
WINDOWS = 16
# Transitions of a state to shorter ones that are kept.
KEPT = 64
# Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _varint(data: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[i]
        i += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, i


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    i = 0
    while i < len(data):
        tag, i = _varint(data, i)
        if tag & 7 == 0:
            value, i = _varint(data, i)
            yield tag >> 3, value
        else:
            if tag & 7 == 2:
                size, i = _varint(data, i)
            else:
                size = 4 if tag & 7 == 5 else 8
            yield tag >> 3, data[i : i + size]
            i += size


class State(dict):
    """A state of the automaton: what has been read last, as far as a piece may begin with it. By character it has the next state and the pieces that end there.

    An entry is the state, then the longest piece: place of the boundary where it begins, counted from the end of the scores; score; step back; then the other pieces, the longest first. Entries are made when they are first taken: those along
    the tree of pieces are kept, of those back to shorter states as many as ``KEPT`` for each state.
    """

    __slots__ = ("back", "children")

    def __init__(self, children: dict, back: State | None):
        self.children, self.back = children, back

    def __missing__(self, c: str) -> tuple:
        child = self.children.get(c)
        shorter = None if self.back is None else self.back[c]
        if child is None:
            entry = shorter
        else:
            state = State(child, self if shorter is None else shorter[0])
            ends = [*child.get("", ()), *((shorter[1:4], *shorter[4]) if shorter else ())]
            entry = (state, *ends[0], tuple(ends[1:]))
        if child is not None or len(self) < KEPT:
            self[c] = entry
        return entry


@dataclass
class Model:
    pieces: list[tuple[str, float, int]]
    dummy_prefix: bool = True
    trim: bool = False

    def __post_init__(self) -> None:
        self.ids = {p: (i, s) for i, (p, s, k) in enumerate(self.pieces) if k in (NORMAL, USER)}
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        self.penalty = min((s for _, s in self.ids.values()), default=0.0) - 10 * UNIT
        byte = {p: i for i, (p, _, k) in enumerate(self.pieces) if k == BYTE}
        self.bytes_ = [byte[f"<0x{b:02X}>"] for b in range(256)] if len(byte) == 256 else []
        self.joined = {c for p in self.ids if len(p) > 1 for c in p}
        self.known = self.joined | {p for p in self.ids if len(p) == 1}
        # Stretches of characters that pieces hold, and other characters one by one.
        self.split = re.compile(f"[{''.join(map(re.escape, sorted(self.known)))}]+|." if self.known else ".", re.S)
        self.bits = self.longest.bit_length()
        tree: dict = {}
        for p, i, score in [*((c, -1, self.penalty) for c in self.joined - self.ids.keys()), *((p, i, score) for p, (i, score) in self.ids.items())]:
            node = tree
            for c in p:
                node = node.setdefault(c, {})
            node[""] = ((-len(p), score, (i << self.bits) + len(p)),)
        self.start = State(tree, None)

    def __reduce__(self) -> tuple:
        return _same_model, (tuple(self.pieces), self.dummy_prefix, self.trim)


@lru_cache(2)
def _same_model(pieces: tuple, dummy_prefix: bool, trim: bool) -> Model:
    """One automaton for all tasks of a process."""
    return Model(list(pieces), dummy_prefix, trim)


def load_model(path: str) -> Model:
    with open(path, "rb") as f:
        return parse_model(f.read())


def parse_model(data: bytes) -> Model:
    pieces, prefix, trim, kind = [], True, True, 1
    for tag, value in _fields(data):
        if tag == 1:
            piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(value))
            pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
        elif tag == 2:
            kind = dict(_fields(value)).get(3, 1)
        elif tag == 3:
            rules = dict(_fields(value))
            if rules.get(1, b"identity") != b"identity" or rules.get(2):
                raise ValueError("only models without a character map are read")
            prefix, trim = bool(rules.get(3, 1)), bool(rules.get(4, 1))
    # The scores of a merge model (kind 2) are negative ranks.
    score = (lambda x: -math.log(1 - x) - PIECE_COST) if kind == 2 else (lambda x: x)
    return Model([(p, float(round(score(x) * UNIT)), k) for p, x, k in pieces], prefix, trim)


def normalise(text: str, model: Model) -> str:
    if model.trim:
        text = re.sub(" +", " ", text.strip(" "))
    if not text:
        return ""
    return (MARK if model.dummy_prefix else "") + text.replace(" ", MARK)


def viterbi(text: str, model: Model) -> Iterator[list[int]]:
    """Ids of the best path, in the runs in which they are committed."""
    for part in model.split.findall(text):
        if part[0] in model.known:
            yield from search(part, model)
        else:
            yield spelt(part, model)


def search(text: str, model: Model) -> Iterator[list[int]]:
    """Ids of the best path of a text whose characters all are in pieces, in runs that are committed together.

    ``best`` holds the scores of the last boundaries only, as many as the longest piece has characters and those read since; ``back`` the step back from each boundary since the
    last commit: the last piece's id above its length, -1 for a character that no piece spells.
    """
    longest, n = model.longest, len(text)
    step = WINDOWS * longest
    best, back, base, state = [0.0], [], 0, model.start
    for at in range(0, n, step):
        for c in text if n <= step else text[at : at + step]:
            state, begin, top, last, others = state[c]
            top += best[begin]
            # The longest piece comes first and stays unless a shorter one scores more.
            for begin, score, piece in others:
                score += best[begin]
                if score > top:
                    top, last = score, piece
            best.append(top)
            back.append(last)
        if at + step >= n:
            yield path(text, model, base, n, back)
            return
        meet = meeting(back, base, at + step, longest, model.bits)
        if meet > base:
            yield path(text, model, base, meet, back)
            back, base = back[meet - base :], meet
        low = best[-1]
        best = [x - low for x in best[-longest - 1 :]]


def meeting(back: list[int], base: int, reached: int, longest: int, bits: int) -> int:
    """The boundary that all paths that can still win go through: those that end where a piece that ends further on may begin."""
    mask = (1 << bits) - 1
    alive = set(range(max(base, reached - longest + 1), reached + 1))
    for end in range(reached, base, -1):
        if end in alive:
            if len(alive) == 1:
                return end
            alive.remove(end)
            alive.add(end - (back[end - base - 1] & mask))
    return base


def path(text: str, model: Model, base: int, end: int, back: list[int]) -> list[int]:
    out: list[int] = []
    bits, mask = model.bits, (1 << model.bits) - 1
    end -= base
    while end:
        code = back[end - 1]
        if code < 0:
            out += reversed(spelt(text[base + end - 1], model))
        else:
            out.append(code >> bits)
        end -= code & mask
    out.reverse()
    return out


def spelt(c: str, model: Model) -> list[int]:
    """Ids of a character that no piece spells."""
    return [model.bytes_[b] for b in c.encode("utf-8", "surrogatepass")] if model.bytes_ else [model.unknown]


def encoded(text: str, model: Model) -> bytes:
    """Ids of a text as little-endian int32, joined from the runs in which they are committed."""
    return b"".join(struct.pack(f"<{len(ids)}i", *ids) for ids in viterbi(normalise(text, model), model))


class Decoder:
    def __init__(self, model: Model):
        self.model = model
        self.bytes_ = [bytes([int(p[3:5], 16)]) if k == BYTE else b" \xe2\x81\x87 " if k == UNKNOWN else b"" if k == CONTROL else p.replace(MARK, " ").encode("utf-8", "surrogatepass") for p, _, k in model.pieces]

    def decode(self, ids: bytes) -> str:
        out = b"".join(map(self.bytes_.__getitem__, np.frombuffer(ids, "<i4").tolist())).decode("utf-8", "replace")
        return out[1:] if self.model.dummy_prefix and out[:1] == " " else out


def _column(ids: list[bytes | None]) -> pa.Array:
    sizes = np.array([len(x) // 4 if x is not None else 0 for x in ids], np.int64)
    values = pa.array(np.frombuffer(b"".join(x or b"" for x in ids), "<i4"))
    none = np.array([x is None for x in ids], bool)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values, mask=pa.array(none))


def encode(rows: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """keep, then ids array<int> and n_ids, of the text of each row."""
    fields = [rows.schema[c] for c in keep]

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [None if t is None else encoded(t, model) for t in batch.column(len(keep)).to_pylist()]
        sizes = pa.array([None if x is None else len(x) // 4 for x in ids], pa.int64())
        return pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], _column(ids), sizes], [*keep, "ids", "n_ids"])

    return arrow_map(rows.select(*keep, "text"), f, StructType(fields).add("ids", ArrayType(IntegerType(), False)).add("n_ids", LongType()))


def digests(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_ids, ids_sha256, decoded_sha256, exact: the ids and what they decode to; exact where that is the text."""
    state: list[Decoder] = []

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not state:
            state.append(Decoder(model))
        out = []
        for t in batch.column(1).to_pylist():
            ids = encoded(t or "", model)
            back = state[0].decode(ids)
            out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), back == (t or "")))
        n, a, b, same = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(a), pa.array(b), pa.array(same)], ["doc_id", "n_ids", "ids_sha256", "decoded_sha256", "exact"])

    return arrow_map(docs.select("doc_id", "text"), f, "doc_id long, n_ids long, ids_sha256 string, decoded_sha256 string, exact boolean")
